"""Row accounting and the ledger over every runner.

The binding lands files of the market panel in which some regions have no period and some
a period that is no period, runs the pipelines over them (history, current, and the
current file again), and returns the ledger: every landed row has one fate, and a rerun
leaves no second row.
"""

import datetime as dt

from pyspark.sql import functions as F

from hearth.bindings import binding, table  # noqa: F401
from hearth.bindings.families import (
    HOME_SERIES, PANEL_SQL, _month_header, inventory_landed, hotness_landed, tracker_landed, investor_landed,
    weekly_landed, market_panel, series_wide,
)
from hearth.plans import specs as S
from hearth.plans.registry import registry, run_pipeline
from hearth.quality import read_ledger
from hearth.session import scratch_path, stage
from hearth.sinks import export_csv, read_table

RUNS = [dt.datetime(2025, 1, 15, 6, 30), dt.datetime(2025, 2, 15, 6, 30)]
SPLIT = "199701"
NO_PERIOD, BAD_PERIOD = 5, 6  # nations whose rows land without a valid period
LEDGER = ["table_name", "step", "action", "rows_read", "rows_loaded", "rows_older", "rows_excluded", "rows_blank",
          "rows_footer", "rows_quarantined", "values_rejected", "max_period"]


def _spoilt(landed, period: str, key: str, of_nation):
    """Some regions' rows without a period, some with another text in its place."""
    return landed.withColumn(period, F.when(F.col(key) == of_nation(NO_PERIOD), None)
                             .when(F.col(key) == of_nation(BAD_PERIOD), "not a period").otherwise(F.col(period)))


def _entry_sql(table: str, step: str, action: str, where: str, read: str, loaded: str, older: str, footer: int, newest: str) -> str:
    bad = f"n_nationkey IN ({NO_PERIOD}, {BAD_PERIOD})"
    return f"""SELECT '{table}' AS table_name, '{step}' AS step, '{action}' AS action, count(*) FILTER (WHERE {read}) + {footer} AS rows_read,
       count(*) FILTER (WHERE {read} AND NOT {bad} AND {loaded}) AS rows_loaded,
       count(*) FILTER (WHERE {read} AND NOT {bad} AND {older}) AS rows_older, 0::BIGINT AS rows_excluded, 0::BIGINT AS rows_blank,
       {footer}::BIGINT AS rows_footer, count(*) FILTER (WHERE {read} AND {bad}) AS rows_quarantined,
       count(*) FILTER (WHERE {read} AND {bad}) AS values_rejected,
       max({newest}) FILTER (WHERE {read} AND NOT {bad} AND {loaded}) AS max_period
FROM {where}"""


YM = "CAST(strftime(month_start, '%Y%m') AS VARCHAR)"
BOUND = f"(SELECT max({YM}) FROM region_month WHERE {YM} < '{SPLIT}' AND n_nationkey NOT IN ({NO_PERIOD}, {BAD_PERIOD}))"
TOP = f"(SELECT max({YM}) FROM region_month WHERE n_nationkey NOT IN ({NO_PERIOD}, {BAD_PERIOD}))"


def _ledger(spark, lake):
    return read_ledger(spark, f"{lake}/ledger").select(*LEDGER)


@binding("accounting_inventory", f"""WITH {PANEL_SQL}
{_entry_sql("REALTOR_MNTHLY_ZIP", "history", "full", "region_month", f"{YM} < '{SPLIT}'", "true", "false", 1, YM)}
UNION ALL
{_entry_sql("REALTOR_MNTHLY_ZIP", "current", "append", "region_month", "true", f"{YM} > {BOUND}", f"{YM} <= {BOUND}", 1, YM)}""")
def accounting_inventory_q(spark, sf):
    """History into an empty table, then the current file, then the current file once more."""
    landed = inventory_landed(spark, sf, staged=True)
    base = scratch_path(spark, "accounting_inventory")
    landed = stage(landed.withColumn("m", F.col("month_date_yyyymm")), "accounting_landed")
    footer = F.col("m").startswith(S.FOOTER_TEXT[:12])
    spoilt = _spoilt(landed, "month_date_yyyymm", "postal_code", lambda n: str(n * 397 + 601))
    spec = registry()["inventory", "zip"]
    export_csv(spoilt.where((F.col("m") < SPLIT) | footer).drop("m"), f"{base}/landing/{spec.history}")
    export_csv(spoilt.drop("m"), f"{base}/landing/{spec.current}")
    for run in (RUNS[0], RUNS[1], RUNS[1]):
        run_pipeline(spark, spec, run, f"{base}/landing", f"{base}/lake")
    return _ledger(spark, f"{base}/lake")


@binding("quarantine_inventory", f"""WITH {PANEL_SQL}
SELECT 'history' AS step, CAST(n_nationkey * 397 + 601 AS VARCHAR) AS postal_code, 'month_date_yyyymm' AS column_name,
       CASE WHEN n_nationkey = {NO_PERIOD} THEN 'empty period' ELSE 'int' END AS declared_type,
       CASE WHEN n_nationkey = {BAD_PERIOD} THEN 'not a period' END AS raw_value
FROM region_month WHERE n_nationkey IN ({NO_PERIOD}, {BAD_PERIOD})
UNION ALL
SELECT 'history', CAST(n_nationkey * 397 + 601 AS VARCHAR), 'median_listing_price', 'double', 'n/a' FROM region_month WHERE n_nationkey = 7""")
def quarantine_inventory_q(spark, sf):
    """What the quarantine holds after the same run twice: rows without a valid period, and
    prices that are no numbers (their rows load with the default)."""
    landed = _spoilt(inventory_landed(spark, sf), "month_date_yyyymm", "postal_code", lambda n: str(n * 397 + 601))
    price = F.col("median_listing_price").cast("string")
    landed = landed.withColumn("median_listing_price", F.when(F.col("postal_code") == str(7 * 397 + 601), "n/a").otherwise(price))
    base = scratch_path(spark, "quarantine_inventory")
    spec = registry()["inventory", "zip"]
    for at in {spec.history, spec.current}:
        export_csv(landed, f"{base}/landing/{at}")
    run_pipeline(spark, spec, RUNS[0], f"{base}/landing", f"{base}/lake")
    from hearth.plans.families import run_inventory
    run_inventory(spark, "zip", f"{base}/landing/{spec.history}", f"{base}/lake/{spec.table}", RUNS[0], step="history",
                  quarantine_path=f"{base}/lake/quarantine/{spec.table}", ledger_path=f"{base}/lake/ledger")
    return read_table(spark, f"{base}/lake/quarantine/{spec.table}").select(
        "step", F.col("postal_code"), "column_name", "declared_type", "raw_value")


@binding("accounting_hotness", f"""WITH {PANEL_SQL}
{_entry_sql("REALTOR_MNTHLY_HOT_COUNTY", "history", "full", "region_month", f"{YM} < '{SPLIT}'", "true", "false", 1, YM)}
UNION ALL
{_entry_sql("REALTOR_MNTHLY_HOT_COUNTY", "current", "append", "region_month", "true", f"{YM} = {TOP}", f"{YM} <> {TOP}", 1, YM)}""")
def accounting_hotness_q(spark, sf):
    """One file with all periods that grows: only its newest period is appended."""
    landed = stage(hotness_landed(spark, sf, "county", staged=True).withColumn("m", F.col("month_date_yyyymm")), "accounting_landed")
    footer = F.col("m").startswith(S.FOOTER_TEXT[:12])
    spoilt = _spoilt(landed, "month_date_yyyymm", "county_fips", lambda n: str(n * 2 + 1001))
    base = scratch_path(spark, "accounting_hotness")
    spec = registry()["hotness", "county"]
    export_csv(spoilt.where((F.col("m") < SPLIT) | footer).drop("m"), f"{base}/landing/{spec.history}")
    run_pipeline(spark, spec, RUNS[0], f"{base}/landing", f"{base}/lake")
    export_csv(spoilt.drop("m"), f"{base}/landing/{spec.history}")
    for run in (RUNS[1], RUNS[1]):
        run_pipeline(spark, spec, run, f"{base}/landing", f"{base}/lake")
    return _ledger(spark, f"{base}/lake")


DAY = "CAST(month_start AS VARCHAR)"


@binding("accounting_tracker", f"""WITH {PANEL_SQL}
{_entry_sql("REDFIN_MNTHLY_HOUSING_STATE", "history", "full", "panel", "true", "true", "false", 0, DAY)}""")
def accounting_tracker_q(spark, sf):
    """Gzip TSV files with lines above their headers; the second run finds nothing newer and
    leaves the first run's row."""
    landed = tracker_landed(spark, sf)
    landed = _spoilt(landed.withColumn("period_begin", F.col("period_begin").cast("string")), "period_begin", "table_id", lambda n: n)
    base = scratch_path(spark, "accounting_tracker")
    spec = registry()["tracker", "state"]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in landed.columns]
    body = landed.select(F.year("period_end").alias("grp"), F.lit(2).alias("ord"), F.concat_ws("\t", *text).alias("line"))
    groups = body.select("grp").distinct()
    head = groups.select("grp", F.lit(1).alias("ord"), F.lit("\t".join(landed.columns)).alias("line"))
    junk = groups.select("grp", F.lit(0).alias("ord"), F.concat(F.lit("Report of "), F.col("grp").cast("string")).alias("line"))
    lines = body.unionByName(head).unionByName(junk).repartition("grp").sortWithinPartitions("grp", "ord").select("line", "grp")
    lines.write.partitionBy("grp").option("compression", "gzip").text(f"{base}/landing/{spec.history}")
    for run in (RUNS[0], RUNS[0]):
        run_pipeline(spark, spec, run, f"{base}/landing", f"{base}/lake")
    return _ledger(spark, f"{base}/lake").where("rows_loaded > 0")


@binding("accounting_investor", f"""WITH {PANEL_SQL},
q AS (SELECT n_nationkey, date_trunc('quarter', month_start) AS qs FROM region_month GROUP BY ALL)
SELECT 'REDFIN_INVESTOR_BY_QUARTER' AS table_name, 'replace' AS step, 'replace' AS action,
       count(*) + count(DISTINCT qs) AS rows_read, count(*) FILTER (WHERE n_nationkey <> 9) AS rows_loaded, 0::BIGINT AS rows_older,
       0::BIGINT AS rows_excluded, count(DISTINCT qs) AS rows_blank, 0::BIGINT AS rows_footer,
       count(*) FILTER (WHERE n_nationkey = 9) AS rows_quarantined, count(*) FILTER (WHERE n_nationkey = 9) AS values_rejected,
       CAST(NULL AS VARCHAR) AS max_period FROM q""")
def accounting_investor_q(spark, sf):
    """Blank rows after every block, and a metro whose rows have no number."""
    landed = investor_landed(spark, sf)
    ninth = F.pmod(F.col("row_no"), F.lit(100)) == 9
    landed = landed.withColumn("row_no", F.when(ninth, "?").otherwise(F.col("row_no").cast("string")))
    base = scratch_path(spark, "accounting_investor")
    spec = registry()["investor", "metro"]
    export_csv(landed, f"{base}/landing/{spec.history}")
    for _ in range(2):
        run_pipeline(spark, spec, RUNS[0], f"{base}/landing", f"{base}/lake")
    return _ledger(spark, f"{base}/lake")


def _series_entry_sql(status: str, label: str) -> str:
    state = "CASE WHEN n_regionkey = 1 THEN 'MA' ELSE substr(r_name, 1, 2) END"
    one = f"(SELECT DISTINCT n_nationkey, n_regionkey, r_name FROM panel WHERE status = '{status}')"
    return f"""SELECT 'ZW_HOME_VALUES' AS table_name, '{label.replace("'", "''")}' AS step, 'replace' AS action, count(*) AS rows_read,
       count(*) FILTER (WHERE {state} = 'MA' AND n_nationkey <> 2) AS rows_loaded, 0::BIGINT AS rows_older,
       count(*) FILTER (WHERE {state} <> 'MA') AS rows_excluded, 0::BIGINT AS rows_blank, 0::BIGINT AS rows_footer,
       count(*) FILTER (WHERE {state} = 'MA' AND n_nationkey = 2) AS rows_quarantined,
       count(*) FILTER (WHERE {state} = 'MA' AND n_nationkey = 2) AS values_rejected, CAST(NULL AS VARCHAR) AS max_period FROM {one}"""


LISTED = {s: label for s, label in HOME_SERIES.items() if any(label == t for _, t, _ in S.SERIES_LOOKUP)}


@binding("accounting_series", f"WITH {PANEL_SQL}\n" + "\nUNION ALL\n".join(_series_entry_sql(s, label) for s, label in LISTED.items()))
def accounting_series_q(spark, sf):
    """One ledger row for each labelled file: regions of other states are left out on purpose,
    one region has no whole-number id."""
    panel = market_panel(spark, sf, staged=True)
    base = scratch_path(spark, "accounting_series")
    spec = registry("MA")["home_values", "zip"]
    headers = {r["status"]: sorted(r["h"]) for r in panel.groupBy("status").agg(F.collect_set(_month_header()).alias("h")).collect()}
    for label, where in spec.labels:
        status = next((s for s, text in LISTED.items() if text == label), None)
        if status:
            wide = series_wide(panel, status, headers[status])
            wide = wide.withColumn("RegionID", F.when(F.col("RegionID") == "1002", "unknown").otherwise(F.col("RegionID")))
            export_csv(wide, f"{base}/landing/{where}")
    for _ in range(2):
        run_pipeline(spark, spec, RUNS[0], f"{base}/landing", f"{base}/lake")
    return _ledger(spark, f"{base}/lake")


@binding("accounting_weekly", f"""WITH {PANEL_SQL}
{_entry_sql("REDFIN_WEEKLY", "returned", "returned", "region_month", "true", "true", "false", 0, DAY)}""")
def accounting_weekly_q(spark, sf):
    landed = weekly_landed(spark, sf).withColumn("period_begin", F.col("period_begin").cast("string"))
    landed = _spoilt(landed, "period_begin", "region_id", lambda n: n)
    base = scratch_path(spark, "accounting_weekly")
    spec = registry()["weekly", "county"]
    export_csv(landed, f"{base}/landing/{spec.history}", sep="\t")
    for _ in range(2):
        run_pipeline(spark, spec, RUNS[0], f"{base}/landing", f"{base}/lake")
    return _ledger(spark, f"{base}/lake")
