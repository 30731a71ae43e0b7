"""Source families run on a market panel derived from the benchmark tables.

The panel is what the published housing files are: one row per region and
month (and property type) with levels, plus month-over-month, year-over-year
and versus-national changes. It is built from lineitem, orders, customer,
nation and region (lines pre-aggregated per order before the big join), so
its cost grows with the tables. Each family then runs its real transform on
a landed frame shaped like its source file, and the oracle SQL recomputes the
same target layout in DuckDB.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.session import stage
from hearth.functions import yyyymm
from hearth.operators import pivot_wide
from hearth.plans import families as fam
from hearth.plans import specs as S

RUN_TS = dt.datetime(2025, 1, 15, 6, 30, 0)
RUN_DATE = dt.date(2025, 1, 15)

# ---------------------------------------------------------------------------
# Panel (Spark)

PANEL_KEYS = ["n_nationkey", "n_name", "n_regionkey", "r_name"]


def market_panel(spark, sf, staged: bool = False) -> DataFrame:
    """(nation, month, order status) -> exact aggregates of the order lines.

    The panel has one row per region, month and status however large the
    tables grow. Families that read it several times (pivot headers,
    fill-down bucket sizing) stage it as a table in the shared folder, so the
    big join runs once and a lost executor never re-runs it; single readers
    keep it inline in one plan."""
    li = table(spark, sf, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("units"),
        F.max("l_extendedprice").alias("top_price"), F.min("l_extendedprice").alias("low_price"),
        F.count_if(F.col("l_tax") > 0.04).alias("taxed"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.min("l_discount").alias("min_disc"), F.max("l_shipdate").alias("last_ship"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    geo = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(*PANEL_KEYS)
    j = (per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    panel = j.groupBy(*PANEL_KEYS, F.col("o_orderstatus").alias("status"),
                     F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month_start")).agg(
        F.sum("lines").alias("homes_sold"), F.sum("units").alias("units"), F.max("top_price").alias("top_price"),
        F.min("low_price").alias("low_price"), F.count(F.lit(1)).alias("orders"), F.sum("taxed").alias("taxed"),
        F.sum("discounted").alias("discounted"), F.sum("open_lines").alias("open"),
        F.sum("returned").alias("returned"), F.min("min_disc").alias("min_disc"),
        F.max(F.datediff(F.col("last_ship").cast("date"), F.col("o_orderdate").cast("date"))).alias("max_days"),
        F.max("o_orderdate").alias("last_order"))
    return stage(panel, "market_panel") if staged else panel


def region_month(panel: DataFrame) -> DataFrame:
    """The panel summed over order status: (nation, month)."""
    return panel.groupBy(*PANEL_KEYS, "month_start").agg(
        F.sum("homes_sold").alias("homes_sold"), F.sum("units").alias("units"), F.max("top_price").alias("top_price"),
        F.min("low_price").alias("low_price"), F.sum("orders").alias("orders"), F.sum("taxed").alias("taxed"),
        F.sum("discounted").alias("discounted"), F.sum("open").alias("open"), F.sum("returned").alias("returned"),
        F.min("min_disc").alias("min_disc"), F.max("max_days").alias("max_days"))


def _div(a, b):
    return F.try_divide(a, b)


def _ratio_change(x: str, w, k: int):
    return F.try_divide(F.col(x), F.lag(x, k).over(w)) - 1


def _point_change(x: str, w, k: int):
    return F.col(x) - F.lag(x, k).over(w)


# ---------------------------------------------------------------------------
# Panel (SQL)

PANEL_SQL = """per_order AS (
  SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS units, max(l_extendedprice) AS top_price,
         min(l_extendedprice) AS low_price, count(*) FILTER (WHERE l_tax > 0.04) AS taxed,
         count(*) FILTER (WHERE l_discount > 0.05) AS discounted, count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned, min(l_discount) AS min_disc, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
panel AS (
  SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name, o.o_orderstatus AS status,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month_start,
         CAST(sum(p.lines) AS BIGINT) AS homes_sold, sum(p.units) AS units, max(p.top_price) AS top_price,
         min(p.low_price) AS low_price, CAST(count(*) AS BIGINT) AS orders, CAST(sum(p.taxed) AS BIGINT) AS taxed,
         CAST(sum(p.discounted) AS BIGINT) AS discounted, CAST(sum(p.open_lines) AS BIGINT) AS open,
         CAST(sum(p.returned) AS BIGINT) AS returned, min(p.min_disc) AS min_disc,
         max(datediff('day', CAST(o.o_orderdate AS DATE), CAST(p.last_ship AS DATE))) AS max_days,
         max(o.o_orderdate) AS last_order
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY n.n_nationkey, n.n_name, n.n_regionkey, r.r_name, o.o_orderstatus, CAST(date_trunc('month', o.o_orderdate) AS DATE)),
region_month AS (
  SELECT n_nationkey, n_name, n_regionkey, r_name, month_start, CAST(sum(homes_sold) AS BIGINT) AS homes_sold,
         sum(units) AS units, max(top_price) AS top_price, min(low_price) AS low_price, CAST(sum(orders) AS BIGINT) AS orders,
         CAST(sum(taxed) AS BIGINT) AS taxed, CAST(sum(discounted) AS BIGINT) AS discounted, CAST(sum(open) AS BIGINT) AS open,
         CAST(sum(returned) AS BIGINT) AS returned, min(min_disc) AS min_disc, max(max_days) AS max_days
  FROM panel GROUP BY n_nationkey, n_name, n_regionkey, r_name, month_start)"""


def _w(part: str) -> str:
    return f"OVER (PARTITION BY {part} ORDER BY month_start)"


def _sql_ratio(x: str, part: str, k: int) -> str:
    return f"{x} / NULLIF(lag({x}, {k}) {_w(part)}, 0) - 1"


def _sql_point(x: str, part: str, k: int) -> str:
    return f"{x} - lag({x}, {k}) {_w(part)}"


def _cols(items) -> str:
    return ",\n    ".join(items)


# ---------------------------------------------------------------------------
# Housing tracker

TRACKER_LEVELS = [
    ("median_sale_price", "top_price"),
    ("median_list_price", "low_price"),
    ("median_ppsf", "top_price / NULLIF(units, 0)"),
    ("median_list_ppsf", "min_disc * 100"),
    ("homes_sold", "CAST(homes_sold AS DOUBLE)"),
    ("pending_sales", "CAST(open AS DOUBLE)"),
    ("new_listings", "CAST(orders AS DOUBLE)"),
    ("inventory", "units"),
    ("months_of_supply", "units / NULLIF(homes_sold, 0)"),
    ("median_dom", "CAST(max_days AS DOUBLE)"),
    ("avg_sale_to_list", "low_price / NULLIF(top_price, 0)"),
    ("sold_above_list", "taxed / NULLIF(homes_sold, 0)"),
    ("price_drops", "discounted / NULLIF(homes_sold, 0)"),
    ("off_market_in_two_weeks", "returned / NULLIF(homes_sold, 0)"),
]


def _tracker_levels_spark():
    c = F.col
    return [c("top_price"), c("low_price"), _div(c("top_price"), c("units")), c("min_disc") * 100,
            c("homes_sold").cast("double"), c("open").cast("double"), c("orders").cast("double"), c("units"),
            _div(c("units"), c("homes_sold")), c("max_days").cast("double"), _div(c("low_price"), c("top_price")),
            _div(c("taxed"), c("homes_sold")), _div(c("discounted"), c("homes_sold")),
            _div(c("returned"), c("homes_sold"))]


def tracker_landed(spark, sf, staged: bool = False) -> DataFrame:
    """A housing-tracker file: one row per (region, month, property type)."""
    p = market_panel(spark, sf, staged)
    names = [n for n, _ in TRACKER_LEVELS]
    lv = p.select(*PANEL_KEYS, "status", "month_start", "last_order",
                  *[e.alias(n) for n, e in zip(names, _tracker_levels_spark())])
    w = Window.partitionBy("n_nationkey", "status").orderBy("month_start")
    changes = []
    for m in names:
        rule = _ratio_change if m in S.TRACKER_RATIO_MEASURES else _point_change
        changes += [rule(m, w, 1).alias(f"{m}_mom"), rule(m, w, 12).alias(f"{m}_yoy")]
    st = F.col("status")
    return lv.select(
        F.col("month_start").alias("period_begin"), F.last_day("month_start").alias("period_end"),
        (F.datediff(F.last_day("month_start"), F.col("month_start")) + 1).alias("period_duration"),
        F.lit("nation").alias("region_type"),
        F.when(F.col("n_regionkey") != 0, F.col("n_regionkey")).alias("region_type_id"),
        F.col("n_nationkey").alias("table_id"),
        F.when(st == "F", "t").otherwise("f").alias("is_seasonally_adjusted"),
        F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")).alias("region"),
        F.lit(None).cast("string").alias("city"),
        F.when(F.col("n_nationkey") == 24, F.lit("U.S.")).otherwise(F.col("r_name")).alias("state"),
        F.when(F.col("n_regionkey") != 0, F.substring("r_name", 1, 2)).alias("state_code"),
        F.when(st == "F", "All Residential").when(st == "O", "Condo/Co-op").otherwise("Townhouse").alias("property_type"),
        F.when(st == "F", "-1").when(st == "O", "3").otherwise("n/a").alias("property_type_id"),
        *[F.col(m) for m in names], *changes,
        F.col("r_name").alias("parent_metro_region"),
        F.when(F.col("n_regionkey") != 0, F.col("n_regionkey").cast("string")).alias("parent_metro_region_metro_code"),
        F.col("last_order").alias("last_updated"))


def tracker_sql() -> str:
    part = "n_nationkey, status"
    names = [n for n, _ in TRACKER_LEVELS]
    changes = []
    for m in names:
        rule = _sql_ratio if m in S.TRACKER_RATIO_MEASURES else _sql_point
        changes += [f"{rule(m, part, 1)} AS {m}_mom", f"{rule(m, part, 12)} AS {m}_yoy"]
    landed = [
        "month_start AS period_begin", "last_day(month_start) AS period_end",
        "datediff('day', month_start, last_day(month_start)) + 1 AS period_duration",
        "'nation' AS region_type", "CASE WHEN n_regionkey <> 0 THEN n_regionkey END AS region_type_id",
        "n_nationkey AS table_id", "CASE WHEN status = 'F' THEN 't' ELSE 'f' END AS is_seasonally_adjusted",
        "'  ' || n_name || ' ' AS region", "CAST(NULL AS VARCHAR) AS city",
        "CASE WHEN n_nationkey = 24 THEN 'U.S.' ELSE r_name END AS state",
        "CASE WHEN n_regionkey <> 0 THEN substr(r_name, 1, 2) END AS state_code",
        "CASE WHEN status = 'F' THEN 'All Residential' WHEN status = 'O' THEN 'Condo/Co-op' ELSE 'Townhouse' END AS property_type",
        "CASE WHEN status = 'F' THEN '-1' WHEN status = 'O' THEN '3' ELSE 'n/a' END AS property_type_id",
        *names, *changes,
        "r_name AS parent_metro_region",
        "CASE WHEN n_regionkey <> 0 THEN CAST(n_regionkey AS VARCHAR) END AS parent_metro_region_metro_code",
        "last_order AS last_updated"]
    measure_cols = names + [f"{m}_mom" for m in names] + [f"{m}_yoy" for m in names]
    clean = (["CAST(period_begin AS DATE) AS period_begin", "CAST(period_end AS DATE) AS period_end"]
             + [f"coalesce(CAST({c} AS INTEGER), 0) AS {c}" for c in S.TRACKER_INT_DEFAULTS]
             + [f"coalesce(trim(CAST({c} AS VARCHAR)), 'NA') AS {c}" for c in S.TRACKER_TEXT_TRIMMED]
             + ["replace(coalesce(trim(CAST(state AS VARCHAR)), 'NA'), 'U.S.', 'US') AS state",
                "coalesce(abs(TRY_CAST(property_type_id AS INTEGER)), 0) AS property_type_id"]
             + [f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in measure_cols]
             + [f"coalesce(CAST({c} AS VARCHAR), 'NA') AS {c}" for c in S.TRACKER_TEXT_UNTRIMMED]
             + ["CAST(last_updated AS TIMESTAMP) AS last_updated"])
    ident = ["period_begin", "period_end", "period_duration", "region_type", "region_type_id", "table_id",
             "is_seasonally_adjusted", "region", "city", "state", "state_code", "property_type", "property_type_id"]
    prior = list(ident) + names
    for suffix, src in (("_lm", "_mom"), ("_ly", "_yoy")):
        for m in names:
            if m in S.TRACKER_RATIO_MEASURES:
                prior.append(f"{m} / NULLIF(1 + {m}{src}, 0) AS {m}{suffix}")
            elif m in S.TRACKER_SUM_MEASURES:
                prior.append(f"{m} + {m}{src} AS {m}{suffix}")
            else:
                prior.append(f"{m} - {m}{src} AS {m}{suffix}")
    prior += S.TRACKER_TEXT_UNTRIMMED + ["last_updated"]
    publish = list(ident)
    for suffix in ("", "_lm", "_ly"):
        def v(n):
            return f"coalesce({n}{suffix}, 0)"
        for m in S.TRACKER_RATIO_MEASURES + ["months_of_supply", "median_dom", "avg_sale_to_list"]:
            if m in S.TRACKER_FOUR_PLACES:
                publish.append(f"round({v(m)}, 4) AS {m}{suffix}")
            else:
                publish.append(f"CAST(round({v(m)}, 0) AS INTEGER) AS {m}{suffix}")
        for rate, out in S.TRACKER_RATE_COUNTS:
            publish.append(f"CAST(round({v(rate)} * {v('homes_sold')}, 0) AS INTEGER) AS {out}{suffix}")
        for out, price, ppsf in S.TRACKER_SIZES:
            publish.append(f"CAST(CASE WHEN {v(ppsf)} = 0 THEN 0 ELSE round({v(price)} / {v(ppsf)}, 0) END AS INTEGER)"
                           f" AS {out}{suffix}")
    publish += S.TRACKER_TEXT_UNTRIMMED + ["last_updated", "'2025-01-15 06:30' AS nk_update_date"]
    levels = [f"{e} AS {n}" for n, e in TRACKER_LEVELS]
    return (f"WITH {PANEL_SQL},\nlv AS (SELECT n_nationkey, n_name, n_regionkey, r_name, status, month_start, last_order,\n"
            f"    {_cols(levels)} FROM panel),\n"
            f"landed AS (SELECT {_cols(landed)} FROM lv),\n"
            f"clean AS (SELECT {_cols(clean)} FROM landed),\n"
            f"prior AS (SELECT {_cols(prior)} FROM clean)\n"
            f"SELECT {_cols(publish)} FROM prior")


@binding("family_housing_tracker", tracker_sql())
def family_housing_tracker_q(spark, sf):
    return fam.tracker_transform(tracker_landed(spark, sf), RUN_TS)


# ---------------------------------------------------------------------------
# Monthly inventory (zip level: padded postal code, state from 'place, ST')

INVENTORY_LEVELS = [
    ("median_listing_price", "top_price"),
    ("active_listing_count", "units"),
    ("median_days_on_market", "CAST(max_days AS DOUBLE)"),
    ("new_listing_count", "CAST(orders AS DOUBLE)"),
    ("price_increased_count", "CAST(taxed AS DOUBLE)"),
    ("price_reduced_count", "CAST(discounted AS DOUBLE)"),
    ("pending_listing_count", "CAST(open AS DOUBLE)"),
    ("median_listing_price_per_square_foot", "top_price / NULLIF(units, 0)"),
    ("median_square_feet", "units / NULLIF(orders, 0)"),
    ("average_listing_price", "low_price"),
    ("total_listing_count", "CAST(homes_sold AS DOUBLE)"),
    ("pending_ratio", "open / NULLIF(homes_sold, 0)"),
]


def _inventory_levels_spark():
    c = F.col
    return [c("top_price"), c("units"), c("max_days").cast("double"), c("orders").cast("double"),
            c("taxed").cast("double"), c("discounted").cast("double"), c("open").cast("double"),
            _div(c("top_price"), c("units")), _div(c("units"), c("orders")), c("low_price"),
            c("homes_sold").cast("double"), _div(c("open"), c("homes_sold"))]


def _zip_columns_spark():
    return [(F.col("n_nationkey") * 397 + 601).cast("string").alias("postal_code"),
            F.when(F.col("n_nationkey") == 3, F.col("n_name"))
             .otherwise(F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"))).alias("zip_name")]


ZIP_SQL = ["CAST(n_nationkey * 397 + 601 AS VARCHAR) AS postal_code",
           "CASE WHEN n_nationkey = 3 THEN n_name ELSE n_name || ', ' || r_name END AS zip_name"]
PAD_SQL = "CASE WHEN length(postal_code) < 5 THEN lpad(postal_code, 5, '0') ELSE postal_code END"


# Key columns of the other levels: landed (Spark, SQL) and, in SQL, as they are loaded.
def _geo_columns_spark(geo: str):
    c = F.col
    place = F.concat(c("n_name"), F.lit(", "), c("r_name"))
    return {
        "zip": _zip_columns_spark,
        "state": lambda: [c("n_name").alias("state"), F.when(c("n_regionkey") != 0, F.substring("r_name", 1, 2)).alias("state_id")],
        "metro": lambda: [(c("n_nationkey") * 10 + 10000).cast("string").alias("cbsa_code"), place.alias("cbsa_title"),
                          (c("n_nationkey") + 1).cast("string").alias("HouseholdRank")],
        "county": lambda: [(c("n_nationkey") * 2 + 1001).cast("string").alias("county_fips"),
                           F.when(c("n_nationkey") != 3, F.lower("n_name")).alias("county_name"),
                           (c("n_nationkey") * 10 + 10000).cast("string").alias("cbsa_code"),
                           F.when(c("n_regionkey") != 0, place).alias("cbsa_title")],
    }[geo]()


GEO_SQL = {
    "state": ["n_name AS state", "CASE WHEN n_regionkey <> 0 THEN substr(r_name, 1, 2) END AS state_id"],
    "metro": ["n_nationkey * 10 + 10000 AS cbsa_code", "n_name || ', ' || r_name AS cbsa_title", "n_nationkey + 1 AS HouseholdRank"],
    "county": ["n_nationkey * 2 + 1001 AS county_fips", "CASE WHEN n_nationkey <> 3 THEN lower(n_name) END AS county_name",
               "n_nationkey * 10 + 10000 AS cbsa_code", "CASE WHEN n_regionkey <> 0 THEN n_name || ', ' || r_name END AS cbsa_title"],
}


def _geo_out_sql(geo: S.Geography) -> list[str]:
    return [f"coalesce({k}, '') AS {k}" if t == "string" else f"CAST({k} AS INTEGER) AS {k}" for k, t in geo.keys]


def _with_footer(spark, landed: DataFrame) -> DataFrame:
    """The published files end with a disclaimer line in the period column."""
    footer = spark.createDataFrame([(S.FOOTER_TEXT,)], "month_date_yyyymm string")
    return landed.unionByName(footer, allowMissingColumns=True)


def inventory_landed(spark, sf, geo: str = "zip", staged: bool = False) -> DataFrame:
    rm = region_month(market_panel(spark, sf, staged))
    names = [n for n, _ in INVENTORY_LEVELS]
    lv = rm.select(*PANEL_KEYS, "month_start", "returned", "taxed",
                   *[e.alias(n) for n, e in zip(names, _inventory_levels_spark())])
    w = Window.partitionBy("n_nationkey").orderBy("month_start")
    changes = []
    for m in names:
        changes += [_ratio_change(m, w, 1).alias(f"{m}_mm"), _ratio_change(m, w, 12).alias(f"{m}_yy")]
    landed = lv.select(yyyymm("month_start").cast("string").alias("month_date_yyyymm"), *_geo_columns_spark(geo),
                       *[F.col(m) for m in names], *changes,
                       F.when(F.col("returned") > F.col("taxed"), F.lit(1.0)).alias("quality_flag"))
    return _with_footer(spark, landed)


def inventory_sql(geo: str = "zip") -> str:
    names = [n for n, _ in INVENTORY_LEVELS]
    levels = [f"{e} AS {n}" for n, e in INVENTORY_LEVELS]
    changes = []
    for m in names:
        changes += [f"{_sql_ratio(m, 'n_nationkey', 1)} AS {m}_mm", f"{_sql_ratio(m, 'n_nationkey', 12)} AS {m}_yy"]
    landed = (["CAST(strftime(month_start, '%Y%m') AS INTEGER) AS month_date_yyyymm"] + GEO_SQL.get(geo, ZIP_SQL) + names + changes
              + ["CASE WHEN returned > taxed THEN 1.0 END AS quality_flag"])
    keys = [f"{PAD_SQL} AS zip_code", "string_split(zip_name, ', ')[-1] AS state"] if geo == "zip" else \
        _geo_out_sql(S.INVENTORY_GEOGRAPHIES[geo])
    out = ["month_date_yyyymm", *keys]
    out += [f"CAST(trunc(coalesce({m}, 0)) AS INTEGER) AS {m}" if m == "median_listing_price"
            else f"coalesce({m}, 0) AS {m}" for m in names]
    out.append("CAST(coalesce(quality_flag, 0) AS INTEGER) AS quality_flag")
    for suffix, src in (("_ly", "_yy"), ("_lm", "_mm")):
        for m in names:
            v = f"coalesce({m} / NULLIF(1 + {m}{src}, 0), 0)"
            out.append(f"{v} AS {m}{suffix}" if f"{m}{suffix}" == "pending_ratio_lm"
                       else f"round_even({v}, 0) AS {m}{suffix}")
    out.append("TIMESTAMP '2025-01-15 06:30:00' AS Update_Date")
    return (f"WITH {PANEL_SQL},\nlv AS (SELECT n_nationkey, n_name, n_regionkey, r_name, month_start, returned, taxed,\n"
            f"    {_cols(levels)} FROM region_month),\n"
            f"landed AS (SELECT {_cols(landed)} FROM lv)\n"
            f"SELECT {_cols(out)} FROM landed")


@binding("family_inventory", inventory_sql())
def family_inventory_q(spark, sf):
    return fam.inventory_transform(inventory_landed(spark, sf), S.INVENTORY_GEOGRAPHIES["zip"], RUN_TS)


def _inventory_at(geo: str):
    @binding(f"family_inventory_{geo}", inventory_sql(geo))
    def at_this_level(spark, sf):
        return fam.inventory_transform(inventory_landed(spark, sf, geo), S.INVENTORY_GEOGRAPHIES[geo], RUN_TS)


for _geo in ("state", "metro", "county"):
    _inventory_at(_geo)


# ---------------------------------------------------------------------------
# Monthly hotness

def hotness_landed(spark, sf, geo: str = "zip", staged: bool = False) -> DataFrame:
    rm = region_month(market_panel(spark, sf, staged))
    w = Window.partitionBy("n_nationkey").orderBy("month_start")
    month = Window.partitionBy("month_start")
    c = F.col
    base = rm.select(
        *PANEL_KEYS, "month_start", "returned", "taxed",
        (c("n_nationkey") + 1).cast("double").alias("hh_rank"),
        F.rank().over(Window.partitionBy("month_start").orderBy(c("units").desc())).cast("double").alias("hotness_rank"),
        (_div(c("units"), c("homes_sold")) * 10).alias("hotness_score"),
        (_div(c("open"), c("homes_sold")) * 100).alias("supply_score"),
        (_div(c("taxed"), c("homes_sold")) * 100).alias("demand_score"),
        c("max_days").cast("double").alias("median_days_on_market"),
        F.max("max_days").over(month).alias("us_days"),
        c("orders").cast("double").alias("views"), F.max("orders").over(month).alias("us_views"),
        c("top_price").alias("median_listing_price"), F.max("top_price").over(month).alias("us_price"))
    landed = base.select(
        yyyymm("month_start").cast("string").alias("month_date_yyyymm"), *_geo_columns_spark(geo), "hh_rank",
        "hotness_rank", _point_change("hotness_rank", w, 1).alias("hotness_rank_mm"),
        _point_change("hotness_rank", w, 12).alias("hotness_rank_yy"),
        "hotness_score", "supply_score", "demand_score", "median_days_on_market",
        _ratio_change("median_days_on_market", w, 1).alias("median_days_on_market_mm"),
        _ratio_change("median_days_on_market", w, 12).alias("median_days_on_market_yy"),
        _point_change("median_days_on_market", w, 1).alias("median_dom_mm_day"),
        _point_change("median_days_on_market", w, 12).alias("median_dom_yy_day"),
        (c("median_days_on_market") - c("us_days")).alias("median_dom_vs_us"),
        _ratio_change("views", w, 1).alias("page_view_count_per_property_mm"),
        _ratio_change("views", w, 12).alias("page_view_count_per_property_yy"),
        (_div(c("views"), c("us_views")) - 1).alias("page_view_count_per_property_vs_us"),
        "median_listing_price",
        _ratio_change("median_listing_price", w, 1).alias("median_listing_price_mm"),
        _ratio_change("median_listing_price", w, 12).alias("median_listing_price_yy"),
        (_div(c("median_listing_price"), c("us_price")) - 1).alias("median_listing_price_vs_us"),
        F.when(c("returned") > c("taxed"), F.lit(1.0)).alias("quality_flag"))
    return _with_footer(spark, landed)


def hotness_sql(geo: str = "zip") -> str:
    p = "n_nationkey"
    base = ["n_nationkey", "n_name", "n_regionkey", "r_name", "month_start", "returned", "taxed",
            "CAST(n_nationkey + 1 AS DOUBLE) AS hh_rank",
            "CAST(rank() OVER (PARTITION BY month_start ORDER BY units DESC) AS DOUBLE) AS hotness_rank",
            "units / NULLIF(homes_sold, 0) * 10 AS hotness_score",
            "open / NULLIF(homes_sold, 0) * 100 AS supply_score",
            "taxed / NULLIF(homes_sold, 0) * 100 AS demand_score",
            "CAST(max_days AS DOUBLE) AS median_days_on_market",
            "max(max_days) OVER (PARTITION BY month_start) AS us_days",
            "CAST(orders AS DOUBLE) AS views", "max(orders) OVER (PARTITION BY month_start) AS us_views",
            "top_price AS median_listing_price", "max(top_price) OVER (PARTITION BY month_start) AS us_price"]
    landed = ["CAST(strftime(month_start, '%Y%m') AS INTEGER) AS month_date_yyyymm", *GEO_SQL.get(geo, ZIP_SQL), "hh_rank",
              "hotness_rank", f"{_sql_point('hotness_rank', p, 1)} AS hotness_rank_mm",
              f"{_sql_point('hotness_rank', p, 12)} AS hotness_rank_yy",
              "hotness_score", "supply_score", "demand_score", "median_days_on_market",
              f"{_sql_point('median_days_on_market', p, 1)} AS median_dom_mm_day",
              f"{_sql_point('median_days_on_market', p, 12)} AS median_dom_yy_day",
              "median_days_on_market - us_days AS median_dom_vs_us",
              f"{_sql_ratio('views', p, 1)} AS page_view_count_per_property_mm",
              f"{_sql_ratio('views', p, 12)} AS page_view_count_per_property_yy",
              "views / NULLIF(us_views, 0) - 1 AS page_view_count_per_property_vs_us",
              "median_listing_price",
              f"{_sql_ratio('median_listing_price', p, 1)} AS median_listing_price_mm",
              f"{_sql_ratio('median_listing_price', p, 12)} AS median_listing_price_yy",
              "median_listing_price / NULLIF(us_price, 0) - 1 AS median_listing_price_vs_us",
              "CASE WHEN returned > taxed THEN 1.0 END AS quality_flag"]
    dec = "DECIMAL(12, 4)"

    def z(e):
        return f"coalesce({e}, 0)"

    def r2(e):
        return f"round_even({e}, 2)"

    def r4(e):
        return f"round_even({e}, 4)"
    keys = [f"{PAD_SQL} AS zip_code", "coalesce(zip_name, '') AS zip_name"] if geo == "zip" else \
        _geo_out_sql(S.HOTNESS_GEOGRAPHIES[geo])
    out = ["month_date_yyyymm", *keys,
           f"CAST(trunc({z('hh_rank')}) AS INTEGER) AS household_count_rank",
           f"CAST(trunc({z(r2('hotness_rank'))}) AS INTEGER) AS hotness_rank",
           f"CAST({z(r4('hotness_score'))} AS {dec}) AS hotness_score",
           f"CAST({z(r4('supply_score'))} AS {dec}) AS supply_score",
           f"CAST({z(r4(r2('demand_score')))} AS {dec}) AS demand_score",
           f"CAST({z('median_days_on_market')} AS {dec}) AS median_days_on_market",
           *[f"CAST({z(r4(c))} AS {dec}) AS {c}" for c in S.HOTNESS_PAGE_VIEWS],
           f"CAST(trunc({z('median_listing_price')}) AS INTEGER) AS median_listing_price",
           f"CAST({z('quality_flag')} AS INTEGER) AS quality_flag",
           f"CAST(trunc({z(r2('hotness_rank + hotness_rank_mm'))}) AS INTEGER) AS hotness_rank_lm",
           f"CAST(trunc({z(r2('hotness_rank - hotness_rank_yy'))}) AS INTEGER) AS hotness_rank_ly",
           f"CAST({z(r4('median_days_on_market - median_dom_yy_day'))} AS {dec}) AS median_days_on_market_ly",
           f"CAST({z(r4('median_days_on_market - median_dom_mm_day'))} AS {dec}) AS median_days_on_market_lm",
           f"CAST({z(r4('median_days_on_market - median_dom_vs_us'))} AS {dec}) AS median_days_on_market_us"]
    for suffix, src in (("_lm", "_mm"), ("_ly", "_yy"), ("_us", "_vs_us")):
        out.append(f"CAST(trunc({z(r2(f'median_listing_price / NULLIF(1 + median_listing_price{src}, 0)'))}) AS INTEGER)"
                   f" AS median_listing_price{suffix}")
    out.append("TIMESTAMP '2025-01-15 06:30:00' AS Update_Date")
    return (f"WITH {PANEL_SQL},\nbase AS (SELECT {_cols(base)} FROM region_month),\n"
            f"landed AS (SELECT {_cols(landed)} FROM base)\n"
            f"SELECT {_cols(out)} FROM landed")


@binding("family_hotness", hotness_sql())
def family_hotness_q(spark, sf):
    return fam.hotness_transform(hotness_landed(spark, sf), S.HOTNESS_GEOGRAPHIES["zip"], RUN_TS)


def _hotness_at(geo: str):
    @binding(f"family_hotness_{geo}", hotness_sql(geo))
    def at_this_level(spark, sf):
        return fam.hotness_transform(hotness_landed(spark, sf, geo), S.HOTNESS_GEOGRAPHIES[geo], RUN_TS)


for _geo in ("metro", "county"):
    _hotness_at(_geo)


# ---------------------------------------------------------------------------
# Investor purchases by quarter: an export whose quarter cell is filled only on
# the first row of each block, with a blank row after every block.

def investor_landed(spark, sf) -> DataFrame:
    rm = region_month(market_panel(spark, sf, staged=True))
    q = rm.groupBy("n_nationkey", "n_name", F.trunc("month_start", "quarter").alias("quarter_start")).agg(
        F.sum("taxed").alias("purchases"), F.sum("homes_sold").alias("lines"))
    w = Window.partitionBy("n_nationkey").orderBy("quarter_start")
    block = Window.partitionBy("quarter_start")
    qi = F.year("quarter_start") * 4 + F.quarter("quarter_start") - 1
    label = F.concat(F.year("quarter_start").cast("string"), F.lit(" Q"), F.quarter("quarter_start").cast("string"))
    rows = q.select(
        (qi * 100 + F.col("n_nationkey")).cast("long").alias("row_no"),
        F.when(F.col("n_nationkey") == F.min("n_nationkey").over(block), label).alias(S.INVESTOR_QUARTER),
        F.col("n_name").alias(S.INVESTOR_METRO),
        _div(F.col("purchases"), F.col("lines")).alias(S.INVESTOR_SHARE),
        F.col("purchases").cast("double").alias(S.INVESTOR_PURCHASES),
        (_div(F.col("purchases"), F.lag("purchases", 4).over(w)) - 1).alias(S.INVESTOR_YOY))
    blanks = q.select("quarter_start").distinct().select((qi * 100 + 99).cast("long").alias("row_no"))
    return rows.unionByName(blanks, allowMissingColumns=True)


def investor_sql() -> str:
    label = "CAST(year(quarter_start) AS VARCHAR) || ' Q' || CAST(quarter(quarter_start) AS VARCHAR)"
    pat = r"'^(\d{4}) Q([1-4])$'"
    return f"""WITH {PANEL_SQL},
q AS (SELECT n_nationkey, n_name, CAST(date_trunc('quarter', month_start) AS DATE) AS quarter_start,
             sum(taxed) AS purchases, sum(homes_sold) AS lines
      FROM region_month GROUP BY n_nationkey, n_name, CAST(date_trunc('quarter', month_start) AS DATE)),
landed AS (
  SELECT (year(quarter_start) * 4 + quarter(quarter_start) - 1) * 100 + n_nationkey AS row_no,
         CASE WHEN n_nationkey = min(n_nationkey) OVER (PARTITION BY quarter_start) THEN {label} END AS quarter_text,
         n_name AS metro, purchases / NULLIF(lines, 0) AS share, CAST(purchases AS DOUBLE) AS bought,
         purchases / NULLIF(lag(purchases, 4) OVER (PARTITION BY n_nationkey ORDER BY quarter_start), 0) - 1 AS yoy
  FROM q),
filled AS (
  SELECT *, last_value(quarter_text IGNORE NULLS) OVER (ORDER BY row_no
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qf
  FROM landed),
calc AS (
  SELECT qf, metro, share, bought, yoy,
         CASE WHEN share = 0 THEN 0 ELSE bought / NULLIF(share, 0) END AS total,
         CASE WHEN yoy = -1 THEN 0 ELSE bought / NULLIF(1 + yoy, 0) END AS ly
  FROM filled)
SELECT coalesce(qf, '') AS "Quarter",
       CASE WHEN regexp_matches(qf, {pat}) THEN make_date(CAST(regexp_extract(qf, {pat}, 1) AS INTEGER),
            (CAST(regexp_extract(qf, {pat}, 2) AS INTEGER) - 1) * 3 + 1, 1) END AS start_quarter_date,
       coalesce(metro, '') AS "Redfin Metro",
       round_even(coalesce(share, 0), 4) AS "Investor Market Share",
       coalesce(bought, 0) AS "Investor Purchases",
       round_even(coalesce(yoy, 0), 4) AS "Investor Purchases YoY",
       round_even(coalesce(total, 0), 4) AS total_purchases,
       round_even(coalesce(total - bought, 0), 4) AS non_investor_purchases,
       round_even(coalesce(ly, 0), 4) AS "Investor_Purchases_LY",
       TIMESTAMP '2025-01-15 06:30:00' AS "Update_Date"
FROM calc"""


@binding("family_investor_quarter", investor_sql())
def family_investor_quarter_q(spark, sf):
    return fam.investor_transform(investor_landed(spark, sf), RUN_TS)


# ---------------------------------------------------------------------------
# Weekly tracker

WEEKLY_MEASURES = [("adjusted_average_new_listings", "orders"), ("adjusted_average_homes_sold", "homes_sold")]


def weekly_landed(spark, sf) -> DataFrame:
    rm = region_month(market_panel(spark, sf))
    w = Window.partitionBy("n_nationkey").orderBy("month_start")
    lv = rm.select("n_nationkey", "n_name", "n_regionkey", "r_name", "month_start",
                   *[F.col(src).cast("double").alias(m) for m, src in WEEKLY_MEASURES])
    region = F.when(F.col("n_regionkey") == 0, F.col("n_name")) \
        .otherwise(F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"), F.lit(" metro area")))
    return lv.select(
        region.alias("region_name"), F.lit("metro").alias("region_type"), F.col("n_regionkey").alias("region_type_id"),
        F.col("n_nationkey").alias("region_id"), F.col("month_start").alias("period_begin"),
        F.last_day("month_start").alias("period_end"),
        F.when(F.col("n_regionkey") == 4, "1 weeks").otherwise("4 weeks").alias("duration"),
        *[c for m, _ in WEEKLY_MEASURES for c in (F.col(m), _ratio_change(m, w, 12).alias(f"{m}_yoy"))])


def weekly_sql() -> str:
    m0 = WEEKLY_MEASURES[0][0]
    meas = []
    for m, src in WEEKLY_MEASURES:
        meas += [f"round_even(CAST({src} AS DOUBLE), 4) AS {m}",
                 f"round_even(CAST({src} AS DOUBLE) / NULLIF(lag(CAST({src} AS DOUBLE), 12) {_w('n_nationkey')}, 0) - 1, 4)"
                 f" AS {m}_yoy"]
    landed = ["CASE WHEN n_regionkey = 0 THEN n_name ELSE n_name || ', ' || r_name || ' metro area' END AS region_name",
              "'metro' AS region_type", "n_regionkey AS region_type_id", "n_nationkey AS region_id",
              "month_start AS period_begin", "last_day(month_start) AS period_end",
              "CASE WHEN n_regionkey = 4 THEN 1 ELSE 4 END AS duration_weeks",
              f"CAST(orders AS DOUBLE) / NULLIF(1 + (CAST(orders AS DOUBLE) / NULLIF(lag(CAST(orders AS DOUBLE), 12) "
              f"{_w('n_nationkey')}, 0) - 1), 0) AS raw_ly"] + meas
    return f"""WITH {PANEL_SQL},
landed AS (SELECT {_cols(landed)} FROM region_month)
SELECT region_name, region_type, region_type_id, region_id, period_begin, period_end,
       {', '.join(c for m, _ in WEEKLY_MEASURES for c in (m, m + '_yoy'))},
       replace(string_split(region_name, ', ')[-1], ' metro area', '') AS state, duration_weeks,
       round_even(raw_ly, 4) AS {m0}_ly
FROM landed"""


@binding("family_weekly", weekly_sql())
def family_weekly_q(spark, sf):
    return fam.weekly_transform(weekly_landed(spark, sf))


# ---------------------------------------------------------------------------
# Home values and rents: one wide month-per-column file per series label

HOME_SERIES = {"F": "Condo/Co-op Time Series", "O": "2-Bedroom Time Series", "P": "Unlisted Series"}
RENT_SERIES = {"O": "Smoothed All Homes Plus Multifamily Time Series",
               "P": "Smoothed (Seasonally Adjusted) All Homes Plus Multifamily Time Series",
               "F": "Unlisted Rent Series"}


def _month_header():
    return F.date_format(F.last_day("month_start"), "yyyy-MM-dd")


def series_wide(panel: DataFrame, status: str, headers: list[str] | None = None) -> DataFrame:
    """A landed wide file: ids as text, one column per month-end header."""
    c = F.col
    ids = [(c("n_nationkey") + 1000).cast("string").alias("RegionID"), c("n_nationkey").cast("string").alias("SizeRank"),
           (c("n_nationkey") * 397 + 601).cast("string").alias("RegionName"), F.lit("zip").alias("RegionType"),
           c("r_name").alias("StateName"),
           F.when(c("n_regionkey") == 1, F.lit("MA")).otherwise(F.substring("r_name", 1, 2)).alias("State"),
           F.when(c("n_regionkey") != 0, c("n_name")).alias("City"), c("r_name").alias("Metro"),
           F.concat(c("n_name"), F.lit(" County")).alias("CountyName")]
    long = panel.where(c("status") == status).select(*ids, _month_header().alias("hdr"), "top_price")
    id_names = ["RegionID", "SizeRank", "RegionName", "RegionType", "StateName", "State", "City", "Metro", "CountyName"]
    return pivot_wide(long, id_names, "hdr", F.max("top_price"), headers)


def series_family(spark, sf, labels: dict, state: str | None) -> DataFrame:
    panel = market_panel(spark, sf, staged=True)
    # Every file's month headers in one small aggregate (bounded by the calendar,
    # not the data) instead of one distinct-value job per pivot.
    headers = {r["status"]: sorted(r["h"]) for r in
               panel.groupBy("status").agg(F.collect_set(_month_header()).alias("h")).collect()}
    wide = {label: series_wide(panel, status, headers[status])
            for status, label in labels.items() if headers.get(status)}
    long = fam.series_long(wide, RUN_DATE, state)
    return fam.series_fact(long, fam.series_lookup(spark))


def series_sql(labels: dict, state: str | None) -> str:
    ids = ("CAST(n_nationkey + 1000 AS VARCHAR) AS RegionID, CAST(n_nationkey AS VARCHAR) AS SizeRank, "
           "CAST(n_nationkey * 397 + 601 AS VARCHAR) AS RegionName, 'zip' AS RegionType, r_name AS StateName, "
           "CASE WHEN n_regionkey = 1 THEN 'MA' ELSE substr(r_name, 1, 2) END AS State, "
           "CASE WHEN n_regionkey <> 0 THEN n_name END AS City, r_name AS Metro, n_name || ' County' AS CountyName")
    id_names = "RegionID, SizeRank, RegionName, RegionType, StateName, State, City, Metro, CountyName"
    ctes, parts = [], []
    for i, (status, label) in enumerate(labels.items()):
        # A wide file holds every month of its status for every region of it.
        ctes.append(f"""p{i} AS (SELECT {ids}, last_day(month_start) AS hdr, top_price FROM panel WHERE status = '{status}'),
w{i} AS (SELECT RegionID, SizeRank, RegionName, State, m.hdr, max(CASE WHEN p.hdr = m.hdr THEN top_price END) AS v
        FROM p{i} p CROSS JOIN (SELECT DISTINCT hdr FROM p{i}) m GROUP BY {id_names}, m.hdr)""")
        parts.append(f"""SELECT RegionID, SizeRank, RegionName, State, hdr, v, '{label.replace("'", "''")}' AS data_type FROM w{i}""")
    lookup = ", ".join(f"({k}, '{t.replace(chr(39), chr(39) * 2)}', '{d}')" for k, t, d in S.SERIES_LOOKUP)
    where = f"WHERE State = '{state}'" if state else ""
    return f"""WITH {PANEL_SQL}, {', '.join(ctes)},
long AS ({' UNION ALL '.join(parts)}),
lk AS (SELECT * FROM (VALUES {lookup}) t(LOOKUP_KEY, DATA_TYPE, DATASET_TYPE))
SELECT coalesce(TRY_CAST(RegionID AS INTEGER), 0) AS RegionID, coalesce(TRY_CAST(SizeRank AS INTEGER), 0) AS SizeRank,
       CAST(hdr AS DATE) AS Month_End_Date, coalesce(round_even(v, 0), 0) AS Value,
       DATE '2025-01-15' AS Date_Pulled, lk.LOOKUP_KEY
FROM long LEFT JOIN lk ON long.data_type = lk.DATA_TYPE
{where}"""


@binding("family_home_values", series_sql(HOME_SERIES, "MA"))
def family_home_values_q(spark, sf):
    return series_family(spark, sf, HOME_SERIES, "MA")


@binding("family_rent_values", series_sql(RENT_SERIES, None))
def family_rent_values_q(spark, sf):
    return series_family(spark, sf, RENT_SERIES, None)
