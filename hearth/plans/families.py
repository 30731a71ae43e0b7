"""Source families as compositions of the library operators.

Each family has a pure ``*_transform(raw, ...) -> DataFrame`` (landed frame in,
target layout out; lazily planned, one or two projections deep) and a
``run_*`` that reads the landed files, applies the transform and loads the
target through the freshness gate. The run time is always a parameter.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions import (
    zero_pad_code, split_last_token, strip_literal, duration_to_int, quarter_start, text_default, us_abbrev,
    abs_int_default, total_from_share, complement, prior_from_ratio, prior_from_ratio_guarded, count_from_rate,
    guarded_ratio, round_half_even, round_half_up, minute_stamp, nonfinite_to_zero, nonfinite_to_null, fill_defaults, conform,
    run_timestamp_literal,
)
from hearth.operators import (
    Derived, measures, with_prior_levels, round_columns, footer_reject, project_layout, melt, header_to_date,
    tagged_union, region_filter, fill_down, drop_all_null, lookup_left_join, MONTH_YEAR_MM, MONTH_YEAR_MOM,
)
from hearth.plans import specs as S
from hearth.plans.landing import Landed, Run, load_by_period, load_whole, split_by_period, account, quarantine
from hearth.functions._util import q
from hearth.quality.ledger import record
from hearth.sinks import write_replace, dimension_snapshot, GateResult
from hearth.sources import read_delimited_raw, read_preamble_tsv, read_wide_series


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """try_cast the listed columns to double, others unchanged (one projection, none where
    all of them are doubles)."""
    have = {c.lower(): t for c, t in df.dtypes}
    wanted = {c.lower() for c in columns if have.get(c.lower()) != "double"}
    if not wanted:
        return df
    return df.selectExpr(*[f"try_cast({q(c)} AS double) AS {q(c)}" if c.lower() in wanted else q(c)
                           for c in df.columns])


def _stamp(run_ts: _dt.datetime):
    return run_timestamp_literal(run_ts.replace(microsecond=0))


def _geo_keys(df: DataFrame, geo: S.Geography) -> DataFrame:
    """Zero-pad the code column and derive the state from 'place, ST' where the level needs it."""
    extra = []
    drop = set()
    if geo.pad:
        src, dst = geo.pad
        extra.append(zero_pad_code(F.col(src)).alias(dst))
        drop.add(src)
    if geo.state_from:
        extra.append(split_last_token(F.col(geo.state_from)).alias("state"))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in drop], *extra)


# ---------------------------------------------------------------------------
# Monthly inventory (state / metro / county / zip)

def _filled(df: DataFrame, fill: bool) -> DataFrame:
    """Load defaults: non-finite and missing numbers 0, missing text ''. With ``fill=False`` missing
    values stay NULL (and non-finite ones become NULL), so that later aggregates are not pulled to 0."""
    return fill_defaults(nonfinite_to_zero(df)) if fill else nonfinite_to_null(df)


def inventory_transform(raw: DataFrame, geo: S.Geography, run_ts: _dt.datetime, compat: bool = True,
                        fill: bool = True) -> DataFrame:
    """``compat`` rounds pending_ratio_ly to 0 places as the published loads do; without it the
    ratio keeps its places. ``fill=False`` keeps missing values NULL."""
    numeric = S.INVENTORY_MEASURES + [f"{m}{s}" for m in S.INVENTORY_MEASURES for s in ("_mm", "_yy")] \
        + ["quality_flag"]
    df = _doubles(footer_reject(raw, "month_date_yyyymm"), [c for c in numeric if c in raw.columns])
    df = with_prior_levels(df, measures(S.INVENTORY_MEASURES, "ratio", MONTH_YEAR_MM))
    df = _geo_keys(df, geo)
    df = _filled(df, fill)
    prior = [f"{m}{s}" for s in ("_ly", "_lm") for m in S.INVENTORY_MEASURES]
    skip = {"pending_ratio_lm"} | (set() if compat else {"pending_ratio_ly"})
    df = round_columns(df, {c: 0 for c in prior if c not in skip}, "half_even")
    df = df.withColumn("Update_Date", _stamp(run_ts))
    target = ([("month_date_yyyymm", "int")] + list(geo.keys)
              + [(m, "int" if m == "median_listing_price" else "double") for m in S.INVENTORY_MEASURES]
              + [("quality_flag", "int")]
              + [(f"{m}_ly", "double") for m in S.INVENTORY_MEASURES]
              + [(f"{m}_lm", "double") for m in S.INVENTORY_MEASURES]
              + [("Update_Date", "timestamp_ntz")])
    return conform(df, target)


# ---------------------------------------------------------------------------
# Monthly hotness (metro / county / zip)

# Each derived hotness column, its level, its change and the rule.
HOTNESS_DERIVED = [
    Derived("hotness_rank_lm", "hotness_rank", "hotness_rank_mm", "sum"),
    Derived("hotness_rank_ly", "hotness_rank", "hotness_rank_yy", "diff"),
    Derived("median_days_on_market_ly", "median_days_on_market", "median_dom_yy_day", "diff"),
    Derived("median_days_on_market_lm", "median_days_on_market", "median_dom_mm_day", "diff"),
    Derived("median_days_on_market_us", "median_days_on_market", "median_dom_vs_us", "diff"),
    Derived("median_listing_price_lm", "median_listing_price", "median_listing_price_mm", "ratio"),
    Derived("median_listing_price_ly", "median_listing_price", "median_listing_price_yy", "ratio"),
    Derived("median_listing_price_us", "median_listing_price", "median_listing_price_vs_us", "ratio"),
]


def hotness_transform(raw: DataFrame, geo: S.Geography, run_ts: _dt.datetime, fill: bool = True) -> DataFrame:
    numeric = (["hh_rank", "hotness_rank", "median_days_on_market", "median_listing_price", "quality_flag"]
               + S.HOTNESS_SCORES + S.HOTNESS_PAGE_VIEWS + S.HOTNESS_CHANGE_INPUTS)
    df = _doubles(footer_reject(raw, "month_date_yyyymm"), [c for c in numeric if c in raw.columns])
    df = with_prior_levels(df, HOTNESS_DERIVED, drop_changes=False, drop=S.HOTNESS_CHANGE_INPUTS)
    # Two places for ranks and prices, four for scores and day counts (the
    # demand score is rounded to two, so its later four-place rounding is a no-op).
    df = round_columns(df, {c: 2 for c in S.HOTNESS_TWO_PLACES}, "half_even")
    df = round_columns(df, {c: 4 for c in S.HOTNESS_FOUR_PLACES}, "half_even")
    df = df.withColumnRenamed("hh_rank", "household_count_rank")
    df = _geo_keys(df, geo)
    df = _filled(df, fill)
    df = df.withColumn("Update_Date", _stamp(run_ts))
    return conform(df, hotness_layout(geo))


def hotness_layout(geo: S.Geography) -> list[tuple[str, str]]:
    dec = "decimal(12,4)"
    return ([("month_date_yyyymm", "int")] + list(geo.keys)
              + [("household_count_rank", "int"), ("hotness_rank", "int")]
              + [(c, dec) for c in S.HOTNESS_SCORES] + [("median_days_on_market", dec)]
              + [(c, dec) for c in S.HOTNESS_PAGE_VIEWS]
              + [("median_listing_price", "int"), ("quality_flag", "int"),
                 ("hotness_rank_lm", "int"), ("hotness_rank_ly", "int"),
                 ("median_days_on_market_ly", dec), ("median_days_on_market_lm", dec),
                 ("median_days_on_market_us", dec),
                 ("median_listing_price_lm", "int"), ("median_listing_price_ly", "int"),
                 ("median_listing_price_us", "int"), ("Update_Date", "timestamp_ntz")])


# ---------------------------------------------------------------------------
# Monthly housing tracker: clean -> prior levels -> counts, sizes, rounding

def tracker_measure_columns() -> list[str]:
    base = S.TRACKER_RATIO_MEASURES + S.TRACKER_POINT_MEASURES
    return base + [f"{m}_mom" for m in base] + [f"{m}_yoy" for m in base]


def tracker_clean(raw: DataFrame) -> DataFrame:
    """Types and defaults: dates parsed, ids NULL -> 0, text trimmed with 'NA',
    the national state label normalised, all measures and changes NULL -> 0."""
    cols = [F.col("period_begin").cast("string").try_cast("date").alias("period_begin"),
            F.col("period_end").cast("string").try_cast("date").alias("period_end")]
    cols += [F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(0)).alias(c) for c in S.TRACKER_INT_DEFAULTS]
    cols += [text_default(c).alias(c) for c in S.TRACKER_TEXT_TRIMMED]
    cols += [us_abbrev(F.trim(F.col("state").cast("string"))).alias("state"),
             abs_int_default(F.col("property_type_id").cast("string")).alias("property_type_id")]
    cols += [F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)).alias(c)
             for c in tracker_measure_columns()]
    cols += [text_default(c, trim=False).alias(c) for c in S.TRACKER_TEXT_UNTRIMMED]
    cols += [F.col("last_updated").cast("string").try_cast("timestamp_ntz").alias("last_updated")]
    return raw.select(*cols)


def tracker_prior(clean: DataFrame) -> DataFrame:
    """Prior-month and prior-year levels for every measure (one projection)."""
    derived = measures(S.TRACKER_RATIO_MEASURES, "ratio", MONTH_YEAR_MOM)
    for m in S.TRACKER_POINT_MEASURES:
        kind = "sum" if m in S.TRACKER_SUM_MEASURES else "diff"
        derived += measures([m], kind, MONTH_YEAR_MOM)
    return with_prior_levels(clean, derived)


def _publish_block(suffix: str) -> list:
    def c(name):
        # A prior level that could not be recovered (change of -100 %) loads as 0.
        return F.coalesce(F.col(f"{name}{suffix}"), F.lit(0.0))
    out = []
    for m in S.TRACKER_RATIO_MEASURES + S.TRACKER_POINT_MEASURES:
        if m in ("sold_above_list", "price_drops", "off_market_in_two_weeks"):
            continue
        digits = 4 if m in S.TRACKER_FOUR_PLACES else 0
        out.append(round_half_up(c(m), digits).alias(f"{m}{suffix}"))
    for rate, name in S.TRACKER_RATE_COUNTS:
        out.append(count_from_rate(c(rate), c("homes_sold")).alias(f"{name}{suffix}"))
    for name, price, ppsf in S.TRACKER_SIZES:
        out.append(guarded_ratio(c(price), c(ppsf)).alias(f"{name}{suffix}"))
    return out


def tracker_publish(prior: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    ident = ["period_begin", "period_end", "period_duration", "region_type", "region_type_id", "table_id",
             "is_seasonally_adjusted", "region", "city", "state", "state_code", "property_type", "property_type_id"]
    return prior.select(*ident, *_publish_block(""), *_publish_block("_lm"), *_publish_block("_ly"),
                        *S.TRACKER_TEXT_UNTRIMMED, "last_updated",
                        minute_stamp(run_timestamp_literal(run_ts)).alias("nk_update_date"))


def tracker_layout() -> list[tuple[str, str]]:
    ident = [("period_begin", "date"), ("period_end", "date"), ("period_duration", "int"),
             ("region_type", "string"), ("region_type_id", "int"), ("table_id", "int"),
             ("is_seasonally_adjusted", "string"), ("region", "string"), ("city", "string"), ("state", "string"),
             ("state_code", "string"), ("property_type", "string"), ("property_type_id", "int")]
    block = []
    for suffix in ("", "_lm", "_ly"):
        for m in S.TRACKER_RATIO_MEASURES + ["months_of_supply", "median_dom", "avg_sale_to_list"]:
            block.append((f"{m}{suffix}", "double" if m in S.TRACKER_FOUR_PLACES else "int"))
        block += [(f"{n}{suffix}", "int") for _, n in S.TRACKER_RATE_COUNTS]
        block += [(f"{n}{suffix}", "int") for n, _, _ in S.TRACKER_SIZES]
    tail = [("parent_metro_region", "string"), ("parent_metro_region_metro_code", "string"),
            ("last_updated", "timestamp_ntz"), ("nk_update_date", "string")]
    return ident + block + tail


def tracker_transform(raw: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    return conform(tracker_publish(tracker_prior(tracker_clean(raw)), run_ts), tracker_layout())


# ---------------------------------------------------------------------------
# Home values / rents: wide month-per-column series, several labelled sources

def series_long(wide: Mapping[str, DataFrame], run_date: _dt.date, state: str | None = None) -> DataFrame:
    """{label: wide frame} -> one long table (region, month end, value, label, pull date)."""
    parts = {}
    for label, w in wide.items():
        w = region_filter(w, "State", state)
        w = w.drop(*[c for c in S.SERIES_DROPPED if c in w.columns])
        w = _doubles(w, [c for c in w.columns if c not in S.SERIES_ID_COLUMNS])
        long = melt(w, S.SERIES_ID_COLUMNS, variable="__hdr", value="Value")
        parts[label] = long.select(*[F.col(c) for c in S.SERIES_ID_COLUMNS if c != "RegionName"],
                                   header_to_date("__hdr").alias("Month_End_Date"),
                                   zero_pad_code(F.col("RegionName")).alias("Zip_Code"), "Value")
    df = tagged_union(parts, "Data_Type")
    df = df.select("*", F.lit(run_date).alias("Date_Pulled"))
    df = df.withColumn("Value", round_half_even("Value", 0))
    df = df.select(*[F.col(c).try_cast("int").alias(c) if c in ("RegionID", "SizeRank") else F.col(c)
                     for c in df.columns])
    return fill_defaults(nonfinite_to_zero(df))


def series_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.SERIES_LOOKUP, "LOOKUP_KEY int, DATA_TYPE string, DATASET_TYPE string")


def series_fact(long: DataFrame, lookup: DataFrame) -> DataFrame:
    """Label -> integer key through the lookup (LEFT: unknown labels keep a NULL key)."""
    joined = lookup_left_join(long, lookup, ["Data_Type"], ["DATA_TYPE"], drop=["DATASET_TYPE"])
    return joined.select("RegionID", "SizeRank", "Month_End_Date", "Value", "Date_Pulled", "LOOKUP_KEY")


def series_dimension(long: DataFrame) -> DataFrame:
    return long.select(*S.SERIES_DIMENSION).distinct()


def series_regions(wide: Mapping[str, DataFrame], state: str | None = None) -> DataFrame:
    """The region dimension of the wide files: the rows ``series_dimension`` finds in the melted
    table, taken before the melt, so a region is compared once and not once for each month."""
    parts = []
    for w in wide.values():
        w = region_filter(w, "State", state)
        parts.append(w.select(F.col("RegionID").try_cast("int").alias("RegionID"), "State", "City", "Metro", "CountyName",
                              zero_pad_code(F.col("RegionName")).alias("Zip_Code")))
    regions = parts[0]
    for p in parts[1:]:
        regions = regions.unionByName(p)
    return fill_defaults(regions).select(*S.SERIES_DIMENSION).distinct()


# ---------------------------------------------------------------------------
# Investor purchases by quarter (export with blank merged quarter cells)

def investor_transform(raw: DataFrame, run_ts: _dt.datetime, order_col: str = "row_no") -> DataFrame:
    share, bought, yoy = S.INVESTOR_SHARE, S.INVESTOR_PURCHASES, S.INVESTOR_YOY
    df = _doubles(raw, [share, bought, yoy])
    df = drop_all_null(df, [c for c in df.columns if c != order_col])
    df = fill_down(df, [S.INVESTOR_QUARTER], order_col)
    total = total_from_share(F.col(f"`{bought}`"), F.col(f"`{share}`"))
    df = df.select("*", total.alias("total_purchases"),
                   complement(total, F.col(f"`{bought}`")).alias("non_investor_purchases"),
                   prior_from_ratio_guarded(F.col(f"`{bought}`"), F.col(f"`{yoy}`")).alias("Investor_Purchases_LY"),
                   quarter_start(F.col(S.INVESTOR_QUARTER)).alias("start_quarter_date"))
    df = fill_defaults(nonfinite_to_zero(df))
    df = round_columns(df, {share: 4, yoy: 4, "total_purchases": 4, "Investor_Purchases_LY": 4,
                            "non_investor_purchases": 4}, "half_even")
    df = df.withColumn("Update_Date", _stamp(run_ts))
    return project_layout(df, S.INVESTOR_LAYOUT)


# ---------------------------------------------------------------------------
# Weekly tracker (unfinished upstream: no sink)

def weekly_transform(raw: DataFrame, measure: str = "adjusted_average_new_listings") -> DataFrame:
    df = raw.select("*", strip_literal(split_last_token(F.col("region_name")), " metro area").alias("state"),
                    duration_to_int(F.col("duration")).alias("duration_weeks")).drop("duration")
    df = df.withColumn(f"{measure}_ly", prior_from_ratio(F.col(measure), F.col(f"{measure}_yoy")))
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return round_columns(df, {c: 4 for c in doubles}, "half_even")


# ---------------------------------------------------------------------------
# Runners: landed files -> target tables. Each classifies its landed rows once and cuts the
# table, the quarantine and the ledger's counts from that staged table (plans.landing).

FOOTER_PREFIX = S.FOOTER_TEXT.split(" ")[0]


def _run(table: str, landed_path, run_ts: _dt.datetime, step: str | None, ledger_path: str | None, quarantine_path: str | None) -> Run:
    """A step is named by its landed location unless the caller names it."""
    where = landed_path if isinstance(landed_path, str) else ",".join(landed_path)
    return Run(table, run_ts, step or where.rstrip("/").split("/")[-1], ledger_path, quarantine_path)


def _typed_geo_keys(geo: S.Geography) -> list[tuple[str, str]]:
    """Non-text geography keys with their declared types (a padded code is text)."""
    return [(k, t) for k, t in geo.keys if t != "string"]


def _monthly(geo: S.Geography, numeric: Sequence[str], text: Sequence[str] = ()) -> Landed:
    keys = ["month_date_yyyymm"] + [geo.pad[0] if geo.pad and k == geo.pad[1] else k for k, _ in geo.keys]
    return Landed("month_date_yyyymm", "int", FOOTER_PREFIX, [*_typed_geo_keys(geo), *((c, "double") for c in numeric)],
                  keys=list(dict.fromkeys([*keys, *text])))


def inventory_landing(geo: S.Geography) -> Landed:
    return _monthly(geo, S.INVENTORY_MEASURES + [f"{m}{s}" for m in S.INVENTORY_MEASURES for s in ("_mm", "_yy")]
                    + ["quality_flag"], geo.text)


def hotness_landing(geo: S.Geography) -> Landed:
    return _monthly(geo, ["hh_rank", "hotness_rank", "median_days_on_market", "median_listing_price", "quality_flag"]
                    + S.HOTNESS_SCORES + S.HOTNESS_PAGE_VIEWS + S.HOTNESS_CHANGE_INPUTS)


def tracker_landing() -> Landed:
    return Landed("period_begin", "date", None, [("period_end", "date"), *((c, "double") for c in tracker_measure_columns())],
                  keys=["period_begin", "region", "property_type"])


def run_inventory(spark: SparkSession, geography: str, landed_path: str, target_path: str,
                  run_ts: _dt.datetime, quarantine_path: str | None = None, ledger_path: str | None = None,
                  step: str | None = None, fill: bool = True) -> GateResult:
    geo = S.INVENTORY_GEOGRAPHIES[geography]
    return load_by_period(spark, read_delimited_raw(spark, landed_path), inventory_landing(geo),
                          lambda raw: inventory_transform(raw, geo, run_ts, fill=fill), target_path, "month_date_yyyymm",
                          _run(geo.table, landed_path, run_ts, step, ledger_path, quarantine_path))


def run_hotness(spark: SparkSession, geography: str, landed_path: str, target_path: str,
                run_ts: _dt.datetime, latest_only: bool = False, quarantine_path: str | None = None,
                ledger_path: str | None = None, step: str | None = None, fill: bool = True) -> GateResult:
    geo = S.HOTNESS_GEOGRAPHIES[geography]
    return load_by_period(spark, read_delimited_raw(spark, landed_path), hotness_landing(geo),
                          lambda raw: hotness_transform(raw, geo, run_ts, fill=fill), target_path, "month_date_yyyymm",
                          _run(geo.table, landed_path, run_ts, step, ledger_path, quarantine_path), latest_only)


def run_tracker(spark: SparkSession, landed_path: str, target_path: str, run_ts: _dt.datetime,
                latest_only: bool = False, quarantine_path: str | None = None, ledger_path: str | None = None,
                step: str | None = None, geography: str = "us") -> GateResult:
    """``geography`` names the target in the ledger; the layout is the same at every level."""
    return load_by_period(spark, read_preamble_tsv(spark, landed_path, S.TRACKER_HEADER_TOKENS), tracker_landing(),
                          lambda raw: tracker_transform(raw, run_ts), target_path, "period_begin",
                          _run(S.TRACKER_GEOGRAPHIES[geography], landed_path, run_ts, step, ledger_path, quarantine_path), latest_only)


def run_series(spark: SparkSession, spec: S.SeriesSpec, run_date: _dt.date, fact_path: str,
               dimension_path: str, quarantine_path: str | None = None, ledger_path: str | None = None) -> DataFrame:
    """One ledger row for each labelled file: regions loaded, excluded by the state restriction,
    or quarantined for want of a whole-number RegionID. A month cell or rank that does not parse
    is quarantined and loads as missing."""
    run_ts = _dt.datetime.combine(run_date, _dt.time())
    kept: dict[str, DataFrame] = {}
    entries = []
    for label, path in spec.sources.items():
        raw = read_wide_series(spark, path, S.SERIES_ID_COLUMNS, S.SERIES_DROPPED)
        months = [c for c in raw.columns if c not in S.SERIES_ID_COLUMNS]
        landed = Landed(needed=[("RegionID", "int")], values=[("SizeRank", "int"), *((c, "double") for c in months)],
                        keys=["RegionID", "RegionName"],
                        excluded=None if spec.state is None else ~F.col("State").eqNullSafe(F.lit(spec.state)))
        run = Run(spec.target, run_ts, label, ledger_path, quarantine_path)
        split = split_by_period(raw, landed)
        entry = account(split, run, "replace")
        quarantine(split, landed, run, entry)
        kept[label] = split.loaded()
        entries.append(entry)
    dimension_snapshot(series_regions(kept, spec.state), S.SERIES_DIMENSION, dimension_path, run_date, spec.dataset_type)
    fact = series_fact(series_long(kept, run_date, spec.state), series_lookup(spark))
    write_replace(fact, fact_path)
    if ledger_path:
        for entry in entries:
            record(spark, ledger_path, entry)
    return fact


def investor_landing(raw: DataFrame) -> Landed:
    quarter = F.col(S.INVESTOR_QUARTER)
    return Landed(values=[(c, "double") for c in (S.INVESTOR_SHARE, S.INVESTOR_PURCHASES, S.INVESTOR_YOY)],
                  rules={S.INVESTOR_QUARTER: ("quarter 'YYYY QN'", quarter.isNotNull() & quarter_start(quarter).isNull())},
                  keys=["row_no", S.INVESTOR_METRO], blank=[c for c in raw.columns if c != "row_no"],
                  needed=[("row_no", "long")])


def run_investor(spark: SparkSession, landed_path: str, target_path: str, run_ts: _dt.datetime,
                 quarantine_path: str | None = None, ledger_path: str | None = None, step: str | None = None) -> DataFrame:
    """Rows are loaded in file order: a row whose number does not parse has no place and is
    quarantined; a malformed quarter loads without a date, and its text is quarantined."""
    raw = read_delimited_raw(spark, landed_path)
    out = []

    def write(rows: DataFrame) -> None:
        rows = rows.withColumn("row_no", F.col("row_no").try_cast("long"))
        out.append(investor_transform(rows, run_ts))
        write_replace(out[0].withColumn("start_quarter_date", F.col("start_quarter_date").cast("date")), target_path)
    load_whole(spark, raw, investor_landing(raw), _run("REDFIN_INVESTOR_BY_QUARTER", landed_path, run_ts, step, ledger_path,
                                                       quarantine_path), write)
    return out[0]


def run_weekly(spark: SparkSession, landed_path: str, run_ts: _dt.datetime | None = None, quarantine_path: str | None = None,
               ledger_path: str | None = None, step: str | None = None) -> DataFrame:
    """Every column but the text, id and period columns is a measure (double). The transformed
    rows are returned (there is no table to load); rows whose period_begin does not parse are not among them."""
    raw = read_delimited_raw(spark, landed_path, sep="\t")
    types = {**{c: "string" for c in S.WEEKLY_TEXT}, **{c: "int" for c in S.WEEKLY_INTS}, **{c: "date" for c in S.WEEKLY_DATES}}
    types = {c: types.get(c, "double") for c in raw.columns}
    landed = Landed("period_begin" if "period_begin" in raw.columns else None, "date",
                    values=[(c, t) for c, t in types.items() if t != "string" and c != "period_begin"],
                    keys=["period_begin", "region_name"])
    run = _run("REDFIN_WEEKLY", landed_path, run_ts or _dt.datetime(1970, 1, 1), step, ledger_path, quarantine_path)
    split = split_by_period(raw, landed)
    entry = account(split, run, "returned")
    quarantine(split, landed, run, entry)
    if ledger_path:
        record(spark, ledger_path, entry)
    return weekly_transform(split.loaded().selectExpr(
        *[q(c) if t == "string" else f"try_cast({q(c)} AS {t}) AS {q(c)}" for c, t in types.items()]))
