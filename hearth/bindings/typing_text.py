"""Rounding, typing, text and date scalars."""

import datetime as dt

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.functions import (
    round_half_even, round_half_up, to_decimal, conform, zero_pad_code, split_last_token, strip_literal,
    duration_to_int, quarter_start, quarter_label, parse_date, parse_timestamp, minute_stamp, yyyymm,
    yyyymm_to_date, second_stamp, run_timestamp_literal,
)
from hearth.operators import with_tags

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
KEYS_SQL = "l_orderkey, l_linenumber, l_partkey"
# Fixed run parameters of the checks (a load stamp is a parameter, never the wall clock).
RUN_DATE = dt.date(2025, 1, 15)
RUN_TS = dt.datetime(2025, 1, 15, 6, 30, 0)


@binding("round_half_even", f"""
SELECT {KEYS_SQL}, round_even(l_quantity / 2, 0) AS half_quantity,
       round_even(l_extendedprice / (1 + l_discount), 2) AS price_lm,
       round_even(c_half, 0) AS half_price
FROM (SELECT *, l_extendedprice / 2 AS c_half FROM lineitem)""")
def round_half_even_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, round_half_even(F.col("l_quantity") / 2, 0).alias("half_quantity"),
                     round_half_even(F.col("l_extendedprice") / (1 + F.col("l_discount")), 2).alias("price_lm"),
                     round_half_even(F.col("l_extendedprice") / 2, 0).alias("half_price"))


@binding("round_half_up", f"""
SELECT {KEYS_SQL}, round(l_quantity / 2, 0) AS half_quantity,
       round(l_extendedprice / (1 + l_discount), 4) AS price_lm,
       round(-l_quantity / 2, 0) AS neg_half_quantity
FROM lineitem""")
def round_half_up_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, round_half_up(F.col("l_quantity") / 2, 0).alias("half_quantity"),
                     round_half_up(F.col("l_extendedprice") / (1 + F.col("l_discount")), 4).alias("price_lm"),
                     round_half_up(-F.col("l_quantity") / 2, 0).alias("neg_half_quantity"))


@binding("cast_decimal", f"""
SELECT {KEYS_SQL}, CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12, 4)) AS hotness_score,
       CAST(l_tax * l_quantity AS DECIMAL(12, 4)) AS supply_score
FROM lineitem""")
def cast_decimal_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, to_decimal(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("hotness_score"),
                     to_decimal(F.col("l_tax") * F.col("l_quantity")).alias("supply_score"))


@binding("cast_target_schema", """
SELECT l_orderkey, CAST(trunc(l_extendedprice / (1 + l_discount)) AS INTEGER) AS median_listing_price_lm,
       l_quantity AS active_listing_count, l_returnflag AS quality_flag_text,
       CAST(l_shipdate AS DATE) AS period_begin
FROM lineitem""")
def cast_target_schema_q(spark, sf):
    li = table(spark, sf, "lineitem")
    staged = li.select("l_orderkey", (F.col("l_extendedprice") / (1 + F.col("l_discount"))).alias("median_listing_price_lm"),
                       F.col("l_quantity").cast("string").alias("active_listing_count"),
                       F.col("l_returnflag").alias("quality_flag_text"), F.col("l_shipdate").alias("period_begin"))
    return conform(staged, [("l_orderkey", "bigint"), ("median_listing_price_lm", "int"),
                            ("active_listing_count", "double"), ("quality_flag_text", "string"),
                            ("period_begin", "date")])


@binding("zero_pad_code", """
SELECT c_custkey, CASE WHEN length(s) < 5 THEN lpad(s, 5, '0') ELSE s END AS zip_code
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS s FROM customer)""")
def zero_pad_code_q(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", zero_pad_code(F.col("c_custkey").cast("string")).alias("zip_code"))


@binding("split_last_token", """
SELECT c_custkey, place AS zip_name, string_split(place, ', ')[-1] AS state
FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name || ', ' || c_mktsegment ELSE c_name END AS place
      FROM customer)""")
def split_last_token_q(spark, sf):
    c = table(spark, sf, "customer")
    place = F.when(F.col("c_acctbal") >= 0, F.concat_ws(", ", "c_name", "c_mktsegment")).otherwise(F.col("c_name"))
    return c.select("c_custkey", place.alias("zip_name")).select(
        "c_custkey", "zip_name", split_last_token("zip_name").alias("state"))


@binding("duration_to_int", """
SELECT o_orderkey, replace(region_name, ' metro area', '') AS region,
       TRY_CAST(replace(duration, ' weeks', '') AS INTEGER) AS duration_weeks
FROM (SELECT o_orderkey, 'Region ' || CAST(o_custkey AS VARCHAR) || ' metro area' AS region_name,
             CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE split_part(o_orderpriority, '-', 1) END
               || ' weeks' AS duration
      FROM orders)""")
def duration_to_int_q(spark, sf):
    o = table(spark, sf, "orders")
    region = F.concat(F.lit("Region "), F.col("o_custkey").cast("string"), F.lit(" metro area"))
    dur = F.concat(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
                   .otherwise(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))), F.lit(" weeks"))
    return o.select("o_orderkey", strip_literal(region, " metro area").alias("region"),
                    duration_to_int(dur).alias("duration_weeks"))


QUARTER_SQL = r"'^(\d{4}) Q([1-4])$'"


@binding("quarter_to_date", f"""
SELECT o_orderkey, q AS quarter,
       CASE WHEN regexp_matches(q, {QUARTER_SQL})
            THEN make_date(CAST(regexp_extract(q, {QUARTER_SQL}, 1) AS INTEGER),
                           (CAST(regexp_extract(q, {QUARTER_SQL}, 2) AS INTEGER) - 1) * 3 + 1, 1) END
         AS start_quarter_date
FROM (SELECT o_orderkey,
             CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN '-' ELSE ' Q' END
               || CAST(quarter(o_orderdate) AS VARCHAR) AS q
      FROM orders)""")
def quarter_to_date_q(spark, sf):
    o = table(spark, sf, "orders")
    label = F.when(F.col("o_orderstatus") == "P",
                   F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.quarter("o_orderdate").cast("string"))) \
        .otherwise(quarter_label("o_orderdate"))
    return o.select("o_orderkey", label.alias("quarter")).select(
        "o_orderkey", "quarter", quarter_start("quarter").alias("start_quarter_date"))


@binding("parse_dates", """
SELECT o_orderkey, TRY_CAST(d AS DATE) AS period_begin, TRY_CAST(t AS TIMESTAMP) AS last_updated
FROM (SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
             strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS t
      FROM orders)""")
def parse_dates_q(spark, sf):
    o = table(spark, sf, "orders")
    d = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    t = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select("o_orderkey", parse_date(d).alias("period_begin"), parse_timestamp(t).alias("last_updated"))


@binding("minute_stamp", """
SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS nk_update_date FROM events""")
def minute_stamp_q(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", minute_stamp("ts").alias("nk_update_date"))


@binding("yyyymm_key", """
SELECT o_orderkey, ym AS month_date_yyyymm, make_date(ym // 100, ym % 100, 1) AS month_start
FROM (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS ym FROM orders)""")
def yyyymm_key_q(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", yyyymm("o_orderdate").alias("month_date_yyyymm")).select(
        "o_orderkey", "month_date_yyyymm", yyyymm_to_date("month_date_yyyymm").alias("month_start"))


@binding("audit_columns", """
SELECT o_orderkey, o_totalprice, 'orders' AS data_type, DATE '2025-01-15' AS date_pulled,
       '2025-01-15 06:30:00' AS update_date, TIMESTAMP '2025-01-15 06:30:00' AS update_ts
FROM orders""")
def audit_columns_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    stamp = run_timestamp_literal(RUN_TS)
    tagged = with_tags(o, {"data_type": "orders", "date_pulled": F.lit(RUN_DATE),
                           "update_date": second_stamp(stamp)})
    return tagged.withColumn("update_ts", F.col("update_date").try_cast("timestamp_ntz"))
