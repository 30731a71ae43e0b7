"""Joins, aggregates, filters, layout, SQL views and JSON key/values."""

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.functions import yyyymm
from hearth.operators import (
    lookup_left_join, surrogate_key, distinct_dimension, row_count, loaded_periods,
    duplicate_key_report, top_n, region_filter, period_range, latest_month_slice, footer_reject,
    project_layout,
)
from hearth.sources import sql_view_query, json_key_values

YM_SQL = "CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)"


@binding("lookup_left_join", """
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, n.n_regionkey AS lookup_key
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c.c_nationkey = n.n_nationkey""")
def lookup_left_join_q(spark, sf):
    fact = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    lkp = table(spark, sf, "nation").where(F.col("n_regionkey") != 0) \
        .select("n_nationkey", "n_name", F.col("n_regionkey").alias("lookup_key"))
    return lookup_left_join(fact, lkp, ["c_nationkey"], ["n_nationkey"], drop=["n_name"])


@binding("surrogate_key", """
SELECT p_name AS label, CAST(row_number() OVER (ORDER BY p_name) - 1 AS BIGINT) AS lookup_key
FROM (SELECT DISTINCT p_name FROM part)""")
def surrogate_key_q(spark, sf):
    keyed = surrogate_key(table(spark, sf, "part"), "p_name", "lookup_key")
    return keyed.select(F.col("p_name").alias("label"), "lookup_key")


@binding("distinct_dimension", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_dimension_q(spark, sf):
    return distinct_dimension(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


@binding("max_period", f"""
SELECT max(CAST(o_orderdate AS DATE)) AS max_period, max({YM_SQL}) AS max_yyyymm FROM orders""")
def max_period_q(spark, sf):
    o = table(spark, sf, "orders")
    # Both derive from one MAX of the stored column (date cast and year-month are
    # monotonic), which Parquet answers from its footers.
    top = o.agg(F.max("o_orderdate").alias("m"))
    return top.select(F.col("m").cast("date").alias("max_period"), yyyymm("m").alias("max_yyyymm"))


@binding("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count_q(spark, sf):
    return row_count(table(spark, sf, "lineitem"))


@binding("loaded_periods", f"SELECT DISTINCT {YM_SQL} AS month_date_yyyymm FROM orders ORDER BY 1")
def loaded_periods_q(spark, sf):
    o = table(spark, sf, "orders").select(yyyymm("o_orderdate").alias("month_date_yyyymm"))
    return loaded_periods(o, "month_date_yyyymm")


@binding("duplicate_key_report", """
SELECT l_orderkey, l_linenumber, count(*) AS count_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber ORDER BY count_rows DESC, l_orderkey, l_linenumber""")
def duplicate_key_report_q(spark, sf):
    return duplicate_key_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@binding("top_n_preview", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_n_preview_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return top_n(o, 100, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@binding("region_filter", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def region_filter_q(spark, sf):
    return region_filter(table(spark, sf, "customer"), "c_mktsegment", "BUILDING")


@binding("period_range_filter", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'""")
def period_range_filter_q(spark, sf):
    return period_range(table(spark, sf, "orders"), "o_orderdate",
                        start=F.lit("1997-01-01").cast("timestamp_ntz"), equals={"o_orderstatus": "F"})


@binding("latest_period_slice", f"""
SELECT o_orderkey, o_totalprice, {YM_SQL} AS month_date_yyyymm FROM orders
WHERE {YM_SQL} = (SELECT max({YM_SQL}) FROM orders)""")
def latest_period_slice_q(spark, sf):
    # The year-month is computed after the slice: the stored column takes the range.
    o = latest_month_slice(table(spark, sf, "orders"), "o_orderdate")
    return o.select("o_orderkey", "o_totalprice", yyyymm("o_orderdate").alias("month_date_yyyymm"))


# Fixed value: the disclaimer line that closes the landed inventory files.
FOOTER_TEXT = "quality_flag = 1:  year-over-year figures may be impacted"


@binding("footer_reject", f"""
SELECT {YM_SQL} AS month_date_yyyymm, o_orderkey, o_totalprice FROM orders""")
def footer_reject_q(spark, sf):
    o = table(spark, sf, "orders").select(yyyymm("o_orderdate").cast("string").alias("month_date_yyyymm"),
                                          "o_orderkey", "o_totalprice")
    footer = spark.createDataFrame([(FOOTER_TEXT, None, None)],
                                   "month_date_yyyymm string, o_orderkey bigint, o_totalprice double")
    landed = o.unionByName(footer)
    kept = footer_reject(landed, "month_date_yyyymm")
    return kept.withColumn("month_date_yyyymm", F.col("month_date_yyyymm").try_cast("int"))


@binding("project_target_layout", """
SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS extended_price, l_returnflag
FROM lineitem""")
def project_target_layout_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return project_layout(li, ["l_orderkey", "l_linenumber", "quantity", "extended_price", "l_returnflag"],
                          rename={"l_quantity": "quantity", "l_extendedprice": "extended_price"})


@binding("sql_view_query", """
SELECT o_orderstatus, count(*) AS order_count, round(sum(o_totalprice), 2) AS total_price
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderstatus""")
def sql_view_query_q(spark, sf):
    return sql_view_query(table(spark, sf, "orders"), """
        SELECT o_orderstatus, count(*) AS order_count, round(sum(o_totalprice), 2) AS total_price
        FROM {view} WHERE o_orderdate >= TIMESTAMP_NTZ '1996-01-01' GROUP BY o_orderstatus""")


@binding("json_key_values", """
SELECT event_id, k AS key, json_extract_string(props, '$.' || k) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def json_key_values_q(spark, sf):
    return json_key_values(table(spark, sf, "events"), "props", keep=["event_id"])
