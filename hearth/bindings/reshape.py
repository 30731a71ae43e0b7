"""Melt, header parsing, fill-down and the tagged union."""

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.operators import melt, pivot_wide, fill_down, tagged_union
from hearth.sources import long_series

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@binding("melt_wide_series", """
SELECT l_orderkey, l_linenumber, l_partkey, measure, value
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
             NULLIF(l_tax, 0) AS l_tax FROM lineitem)
UNPIVOT INCLUDE NULLS (value FOR measure IN (l_quantity, l_extendedprice, l_discount, l_tax))""")
def melt_wide_series_q(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"))
    return melt(li, ["l_orderkey", "l_linenumber", "l_partkey"], MEASURES, "measure", "value")


@binding("melt_header_to_date", """
WITH o AS (SELECT o_custkey, make_date(year(o_orderdate), 12, 31) AS month_end_date, o_totalprice FROM orders),
agg AS (SELECT o_custkey, month_end_date, round(sum(o_totalprice), 2) AS value FROM o GROUP BY ALL),
ids AS (SELECT DISTINCT o_custkey FROM o), hdr AS (SELECT DISTINCT month_end_date FROM o)
SELECT ids.o_custkey, hdr.month_end_date, agg.value
FROM ids CROSS JOIN hdr
LEFT JOIN agg ON agg.o_custkey = ids.o_custkey AND agg.month_end_date = hdr.month_end_date""")
def melt_header_to_date_q(spark, sf):
    o = table(spark, sf, "orders")
    hdr = F.date_format(F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)), "yyyy-MM-dd")
    # A wide file: one row per customer, one column per year-end header.
    wide = pivot_wide(o.select("o_custkey", hdr.alias("hdr"), "o_totalprice"), ["o_custkey"], "hdr",
                      F.round(F.sum("o_totalprice"), 2))
    return long_series(wide, ["o_custkey"], "month_end_date", "value")


SPARSE_SQL = "CASE WHEN value < 10 THEN event_type END"


def _sparse_events(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", F.when(F.col("value") < 10, F.col("event_type")).alias("event_type"))


@binding("fill_down_keyed", f"""
SELECT event_id, user_id,
       last_value({SPARSE_SQL} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_type
FROM events""")
def fill_down_keyed_q(spark, sf):
    return fill_down(_sparse_events(spark, sf), ["event_type"], "event_id", keys=["user_id"])


@binding("fill_down_global", f"""
SELECT event_id, user_id,
       last_value({SPARSE_SQL} IGNORE NULLS) OVER (ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_type
FROM events""")
def fill_down_global_q(spark, sf):
    return fill_down(_sparse_events(spark, sf), ["event_type"], "event_id")


@binding("tagged_union", """
SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE) AS period, o_totalprice AS amount, 'orders' AS data_type
FROM orders
UNION ALL
SELECT l_orderkey, CAST(l_shipdate AS DATE), l_extendedprice, 'lineitem' FROM lineitem
UNION ALL
SELECT event_id, CAST(ts AS DATE), value, 'events' FROM events""")
def tagged_union_q(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"),
                                          F.col("o_orderdate").cast("date").alias("period"),
                                          F.col("o_totalprice").alias("amount"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("record_id"),
                                             F.col("l_shipdate").cast("date").alias("period"),
                                             F.col("l_extendedprice").alias("amount"))
    e = table(spark, sf, "events").select(F.col("event_id").alias("record_id"), F.col("ts").cast("date").alias("period"),
                                          F.col("value").alias("amount"))
    return tagged_union({"orders": o, "lineitem": li, "events": e}, "data_type")
