"""Null/non-finite hygiene on orders and customer (NULL, inf and NaN are made
from data predicates; the tables themselves hold none)."""

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.functions import nonfinite_to_zero, fill_defaults, text_default, us_abbrev, abs_int_default
from hearth.operators import drop_all_null


@binding("nonfinite_to_zero", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN 0 ELSE o_totalprice END AS amount,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE o_totalprice / 2 END AS half_amount
FROM orders""")
def nonfinite_to_zero_q(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(float("inf")))
         .when(F.col("o_orderstatus") == "P", F.lit(float("nan")))
         .otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("-inf")))
         .otherwise(F.col("o_totalprice") / 2).alias("half_amount"))
    return nonfinite_to_zero(raw)


@binding("fill_defaults", """
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END, 0) AS amount,
       coalesce(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END, 0) AS custkey,
       coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END, '') AS priority
FROM orders""")
def fill_defaults_q(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("custkey"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"))
    return fill_defaults(raw)


@binding("text_default", """
SELECT c_custkey,
       coalesce(trim(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE '  ' || c_name || ' ' END), 'NA') AS region,
       replace(coalesce(CASE WHEN c_nationkey = 24 THEN 'U.S.'
                             WHEN c_mktsegment = 'BUILDING' THEN NULL
                             ELSE 'Nation ' || CAST(c_nationkey AS VARCHAR) END, 'NA'), 'U.S.', 'US') AS state
FROM customer""")
def text_default_q(spark, sf):
    c = table(spark, sf, "customer")
    raw = c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("region"),
        F.when(F.col("c_nationkey") == 24, F.lit("U.S."))
         .when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")))
         .alias("state"))
    return raw.select("c_custkey", text_default("region").alias("region"), us_abbrev("state").alias("state"))


@binding("abs_int_default", """
SELECT c_custkey,
       coalesce(abs(TRY_CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                                  WHEN c_mktsegment = 'MACHINERY' THEN 'n/a'
                                  ELSE CAST(c_nationkey - 12 AS VARCHAR) END AS INTEGER)), 0) AS property_type_id
FROM customer""")
def abs_int_default_q(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string")) \
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("n/a")) \
        .otherwise((F.col("c_nationkey") - 12).cast("string"))
    return c.select("c_custkey", abs_int_default(raw).alias("property_type_id"))


@binding("drop_all_null", """
SELECT * FROM (
  SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS orderkey,
         CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS amount,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderpriority END AS priority
  FROM orders)
WHERE NOT (orderkey IS NULL AND amount IS NULL AND priority IS NULL)""")
def drop_all_null_q(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("orderkey"),
                   F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("amount"),
                   F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("priority"))
    return drop_all_null(raw)
