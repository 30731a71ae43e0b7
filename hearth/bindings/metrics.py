"""Derived-metric operators on lineitem: level x = l_extendedprice / l_quantity,
change g = l_discount / l_tax (a zero discount stands for a -100 % change)."""

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.functions import (
    prior_from_ratio, prior_from_difference, prior_from_sum, prior_from_ratio_guarded,
    total_from_share, complement, count_from_rate, guarded_ratio, round_half_up, round_half_even,
)

def g_minus_one():
    return F.when(F.col("l_discount") == 0, F.lit(-1.0)).otherwise(F.col("l_discount"))
G_SQL = "CASE WHEN l_discount = 0 THEN -1.0 ELSE l_discount END"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
KEYS_SQL = "l_orderkey, l_linenumber, l_partkey"


@binding("prior_from_ratio", f"""
SELECT {KEYS_SQL},
       round(l_extendedprice / NULLIF(1 + {G_SQL}, 0), 4) AS price_lm,
       round(l_quantity / NULLIF(1 + l_tax, 0), 4) AS quantity_ly
FROM lineitem""")
def prior_from_ratio_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, round_half_up(prior_from_ratio("l_extendedprice", g_minus_one()), 4).alias("price_lm"),
                     round_half_up(prior_from_ratio("l_quantity", "l_tax"), 4).alias("quantity_ly"))


@binding("prior_from_difference", f"""
SELECT {KEYS_SQL},
       round(l_extendedprice - l_discount, 4) AS price_lm,
       round(l_quantity - l_tax, 4) AS quantity_ly
FROM lineitem""")
def prior_from_difference_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, round_half_up(prior_from_difference("l_extendedprice", "l_discount"), 4).alias("price_lm"),
                     round_half_up(prior_from_difference("l_quantity", "l_tax"), 4).alias("quantity_ly"))


@binding("prior_from_sum", f"""
SELECT {KEYS_SQL},
       round(l_extendedprice + l_discount, 4) AS price_lm,
       round(l_quantity + l_tax, 4) AS quantity_ly
FROM lineitem""")
def prior_from_sum_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, round_half_up(prior_from_sum("l_extendedprice", "l_discount"), 4).alias("price_lm"),
                     round_half_up(prior_from_sum("l_quantity", "l_tax"), 4).alias("quantity_ly"))


@binding("benchmark_level", f"""
SELECT {KEYS_SQL},
       round(l_quantity - l_discount, 4) AS median_days_on_market_us,
       round_even(l_extendedprice / NULLIF(1 + l_tax, 0), 2) AS median_listing_price_us
FROM lineitem""")
def benchmark_level_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS,
                     round_half_up(prior_from_difference("l_quantity", "l_discount"), 4).alias("median_days_on_market_us"),
                     round_half_even(prior_from_ratio("l_extendedprice", "l_tax"), 2).alias("median_listing_price_us"))


@binding("prior_from_ratio_guarded", f"""
SELECT {KEYS_SQL},
       round(CASE WHEN {G_SQL} = -1 THEN 0 ELSE l_extendedprice / NULLIF(1 + {G_SQL}, 0) END, 4) AS purchases_ly
FROM lineitem""")
def prior_from_ratio_guarded_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, round_half_up(prior_from_ratio_guarded("l_extendedprice", g_minus_one()), 4)
                     .alias("purchases_ly"))


@binding("total_from_share", f"""
SELECT {KEYS_SQL}, round(t, 4) AS total_purchases, round(t - l_quantity, 4) AS non_investor_purchases
FROM (SELECT *, CASE WHEN l_tax = 0 THEN 0 ELSE l_quantity / l_tax END AS t FROM lineitem)""")
def total_from_share_q(spark, sf):
    li = table(spark, sf, "lineitem")
    t = total_from_share("l_quantity", "l_tax")
    return li.select(*KEYS, round_half_up(t, 4).alias("total_purchases"),
                     round_half_up(complement(t, "l_quantity"), 4).alias("non_investor_purchases"))


@binding("count_from_rate", f"""
SELECT {KEYS_SQL}, round(l_tax * l_quantity, 0) AS sold_above_list,
       round(l_discount * l_quantity, 0) AS sold_price_drops
FROM lineitem""")
def count_from_rate_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, count_from_rate("l_tax", "l_quantity").alias("sold_above_list"),
                     count_from_rate("l_discount", "l_quantity").alias("sold_price_drops"))


@binding("guarded_ratio", f"""
SELECT {KEYS_SQL},
       CASE WHEN l_tax = 0 THEN 0 ELSE round(l_extendedprice / l_tax, 0) END AS median_sqft_off_sale_price
FROM lineitem""")
def guarded_ratio_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*KEYS, guarded_ratio("l_extendedprice", "l_tax").alias("median_sqft_off_sale_price"))
