"""Quality reports on labels, documents and orders."""

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.quality import quality_flag_counts, text_length_report, reject_rows

# Declared text lengths of the documents layout.
DOC_LIMITS = {"text": 20000, "lang": 2, "source": 4}


@binding("quality_flag_counts", """
SELECT coalesce(CASE WHEN toxic = 1 THEN NULL ELSE quality END, 0) AS quality, count(*) AS row_count
FROM labels GROUP BY 1""")
def quality_flag_counts_q(spark, sf):
    lab = table(spark, sf, "labels").select(F.when(F.col("toxic") != 1, F.col("quality")).alias("quality"))
    return quality_flag_counts(lab, "quality")


@binding("text_length_check", """
SELECT 'text' AS column_name, 20000 AS declared_length, CAST(max(length(text)) AS INTEGER) AS max_length,
       CAST(count(*) FILTER (WHERE length(text) > 20000) AS BIGINT) AS rows_over FROM documents
UNION ALL
SELECT 'lang', 2, CAST(max(length(lang)) AS INTEGER), CAST(count(*) FILTER (WHERE length(lang) > 2) AS BIGINT)
FROM documents
UNION ALL
SELECT 'source', 4, CAST(max(length(source)) AS INTEGER), CAST(count(*) FILTER (WHERE length(source) > 4) AS BIGINT)
FROM documents""")
def text_length_check_q(spark, sf):
    return text_length_report(table(spark, sf, "documents"), DOC_LIMITS)


@binding("reject_rows", """
SELECT o_orderkey, 'period_begin' AS column_name, 'date' AS declared_type, d AS raw_value
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'not a date'
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
WHERE TRY_CAST(d AS DATE) IS NULL
UNION ALL
SELECT o_orderkey, 'amount', 'double', 'n/a' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def reject_rows_q(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("period_begin"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("amount"))
    return reject_rows(raw, [("period_begin", "date"), ("amount", "double")], ["o_orderkey"])
