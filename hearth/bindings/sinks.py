"""Sinks and readers exercised by a write + read-back under the shared folder.

Each call writes to a fresh location below ``spark.checkpoint.dir`` (never a
machine-local temp folder) and returns the table as read back, so the
check compares what a downstream reader would see."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.bindings import binding, table
from hearth.functions import yyyymm
from hearth.quality import audited_write
from hearth.session import scratch_path
from hearth.sinks import (
    write_replace, write_append, overwrite_periods, read_table, delete_period, freshness_gate,
    dimension_snapshot, export_csv, partition_values,
)
from hearth.sources import read_delimited, read_preamble_tsv
from hearth.functions import conform

YM_SQL = "CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)"
ORDERS_SCHEMA = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
RUN_TS = dt.datetime(2025, 1, 15, 6, 30, 0)


def _orders_by_month(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumn("month_date_yyyymm", yyyymm("o_orderdate"))


@binding("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip_q(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "csv_roundtrip")
    # Landed files carry padded header names; the reader strips them.
    export_csv(o.toDF(*[f" {c} " for c in o.columns]), path)
    return read_delimited(spark, path, ORDERS_SCHEMA)


@binding("preamble_skip", "SELECT * FROM orders")
def preamble_skip_q(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "preamble_skip")
    # One gzip TSV per order year, each with junk lines above its header.
    year = F.year("o_orderdate").alias("grp")
    data = o.select(year, (F.col("o_orderkey") + 2).alias("ord"),
                    F.concat_ws("\t", *[F.col(c).cast("string") for c in o.columns]).alias("line"))
    groups = data.select("grp").distinct()
    junk = groups.select("grp", F.lit(0).cast("long").alias("ord"),
                         F.concat(F.lit("Report generated for year "), F.col("grp").cast("string")).alias("line"))
    head = groups.select("grp", F.lit(1).cast("long").alias("ord"), F.lit("\t".join(o.columns)).alias("line"))
    lines = data.unionByName(junk).unionByName(head)
    (lines.repartition("grp").sortWithinPartitions("grp", "ord").select("line", "grp")
     .write.partitionBy("grp").option("compression", "gzip").mode("overwrite").text(path))
    return read_preamble_tsv(spark, path, ["o_orderkey", "o_orderdate"], ORDERS_SCHEMA)


@binding("freshness_gate", f"SELECT *, {YM_SQL} AS month_date_yyyymm FROM orders")
def freshness_gate_q(spark, sf):
    extract = _orders_by_month(spark, sf)
    path = scratch_path(spark, "freshness_gate")
    first = freshness_gate(spark, extract.where(F.col("month_date_yyyymm") < 199701), path, "month_date_yyyymm")
    second = freshness_gate(spark, extract, path, "month_date_yyyymm")
    third = freshness_gate(spark, extract, path, "month_date_yyyymm")
    assert (first.action, second.action, third.action) == ("full", "append", "none"), (first, second, third)
    return read_table(spark, path)


@binding("sink_replace", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem""")
def sink_replace_q(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                             "l_returnflag")
    path = scratch_path(spark, "sink_replace")
    write_replace(li.where(F.col("l_returnflag") == "R"), path)
    write_replace(li, path)
    return read_table(spark, path)


@binding("sink_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_append_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "sink_append")
    write_append(o.where(F.col("o_orderstatus") == "F"), path)
    write_append(o.where(F.col("o_orderstatus") != "F"), path)
    return read_table(spark, path)


@binding("delete_period", f"""
SELECT o_orderkey, o_totalprice, {YM_SQL} AS month_date_yyyymm FROM orders
WHERE {YM_SQL} <> (SELECT max({YM_SQL}) FROM orders)""")
def delete_period_q(spark, sf):
    o = _orders_by_month(spark, sf).select("o_orderkey", "o_totalprice", "month_date_yyyymm")
    path = scratch_path(spark, "delete_period")
    overwrite_periods(o, path, "month_date_yyyymm")
    newest = max(partition_values(spark, path, "month_date_yyyymm", T.IntegerType()))
    delete_period(spark, path, "month_date_yyyymm", newest)
    return read_table(spark, path)


@binding("dimension_snapshot", """
SELECT DISTINCT c_nationkey, c_mktsegment, 'Home_Values' AS dataset_type, DATE '2025-01-01' AS report_date
FROM customer
UNION ALL
SELECT DISTINCT c_nationkey, c_mktsegment, 'Rent_Values', DATE '2025-02-01' FROM customer""")
def dimension_snapshot_q(spark, sf):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "dimension_snapshot")
    dimension_snapshot(c, ["c_nationkey", "c_mktsegment"], path, dt.date(2025, 1, 1), "Home_Values")
    dimension_snapshot(c, ["c_nationkey", "c_mktsegment"], path, dt.date(2025, 2, 1), "Rent_Values")
    # Rerunning a snapshot for the same date replaces it instead of duplicating it.
    dimension_snapshot(c, ["c_nationkey", "c_mktsegment"], path, dt.date(2025, 2, 1), "Rent_Values")
    back = read_table(spark, path)
    return back.select("c_nationkey", "c_mktsegment", "dataset_type", F.col("report_date").cast("date"))


@binding("load_audit", f"""
SELECT 'orders_by_month' AS step, TIMESTAMP '2025-01-15 06:30:00' AS run_ts, count(*) AS rows_written,
       CAST(max({YM_SQL}) AS VARCHAR) AS max_period
FROM orders""")
def load_audit_q(spark, sf):
    o = _orders_by_month(spark, sf)
    path = scratch_path(spark, "load_audit")
    audited_write(o, lambda d: overwrite_periods(d, f"{path}/data", "month_date_yyyymm", clustered=True),
                  "orders_by_month", f"{path}/audit", RUN_TS, "month_date_yyyymm", partition_by=["month_date_yyyymm"])
    return spark.read.parquet(f"{path}/audit")


@binding("stream_incremental_load", f"SELECT o_orderkey, o_orderstatus, o_totalprice, {YM_SQL} AS month_date_yyyymm FROM orders")
def stream_incremental_load_q(spark, sf):
    """Orders land as CSV in two deliveries that share every period and order their columns
    differently; an availableNow file stream loads each delivery once, by name, beside the
    other; a third run with nothing new changes nothing."""
    from hearth.streaming import landed_csv_stream, incremental_load

    o = _orders_by_month(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice", "month_date_yyyymm")
    base = scratch_path(spark, "stream_incremental_load")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    typed = [("o_orderkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
             ("month_date_yyyymm", "int")]

    def run_once():
        q = incremental_load(landed_csv_stream(spark, landing), lambda b: conform(b, typed), target, "month_date_yyyymm", ckpt)
        q.awaitTermination()

    export_csv(o.where("o_orderkey % 2 = 0"), f"{landing}/delivery=1")
    run_once()
    export_csv(o.where("o_orderkey % 2 = 1").select(*reversed(o.columns)), f"{landing}/delivery=2")
    run_once()
    run_once()
    return read_table(spark, target).drop("load_batch")


@binding("stream_redelivery", f"""
WITH o AS (SELECT o_orderkey, o_totalprice, {YM_SQL} AS month_date_yyyymm, 'part' || CAST(o_orderkey % 2 AS VARCHAR) AS load_delivery FROM orders)
SELECT o_orderkey, o_totalprice, month_date_yyyymm, load_delivery FROM o
WHERE load_delivery = 'part1' OR o_orderkey % 3 <> 0""")
def stream_redelivery_q(spark, sf):
    """Two deliveries land; one lands again, corrected (another price, fewer rows), in a file of
    another name: it replaces what it brought, and the other delivery stays."""
    from hearth.streaming import landed_csv_stream, incremental_load

    o = _orders_by_month(spark, sf).select("o_orderkey", "o_totalprice", "month_date_yyyymm")
    base = scratch_path(spark, "stream_redelivery")
    typed = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("month_date_yyyymm", "int"), ("load_delivery", "string")]

    def run_once():
        incremental_load(landed_csv_stream(spark, f"{base}/landing"), lambda b: conform(b, typed), f"{base}/target", "month_date_yyyymm",
                         f"{base}/checkpoint", delivery="orders=(part[01])", ledger_path=f"{base}/ledger").awaitTermination()
    export_csv(o.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(-1.0)), f"{base}/landing/try=1/orders=part0")
    export_csv(o.where("o_orderkey % 2 = 1"), f"{base}/landing/try=1/orders=part1")
    run_once()
    export_csv(o.where("o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0"), f"{base}/landing/try=2/orders=part0")
    run_once()
    return read_table(spark, f"{base}/target")
