"""Scale properties of the physical plans (guards against plan regressions)."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from hearth.bindings import load_all
from hearth.operators import fill_down
from hearth.sinks import overwrite_periods
from tests.conftest import SMALL_SF

REG = load_all()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_reach_the_scan(spark):
    text = _formatted(REG["period_range_filter"].fn(spark, SMALL_SF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "EqualTo(o_orderstatus,F)" in text


def test_projection_is_pruned_and_codegen(spark):
    text = _formatted(REG["prior_from_ratio"].fn(spark, SMALL_SF))
    schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")][0]
    assert "l_returnflag" not in schema and "l_shipdate" not in schema
    assert "Exchange" not in text and "[codegen id : 1]" in text


def test_fill_down_shuffles_the_data_once(spark):
    df = spark.range(5000).select(F.col("id").alias("row_no"), (F.col("id") % 7).alias("k"),
                                  F.when(F.col("id") % 11 == 0, F.col("id").cast("string")).alias("q"),
                                  (F.col("id") * 2).alias("payload"))
    plan = fill_down(df, ["q"], "row_no", keys=["k"], bucket_width=100)._jdf.queryExecution().executedPlan().toString()
    # one exchange: the data on (key, bucket); the carries were summarised before and are staged
    assert plan.count("Exchange hashpartitioning(__g0") == 1
    assert "max_by" not in plan
    assert "Exchange SinglePartition" not in plan


def test_partitioned_write_one_file_per_period(spark, tmpdir_path):
    df = spark.range(20000).select((F.col("id") % 12 + 202401).alias("p"), F.col("id"))
    overwrite_periods(df.repartition(8), f"{tmpdir_path}/t", "p")
    files = [f for _, _, fs in os.walk(f"{tmpdir_path}/t") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 12 + 4          # ~one file per period (rebalance), not tasks x periods (96)


def test_hot_period_is_split_across_tasks(spark, tmpdir_path):
    """A period holding most rows is written by several tasks, not one."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(256 * 1024))
    try:
        df = spark.range(400_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 5 + 202402)
                                         .otherwise(F.lit(202401)).alias("p"),
                                         (F.col("id") * 7919 % 1000003).alias("v"), F.col("id"))
        overwrite_periods(df.repartition(8), f"{tmpdir_path}/hot", "p")
    finally:
        spark.conf.set(key, old)
    hot = [f for f in os.listdir(f"{tmpdir_path}/hot/p=202401") if f.endswith(".parquet")]
    assert len(hot) > 1
