"""Run audit: one row per load step, from metrics observed during the write.

``DataFrame.observe`` computes the row count and max period as a side effect
of the write itself (no second pass over the data); the single audit row is
appended to an audit table next to the data, once for each step and run time.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

AUDIT_SCHEMA = "step string, run_ts timestamp_ntz, rows_written long, max_period string"


def audited_write(df: DataFrame, write: Callable[[DataFrame], None], step: str, audit_path: str,
                  run_ts: _dt.datetime, period_col: str | None = None,
                  partition_by: list[str] | None = None) -> DataFrame:
    """``write`` receives the observed frame. For a partitioned sink pass
    ``partition_by``: the frame is clustered first and observed above that
    shuffle, and ``write`` must then save it with ``clustered=True``."""
    from hearth.sinks.tables import cluster_for_write, read_table
    df = cluster_for_write(df, partition_by)
    obs = Observation(f"audit_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows_written")]
    metrics.append((F.max(F.col(f"`{period_col}`")) if period_col else F.lit(None)).cast("string").alias("max_period"))
    write(df.observe(obs, *metrics))
    m = obs.get
    spark = df.sparkSession
    row = spark.createDataFrame([(step, run_ts, int(m["rows_written"]), m["max_period"])], AUDIT_SCHEMA)
    # A step that is run again for the same time leaves no second row.
    same = (F.col("step") == F.lit(step)) & F.col("run_ts").eqNullSafe(F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"))
    if read_table(spark, audit_path) is None or read_table(spark, audit_path).where(same).isEmpty():
        row.write.mode("append").parquet(audit_path)
    return row
