"""Session defaults and the shared scratch location.

Everything that must survive executor loss (checkpoints, staged tables, sink
output in the checks) lives under the folder the cluster names in
``spark.checkpoint.dir``. We only pick our own folder when that setting is
absent *and* Spark runs in local mode (tests, laptop runs).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed defaults for every session we build ourselves.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partitioned writes are clustered with a rebalance hint; AQE splits a hot
    # period into several tasks instead of one.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # MIN/MAX/COUNT from Parquet footers where the scan supports it (V2 readers).
    "spark.sql.parquet.aggregatePushdown": "true",
    # Re-running a load for a period replaces that period only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Python call-site capture for error messages costs ~10 py4j round trips per
    # Column built; wide generated projections build thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Sizing for the large-cluster target (~100 TB input, ~1000 executors). The
# initial shuffle width is high on purpose: AQE coalesces small partitions to
# the advisory size at runtime, while a too-low width cannot be split after
# the fact and spills. Scan splits and advisory sizes aim at ~256 MB per task.
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    # Runtime (AQE) broadcast only below this measured size; planning-time
    # broadcasts use Spark's estimate against the same bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hearth", extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Our session: ``profile='cluster'`` adds CLUSTER_PROFILE sizing."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if profile == "cluster":
        conf.update(CLUSTER_PROFILE)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect: no SparkContext, treat as a cluster
        return False


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    folder). Only when neither is set *and* Spark runs in local mode (tests,
    laptop runs) do we pick our own folder; on a cluster that is an error, so a
    job never writes to a machine-local folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path and path.startswith("file:") and not _is_local(spark):
        raise RuntimeError(f"spark.checkpoint.dir is machine-local ({path}); a cluster needs a shared folder")
    ctx_dir = None
    try:
        ctx_dir = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext
        pass
    if path:
        if not ctx_dir:
            try:
                spark.sparkContext.setCheckpointDir(path)
            except Exception:
                pass
        return path.rstrip("/")
    if ctx_dir:
        return ctx_dir.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    # spark.checkpoint.dir cannot be changed at runtime; the context's folder can.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hearth-ckpt-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_RUN = uuid.uuid4().hex[:12]   # this process's part of the scratch folder
_roots: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder, removed when this process ends
    (results are read by then: a lazy frame does not outlive its process)."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    root = os.path.join(base, "hearth-scratch", _RUN)
    if not _roots:
        atexit.register(release_scratch)
    _roots[root] = spark
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def release_scratch() -> None:
    """Remove what this process staged in the shared folder. Runs by itself at the end of the
    process; a long-lived one may call it between runs, when no staged result is read any more."""
    for root, spark in list(_roots.items()):
        try:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            del _roots[root]
        except Exception:  # the session is gone: its files are left to the folder's owner
            pass


def stage(df, name: str):
    """Materialise ``df`` once as Parquet under the shared folder and read it back.

    Used for small shared intermediates that several jobs read: it cuts the
    lineage (a lost executor re-reads the files instead of re-running the
    joins) and, unlike an RDD checkpoint, computes the input only once."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
