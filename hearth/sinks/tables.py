"""Period-partitioned table sinks and the incremental-load gate.

Tables are Parquet directories partitioned by their period column. Re-loading
a period replaces exactly that period (dynamic partition overwrite), so a
retried or repeated run changes nothing. Writes go through Spark's commit
protocol: a task lost half-way is re-run and its partial files discarded.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from typing import Any, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def cluster_for_write(df: DataFrame, partition_by: Sequence[str] | None) -> DataFrame:
    """Cluster rows by the partition columns before a partitioned write.

    Without it every task writes a file into every period it holds (tasks x
    periods small files). ``rebalance`` lets AQE split an oversized (hot)
    period across several tasks instead of sending it to one. Observe metrics
    on the clustered frame (above the shuffle), not below it."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str] | None, fmt: str, clustered: bool = False):
    if partition_by:
        df = df if clustered else cluster_for_write(df, partition_by)
        return df.write.mode(mode).format(fmt).partitionBy(*partition_by)
    return df.write.mode(mode).format(fmt)


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet", clustered: bool = False) -> None:
    """Replace the whole table (history load)."""
    _writer(df, "overwrite", partition_by, fmt, clustered).option("partitionOverwriteMode", "static").save(path)


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 fmt: str = "parquet", clustered: bool = False) -> None:
    _writer(df, "append", partition_by, fmt, clustered).save(path)


def drop_table(spark: SparkSession, path: str) -> bool:
    """Remove a path table's folder (DROP TABLE for a path-based table)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))


def write_create(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 fmt: str = "parquet") -> None:
    """Drop, then create: the write fails if another job re-created the table meanwhile."""
    drop_table(spark, path)
    _writer(df, "errorifexists", partition_by, fmt).save(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000,
               num_partitions: int | None = None, properties: dict | None = None) -> None:
    """Load into a database table: each task inserts in batches of ``batchsize``
    rows over its own connection; ``num_partitions`` caps concurrent connections."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", batchsize)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet",
                         clustered: bool = False) -> None:
    """Replace the partitions that ``df`` carries; others stay untouched."""
    _writer(df, "overwrite", columns, fmt, clustered).option("partitionOverwriteMode", "dynamic").save(path)


def overwrite_periods(df: DataFrame, path: str, period_col: str, fmt: str = "parquet",
                      clustered: bool = False) -> None:
    """Append new periods / replace re-delivered ones; other periods untouched."""
    overwrite_partitions(df, path, [period_col], fmt, clustered)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``; None where there is none (or a folder without data)."""
    if not table_exists(spark, path) and not recover_swap(spark, path):
        return None
    try:
        return spark.read.format(fmt).option("basePath", path).load(path)
    except AnalysisException:
        return None


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``. The old folder is set aside
    before and removed after: whoever dies in between leaves it, and ``recover_swap`` puts it back."""
    fs, target = _fs(spark, path)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    aside = Path(f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(Path(new), target):
        fs.rename(aside, target)
        raise OSError(f"cannot put {new} in the place of {path}")
    fs.delete(aside, True)


def recover_swap(spark: SparkSession, path: str) -> bool:
    """Put back the table that an interrupted swap set aside. True when there was one."""
    fs, target = _fs(spark, path)
    if fs.exists(target) or target.getParent() is None or not fs.exists(target.getParent()):
        return False
    for st in fs.listStatus(target.getParent()):
        if st.isDirectory() and st.getPath().getName().startswith(f"{target.getName()}__old_"):
            return bool(fs.rename(st.getPath(), target))
    return False


def _folder_holds(text: str, value: Any) -> bool:
    """Whether a partition folder's (unescaped) text stands for ``value``."""
    if value is None or text == "__HIVE_DEFAULT_PARTITION__":
        return value is None and text == "__HIVE_DEFAULT_PARTITION__"
    try:
        if isinstance(value, _dt.datetime):
            return _dt.datetime.fromisoformat(text) == value
        if isinstance(value, _dt.date):
            return _dt.date.fromisoformat(text) == value
    except ValueError:
        return False
    return text == str(value)


def delete_period(spark: SparkSession, path: str, period_col: str, value: Any) -> bool:
    """Delete one period (any type, None for rows without one). True when there was such a period.

    A table partitioned by the period loses that folder: no data is read. Any other table is
    written again without the period beside the old one, which is then swapped out, so a job
    that dies on the way leaves the old table."""
    recover_swap(spark, path)
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return False
    prefix = f"{period_col}="
    folders = [st.getPath() for st in fs.listStatus(root) if st.isDirectory() and st.getPath().getName().startswith(prefix)]
    if folders:
        # The name as Spark wrote it: special characters are escaped, so names are compared unescaped.
        mine = [p for p in folders if _folder_holds(unquote(p.getName()[len(prefix):]), value)]
        return all([fs.delete(p, True) for p in mine]) if mine else False
    table = read_table(spark, path)
    if table is None or period_col not in table.columns:
        raise ValueError(f"{path} has no column {period_col}")
    same = F.col(f"`{period_col}`").eqNullSafe(F.lit(value).cast(table.schema[period_col].dataType))
    if table.where(same).isEmpty():
        return False
    new = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
    table.where(~same).write.parquet(new)
    swap_in(spark, new, path)
    return True


@dataclass(frozen=True)
class GateResult:
    action: str            # 'full', 'append' or 'none'
    target_max: Any
    extract_max: Any
    rows_written: int = 0
    entry: Any = None      # the ledger's entry, where landed rows are accounted for
    rows_without_period: int = 0


def _parse_partition_value(text: str, dtype: T.DataType):
    if text == "__HIVE_DEFAULT_PARTITION__":
        return None
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(text)
    if isinstance(dtype, T.DateType):
        return _dt.date.fromisoformat(text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _dt.datetime.fromisoformat(text)
    return text


def partition_values(spark: SparkSession, path: str, column: str, dtype: T.DataType) -> list:
    """Values of a partition column read from the folder listing (metadata only,
    O(partitions), no data file is opened)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    prefix = f"{column}="
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            v = _parse_partition_value(unquote(name[len(prefix):]), dtype)
            if v is not None:
                out.append(v)
    return out


def _holds_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder has an entry that is not a marker or hidden file."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(root) and any(st.getPath().getName()[0] not in "._" for st in fs.listStatus(root))


def latest_loaded(spark: SparkSession, path: str, period_col: str, dtype: T.DataType | str) -> Any:
    """The latest period of a period-partitioned table, from its folders (no scan); None
    while nothing is loaded. A folder that holds data but no period of this column is not
    our table: that raises rather than let a full load replace it."""
    if isinstance(dtype, str):
        dtype = T.StructType.fromDDL(f"c {dtype}").fields[0].dataType
    present = partition_values(spark, path, period_col, dtype)
    if not present and _holds_data(spark, path):
        raise ValueError(f"{path} holds data but no partition of {period_col}")
    return max(present) if present else None


def write_periods(extract: DataFrame, path: str, period_col: str, replace: bool, fmt: str = "parquet") -> tuple[int, Any]:
    """Write periods (``replace``: the whole table; else those that ``extract`` carries) and
    return the rows and the latest period of the write itself. Rows without a period are not written."""
    n, top, _ = _observed_write(extract, path, period_col, replace, fmt)
    return n, top


def _observed_write(extract, path, period_col, replace, fmt):
    col = F.col(f"`{period_col}`")
    obs = Observation(f"gate_{uuid.uuid4().hex[:8]}")
    rows = cluster_for_write(extract, [period_col]).observe(
        obs, F.count_if(col.isNotNull()).alias("n"), F.max(col).alias("m"), F.count_if(col.isNull()).alias("none"))
    write = write_replace if replace else overwrite_partitions
    write(rows.where(col.isNotNull()), path, [period_col], fmt, clustered=True)
    m = obs.get
    return int(m["n"]), m["m"], int(m["none"])


def freshness_gate(spark: SparkSession, extract: DataFrame, target_path: str, period_col: str,
                   latest_only: bool = False, fmt: str = "parquet") -> GateResult:
    """Load ``extract`` into the table at ``target_path`` partitioned by ``period_col``.

    * no target yet: full history load;
    * otherwise: load the extract's periods newer than the target's latest
      period (only the newest one with ``latest_only``); when there are none,
      nothing is written.
    The target's latest period comes from its partition listing, not a scan,
    and the extract is read once: the rows and max period loaded are observed
    during the write itself. Rows without a period are never loaded; the result
    counts them (``plans.landing`` gives each of them a place).
    """
    col = F.col(f"`{period_col}`")
    target_max = latest_loaded(spark, target_path, period_col, extract.schema[period_col].dataType)
    if target_max is None:
        n, top, none = _observed_write(extract, target_path, period_col, True, fmt)
        return GateResult("full" if n else "none", None, top, n, rows_without_period=none)
    newer = extract.where(col.isNull() | (col > F.lit(target_max)))
    if latest_only:
        newer = newer.where(col.isNull() | (col == newer.select(F.max(col)).scalar()))
    n, top, none = _observed_write(newer, target_path, period_col, False, fmt)
    return GateResult("append" if n else "none", target_max, top, n, rows_without_period=none)


def dimension_snapshot(df: DataFrame, columns: Sequence[str], path: str, report_date, dataset_type: str,
                       fmt: str = "parquet") -> DataFrame:
    """Append the distinct dimension rows tagged with report date and dataset type
    (tags are added before the write). A rerun for the same report date and
    dataset replaces that snapshot."""
    snap = (df.select(*[F.col(f"`{c}`") for c in columns]).distinct()
            .withColumn("dataset_type", F.lit(dataset_type))
            .withColumn("report_date", F.lit(report_date).cast("date")))
    _writer(snap, "overwrite", ["report_date", "dataset_type"], fmt) \
        .option("partitionOverwriteMode", "dynamic").save(path)
    return snap


def snapshot_view(spark: SparkSession, path: str, columns: Sequence[str], view: str) -> DataFrame:
    """A view of the distinct dimension rows over all snapshots of the archive, and its rows.

    The view is a query, not a copy: later snapshots show when it is read again."""
    if read_table(spark, path) is None:
        raise ValueError(f"no archive at {path}")
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{view}__archive` USING parquet OPTIONS (path '{path}', basePath '{path}')")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{view}` AS SELECT DISTINCT {listed} FROM `{view}__archive`")
    return spark.table(f"`{view}`")


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Parallel CSV export (one file per partition)."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def export_sample(df: DataFrame, path: str, n: int, order: Sequence) -> None:
    """Bounded, ordered sample export (the spreadsheet preview re-aimed to CSV)."""
    export_csv(df.orderBy(*order).limit(n), path)
