"""The load ledger: one row for each (table, run, step), however often a step is run.

The ledger is a Parquet table partitioned by its key. A step writes its own partition with
dynamic overwrite, so a retry replaces its row and never adds a second, and runs of
different tables never touch each other's files.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

KEY = ["table_name", "run_id", "step"]
#: What can become of a landed row.
FATES = ("loaded", "older", "excluded", "blank", "footer", "quarantined")
LEDGER_SCHEMA = ("run_ts timestamp_ntz, action string, rows_read long, "
                 + ", ".join(f"rows_{f} long" for f in FATES)
                 + ", values_rejected long, max_period string, table_name string, run_id string, step string")


class Unaccounted(ValueError):
    """Landed rows that no fate explains, or that would vanish unseen."""


@dataclass(frozen=True)
class LoadEntry:
    """What one step read and what became of it; read is the sum of the fates."""
    table_name: str
    run_id: str
    step: str
    run_ts: _dt.datetime
    action: str
    rows_read: int
    rows_loaded: int = 0
    rows_older: int = 0
    rows_excluded: int = 0
    rows_blank: int = 0
    rows_footer: int = 0
    rows_quarantined: int = 0
    values_rejected: int = 0
    max_period: str | None = None

    def check(self) -> "LoadEntry":
        told = sum(getattr(self, f"rows_{f}") for f in FATES)
        if told != self.rows_read:
            raise Unaccounted(f"{self.table_name}, {self.step}: {self.rows_read} rows read, {told} accounted for: {self}")
        return self


def run_id_of(run_ts: _dt.datetime) -> str:
    """A run's name in folders: its time, in a form that reads back as text."""
    return run_ts.strftime("run-%Y%m%dT%H%M%S")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries; an empty frame where nothing has been recorded."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_SCHEMA)


def entry_of(spark: SparkSession, path: str, table_name: str, run_id: str, step: str):
    """The recorded row of one step, or None; only its own partition is read."""
    at = {"table_name": table_name, "run_id": run_id, "step": step}
    found = read_ledger(spark, path)
    for k, v in at.items():
        found = found.where(F.col(k) == F.lit(v))
    return found.first()


def record(spark: SparkSession, path: str, entry: LoadEntry) -> None:
    """Write the step's row. A step that is run again after it has loaded finds its own rows
    to be old: then the row of the run that loaded them stays."""
    entry.check()
    if not entry.rows_loaded:
        before = entry_of(spark, path, entry.table_name, entry.run_id, entry.step)
        if before is not None and before["rows_loaded"]:
            return
    values = asdict(entry)
    names = [c.split(" ")[0] for c in LEDGER_SCHEMA.split(", ")]
    row = spark.createDataFrame([tuple(values[n] for n in names)], LEDGER_SCHEMA)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEY).parquet(path)
