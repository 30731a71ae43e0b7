"""From landed rows to a loaded table, with every row accounted for.

A landed frame is classified once and staged: its rows, the typed period, what kind of row
each is, and which of its values do not fit their declared types. Everything that a load
writes (the table, the quarantine, the ledger's counts) is cut from that staged table, so
the landed text is parsed once and all of them agree.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field, replace
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions._util import q
from hearth.quality.checks import failing_values
from hearth.quality.ledger import LoadEntry, Unaccounted, record, run_id_of
from hearth.session import stage
from hearth.sinks import GateResult, latest_loaded, overwrite_partitions, partition_values, write_periods

PERIOD, KIND, REJECTS = "__period", "__kind", "__rejects"
EMPTY_PERIOD = "empty period"


@dataclass(frozen=True)
class Run:
    """One run of one step: its time, its names in the ledger, and where it leaves records."""
    table: str
    run_ts: _dt.datetime
    step: str = "load"
    ledger_path: str | None = None
    quarantine_path: str | None = None

    @property
    def run_id(self) -> str:
        return run_id_of(self.run_ts)


@dataclass(frozen=True)
class Landed:
    """How a family's landed rows are told apart.

    ``period`` and ``period_type``: the column that dates a row (None: rows are not dated).
    ``footer``: text that the period of a closing disclaimer line begins with.
    ``values``: (column, declared type) of everything else that must parse.
    ``rules``: {column: (name, failure predicate)}. ``keys``: columns that name a row in the
    quarantine. ``blank``: columns all NULL in a blank row. ``excluded``: predicate of rows
    that this load leaves out on purpose. ``needed``: (column, type) without which a row
    cannot be loaded at all."""
    period: str | None = None
    period_type: str = "int"
    footer: str | None = None
    values: Sequence[tuple[str, str]] = ()
    rules: Mapping[str, tuple[str, Column]] = field(default_factory=dict)
    keys: Sequence[str] = ()
    blank: Sequence[str] = ()
    excluded: Column | None = None
    needed: Sequence[tuple[str, str]] = ()


def classify(raw: DataFrame, landed: Landed) -> DataFrame:
    """``raw`` staged with the typed period, the row's kind (dated, footer, blank, excluded or
    quarantined) and the values that do not fit. Each row has exactly one kind."""
    must = ([(landed.period, landed.period_type)] if landed.period else []) + list(landed.needed)
    kind = F.lit("dated")
    rejects = []
    for column, dtype in reversed(must):
        text = F.col(q(column)).cast("string")
        empty = F.coalesce(F.trim(text), F.lit("")) == ""
        bad = text.try_cast(dtype).isNull()
        kind = F.when(bad, F.lit("quarantined")).otherwise(kind)
        rule = F.when(empty, F.lit(EMPTY_PERIOD if column == landed.period else "empty key")).otherwise(F.lit(dtype))
        rejects.insert(0, F.when(bad, F.struct(F.lit(column).alias("column_name"), rule.alias("declared_type"), text.alias("raw_value"))))
    if landed.footer and landed.period:
        period = F.trim(F.col(q(landed.period)).cast("string"))
        kind = F.when(F.coalesce(period.startswith(landed.footer), F.lit(False)), F.lit("footer")).otherwise(kind)
    if landed.blank:
        none = F.lit(True)
        for c in landed.blank:
            none = none & F.col(q(c)).isNull()
        kind = F.when(none, F.lit("blank")).otherwise(kind)
    if landed.excluded is not None:
        kind = F.when(F.coalesce(landed.excluded, F.lit(False)), F.lit("excluded")).otherwise(kind)
    known = {c.lower() for c in raw.columns}
    values = [(c, t) for c, t in landed.values if c.lower() in known and (c, t) not in must]
    rejects += failing_values(values, landed.rules)
    array = F.filter(F.array(*rejects), lambda x: x.isNotNull()) if rejects else F.array().cast(
        "array<struct<column_name:string,declared_type:string,raw_value:string>>")
    period = F.col(q(landed.period)).cast("string").try_cast(landed.period_type) if landed.period else F.lit(None).cast("int")
    out = raw.select("*", period.alias(PERIOD), kind.alias(KIND)).withColumn(
        REJECTS, F.when(F.col(KIND).isin("dated", "quarantined"), array))
    return stage(out, "landed_rows")


@dataclass(frozen=True)
class Split:
    """A classified frame and which of its dated rows this run loads."""
    rows: DataFrame
    columns: Sequence[str]
    fresh: Column

    def loaded(self) -> DataFrame:
        return self.rows.where(self.fresh).select(*[q(c) for c in self.columns])


def split_by_period(raw: DataFrame, landed: Landed, newer_than: Any = None, latest_only: bool = False) -> Split:
    """Classify, then take the dated rows newer than a period (only the newest with ``latest_only``)."""
    rows = classify(raw, landed)
    fresh = F.col(KIND) == "dated"
    if newer_than is not None:
        fresh = fresh & (F.col(PERIOD) > F.lit(newer_than))
        if latest_only:
            # One column of the staged table.
            newest = rows.where(fresh).agg(F.max(PERIOD)).first()[0]
            fresh = fresh & (F.col(PERIOD) == F.lit(newest)) if newest is not None else fresh
    return Split(rows, raw.columns, fresh)


def account(split: Split, run: Run, action: str = "") -> LoadEntry:
    """Count what becomes of each landed row, from the staged table's two narrow columns."""
    fresh = F.coalesce(split.fresh, F.lit(False))
    kinds = ("excluded", "blank", "footer", "quarantined")
    c = split.rows.agg(
        F.count(F.lit(1)).alias("read"), F.count_if(fresh).alias("loaded"),
        F.count_if((F.col(KIND) == "dated") & ~fresh).alias("older"),
        *[F.count_if(F.col(KIND) == k).alias(k) for k in kinds],
        F.coalesce(F.sum(F.when(fresh | (F.col(KIND) == "quarantined"), F.size(REJECTS))), F.lit(0)).alias("rejects"),
        F.max(F.when(fresh, F.col(PERIOD))).cast("string").alias("newest")).first()
    return LoadEntry(run.table, run.run_id, run.step, run.run_ts, action or ("load" if c["loaded"] else "none"), c["read"], c["loaded"], c["older"],
                     c["excluded"], c["blank"], c["footer"], c["quarantined"], int(c["rejects"]), c["newest"]).check()


def quarantine(split: Split, landed: Landed, run: Run, entry: LoadEntry) -> None:
    """Write what does not fit: one row for each failing value of a loaded row, and of each row
    that cannot be loaded. The run's own partition is replaced, so a rerun adds nothing; a rerun
    that finds everything loaded leaves the first run's rows. Without a path, rows that could
    not be loaded are an error, not a silence."""
    if not run.quarantine_path:
        if entry.rows_quarantined:
            raise Unaccounted(f"{run.table}, {run.step}: {entry.rows_quarantined} of {entry.rows_read} landed rows cannot be "
                              f"loaded (no valid {landed.period or 'key'}) and there is no quarantine path")
        return
    spark = split.rows.sparkSession
    tags = {"table_name": run.table, "run_id": run.run_id, "step": run.step}
    if not entry.values_rejected:
        return
    if not entry.rows_loaded and _has_partition(spark, run.quarantine_path, tags):
        return
    keys = [c for c in landed.keys if c.lower() in {x.lower() for x in split.columns}]
    types = dict(landed.needed)  # such keys are typed; the text that did not parse is the raw value
    named = [F.col(q(k)).cast("string").try_cast(types[k]).alias(k) if k in types else F.col(q(k)) for k in keys]
    rows = (split.rows.where(split.fresh | (F.col(KIND) == "quarantined"))
            .select(*named, F.explode(REJECTS).alias("f"))
            .select(*[F.col(q(k)) for k in keys], "f.*", *[F.lit(v).alias(k) for k, v in tags.items()]))
    overwrite_partitions(rows, run.quarantine_path, list(tags))


def _has_partition(spark: SparkSession, path: str, tags: Mapping[str, str]) -> bool:
    at = path
    for k, v in tags.items():
        if v not in partition_values(spark, at, k, T.StringType()):
            return False
        at = os.path.join(at, f"{k}={v}")
    return True


def load_by_period(spark: SparkSession, raw: DataFrame, landed: Landed, transform: Callable[[DataFrame], DataFrame],
                   target_path: str, target_period: str, run: Run, latest_only: bool = False) -> GateResult:
    """The freshness gate over landed rows: nothing loaded yet, all of them; else the periods
    newer than the table's latest. Quarantine first, then the table, then the ledger: a run
    that dies in between is run again and replaces what it left."""
    newest = latest_loaded(spark, target_path, target_period, landed.period_type)
    split = split_by_period(raw, landed, newest, latest_only)
    entry = account(split, run, "full" if newest is None else "append")
    quarantine(split, landed, run, entry)
    if entry.rows_loaded:
        written, top = write_periods(transform(split.loaded()), target_path, target_period, replace=newest is None)
        if written != entry.rows_loaded:
            raise Unaccounted(f"{run.table}, {run.step}: {entry.rows_loaded} rows to load, {written} written")
        result = GateResult(entry.action, newest, top, written, entry)
    else:
        entry = replace(entry, action="none")
        result = GateResult("none", newest, None, 0, entry)
    if run.ledger_path:
        record(spark, run.ledger_path, entry)
    return result


def load_whole(spark: SparkSession, raw: DataFrame, landed: Landed, run: Run,
               write: Callable[[DataFrame], None]) -> LoadEntry:
    """Load every row that can be loaded, replacing the target (``write`` gets the landed rows)."""
    split = split_by_period(raw, landed)
    entry = account(split, run, "replace")
    quarantine(split, landed, run, entry)
    write(split.loaded())
    if run.ledger_path:
        record(spark, run.ledger_path, entry)
    return entry
