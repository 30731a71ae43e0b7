"""Data-quality reports: flag counts, text-length conformance, quarantine."""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quality_flag_counts(df: DataFrame, flag_col: str, alias: str = "row_count") -> DataFrame:
    """Rows per quality flag, a missing flag counted as 0."""
    flag = F.coalesce(F.col(f"`{flag_col}`"), F.lit(0)).alias(flag_col)
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias(alias))


def text_length_report(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Declared VARCHAR(n) vs the data: per column the declared length, the
    longest value and the rows over the limit. One scan for all columns."""
    aggs = []
    for c, n in limits.items():
        length = F.length(F.col(f"`{c}`"))
        aggs += [F.max(length).alias(f"{c}__max"), F.count_if(length > F.lit(n)).alias(f"{c}__over")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("declared_length"),
                     F.col(f"`{c}__max`").cast("int").alias("max_length"),
                     F.col(f"`{c}__over`").cast("long").alias("rows_over"))
            for c, n in limits.items()]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def schema_report(df: DataFrame, target: Sequence[tuple[str, str]]) -> list[tuple[str, str, str | None]]:
    """(column, declared type, actual type or None) for every declared column (driver-side, schema only)."""
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    return [(c, t, actual.get(c.lower())) for c, t in target]


def failing_values(target: Sequence[tuple[str, str]], rules: Mapping[str, tuple[str, Column]] | None = None) -> list[Column]:
    """One struct (column_name, declared_type, raw_value) column for each declared column, NULL
    where its text is absent or casts, and for each named rule, NULL where it holds."""
    fails = []
    for c, t in target:
        src = F.col(f"`{c}`")
        bad = src.isNotNull() & src.cast("string").try_cast(t).isNull()
        fails.append(F.when(bad, F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("declared_type"),
                                          src.cast("string").alias("raw_value"))))
    for c, (rule, bad) in (rules or {}).items():
        fails.append(F.when(bad, F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("declared_type"),
                                          F.col(f"`{c}`").cast("string").alias("raw_value"))))
    return fails


def reject_rows(raw: DataFrame, target: Sequence[tuple[str, str]], keys: Sequence[str],
                rules: dict[str, tuple[str, F.Column]] | None = None) -> DataFrame:
    """Quarantine: one row per (record, column) whose text is present but does
    not cast to the declared type, plus one per failed named rule
    (``{column: (rule name, failure predicate)}``, e.g. a malformed quarter).
    One pass, no shuffle."""
    arr = F.filter(F.array(*failing_values(target, rules)), lambda x: x.isNotNull())
    return (raw.select(*[F.col(f"`{k}`") for k in keys], F.explode(arr).alias("f"))
            .select(*[F.col(f"`{k}`") for k in keys], "f.*"))


class NotConforming(ValueError):
    """A frame that does not fit its declared layout."""


_TEXT = re.compile(r"(?:var)?char\((\d+)\)$")


def conformance_report(df: DataFrame, declared: Sequence[tuple[str, str]]) -> DataFrame:
    """Declared layout against a frame, as a relation with one row per declared column and per
    column that is not declared: column_name, declared_type, actual_type (NULL where absent),
    declared_length, max_length, rows_over (for VARCHAR(n) columns, all from one scan) and
    status: ok, missing, undeclared, type or length.

    A declared VARCHAR is met by any string column whose texts are short enough."""
    spark = df.sparkSession
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    limits, rows = {}, []
    for name, dtype in declared:
        have, text = actual.pop(name.lower(), None), _TEXT.match(dtype.lower())
        if text and have == "string":
            limits[name] = int(text.group(1))
        status = "missing" if have is None else "ok" if have == ("string" if text else _plain(dtype)) else "type"
        rows.append((len(rows), name, dtype.lower(), have, int(text.group(1)) if text else None, status))
    for name, have in actual.items():
        rows.append((len(rows), name, None, have, None, "undeclared"))
    layout = spark.createDataFrame(rows, "position int, column_name string, declared_type string, actual_type string, "
                                         "declared_length int, status string")
    if not limits:
        lengths = spark.createDataFrame([], "measured string, max_length int, rows_over long")
    else:
        lengths = text_length_report(df, limits).select(F.col("column_name").alias("measured"), "max_length", "rows_over")
    # One row for each column of the layout on either side.
    out = layout.join(F.broadcast(lengths), F.col("column_name") == F.col("measured"), "left")
    status = F.when((F.col("status") == "ok") & (F.col("rows_over") > 0), "length").otherwise(F.col("status"))
    return out.select("position", "column_name", "declared_type", "actual_type", "declared_length", "max_length", "rows_over",
                      status.alias("status"))


def _plain(dtype: str) -> str:
    """A declared type in the form that schemas print."""
    return T.StructType.fromDDL(f"c {dtype}").fields[0].dataType.simpleString()


def require_conformance(df: DataFrame, declared: Sequence[tuple[str, str]], allow_extra: bool = True) -> DataFrame:
    """``df``, or NotConforming that names every column at fault (checked before a load)."""
    wrong = conformance_report(df, declared).where(F.col("status") != "ok")
    if allow_extra:
        wrong = wrong.where(F.col("status") != "undeclared")
    # At most one row for each column.
    bad = wrong.orderBy("position").collect()
    if bad:
        raise NotConforming("; ".join(f"{r['column_name']}: {r['status']} (declared {r['declared_type']}, found {r['actual_type']}"
                                      + (f", longest {r['max_length']}, {r['rows_over']} rows over" if r["rows_over"] else "") + ")" for r in bad))
    return df
