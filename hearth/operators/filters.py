"""Row selection: region restriction, footer rejection, period slices."""

from __future__ import annotations

import datetime as _dt
from typing import Any, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def region_filter(df: DataFrame, column: str, value: Any | None) -> DataFrame:
    """Keep one region (e.g. a state) when ``value`` is set; otherwise everything.
    Put it before any reshape so it reaches the scan as a pushed filter."""
    if value is None:
        return df
    return df.where(F.col(f"`{column}`") == F.lit(value))


def footer_reject(df: DataFrame, period_col: str, period_type: str = "int") -> DataFrame:
    """Drop rows whose period does not parse (disclaimer/footer lines in a landed file).

    Type the period afterwards with ``try_cast``, not ``cast``: under ANSI mode
    Catalyst may evaluate a later predicate on the cast before this filter."""
    return df.where(F.col(f"`{period_col}`").cast("string").try_cast(period_type).isNotNull())


def period_range(df: DataFrame, column: str, start: Any = None, end: Any = None,
                 equals: dict[str, Any] | None = None) -> DataFrame:
    """start <= period (< end), plus optional equality predicates; all pushable."""
    cond = F.lit(True)
    c = F.col(f"`{column}`")
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & (c < F.lit(end))
    for k, v in (equals or {}).items():
        cond = cond & (F.col(f"`{k}`") == F.lit(v))
    return df.where(cond)


def latest_period(df: DataFrame, column: str):
    """Scalar MAX of the period column (one small aggregate job; for a
    partitioned table use ``sinks.partition_values`` instead: no scan)."""
    return df.agg(F.max(F.col(f"`{column}`")).alias("m")).first()["m"]


def latest_period_slice(df: DataFrame, column: str) -> DataFrame:
    """Rows of the latest period. The max is resolved first, so the slice is a
    literal predicate that prunes partitions and is pushed to the scan."""
    top = latest_period(df, column)
    if top is None:
        return df.limit(0)
    return df.where(F.col(f"`{column}`") == F.lit(top))


def month_bounds(period: int) -> tuple[_dt.date, _dt.date]:
    """A year-month number's first day and the first day after it: the inverse of ``yyyymm``."""
    year, month = divmod(int(period), 100)
    if not 1 <= month <= 12:
        raise ValueError(f"{period} is no year-month")
    return _dt.date(year, month, 1), _dt.date(year + month // 12, month % 12 + 1, 1)


def _typed(day: _dt.date, dtype: T.DataType):
    return F.lit(day.isoformat()).cast(dtype)


def months_between(df: DataFrame, column: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows whose year-month lies in first..last (numbers like 202502, either end open).

    A predicate on a computed year-month reads every row; this one compares the stored date
    or timestamp with literals, so it reaches the scan and skips row groups and partitions."""
    dtype, c = df.schema[column].dataType, F.col(f"`{column}`")
    if first is not None:
        df = df.where(c >= _typed(month_bounds(first)[0], dtype))
    if last is not None:
        df = df.where(c < _typed(month_bounds(last)[1], dtype))
    return df


def newer_months(df: DataFrame, column: str, loaded: int | None) -> DataFrame:
    """Rows of months after ``loaded`` (all where nothing is loaded), as a range of the stored column."""
    if loaded is None:
        return df
    return df.where(F.col(f"`{column}`") >= _typed(month_bounds(loaded)[1], df.schema[column].dataType))


def latest_month_slice(df: DataFrame, column: str) -> DataFrame:
    """Rows of the latest month of a stored date or timestamp column. The newest value is
    found from that one column; the slice itself is one scan with a pushed range."""
    top = latest_period(df, column)
    if top is None:
        return df.limit(0)
    month = top.year * 100 + top.month
    return months_between(df, column, month, month)


def newer_than(df: DataFrame, column: str, threshold: Any) -> DataFrame:
    if threshold is None:
        return df
    return df.where(F.col(f"`{column}`") > F.lit(threshold))


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every (listed) column is NULL (blank spreadsheet rows)."""
    return df.dropna(how="all", subset=list(subset) if subset else None)
