"""Wide month-per-column series files (one row per region, one column per month)."""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from hearth.operators.reshape import melt, header_to_date
from hearth.sources.delimited import read_delimited_raw
from pyspark.sql import functions as F


def _is_date(header: str) -> bool:
    try:
        return bool(_dt.date.fromisoformat(header))
    except ValueError:
        return False


def read_wide_series(spark: SparkSession, path: str | Sequence[str], id_cols: Sequence[str],
                     drop: Sequence[str] = ()) -> DataFrame:
    """Raw wide table: ids + every other column is a period header."""
    raw = read_delimited_raw(spark, path)
    if drop:
        raw = raw.drop(*drop)
    missing = [c for c in id_cols if c not in raw.columns]
    if missing:
        raise ValueError(f"id columns {missing} missing from {path}")
    wrong = [c for c in raw.columns if c not in id_cols and not _is_date(c)]
    if wrong:
        raise ValueError(f"columns {wrong} of {path} are neither ids nor dates")
    return raw


def long_series(wide: DataFrame, id_cols: Sequence[str], date_col: str = "month_end_date",
                value_col: str = "value") -> DataFrame:
    """Melt all non-id columns (NULLs kept) and parse the header text to a date."""
    long = melt(wide, id_cols, variable="__hdr", value=value_col)
    return long.select(*[F.col(f"`{c}`") for c in id_cols], header_to_date("__hdr").alias(date_col),
                       F.col(value_col))
