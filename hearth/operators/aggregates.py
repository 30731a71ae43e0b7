"""Counts, maxima, distinct dimensions, QA reports, ordered previews."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_period_frame(df: DataFrame, column: str, alias: str = "max_period") -> DataFrame:
    return df.agg(F.max(F.col(f"`{column}`")).alias(alias))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def duplicate_key_report(df: DataFrame, keys: Sequence[str], alias: str = "count_rows",
                         only_duplicates: bool = False) -> DataFrame:
    """Rows per key, most frequent first (uniqueness QA). Partial aggregation
    before the shuffle keeps a hot key cheap."""
    rep = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(alias))
    if only_duplicates:
        rep = rep.where(F.col(alias) > 1)
    return rep.orderBy(F.col(alias).desc(), *[F.col(f"`{k}`") for k in keys])


def distinct_dimension(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns]).distinct()


def loaded_periods(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(f"`{column}`")).distinct().orderBy(F.col(f"`{column}`"))


def top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """Ordered preview; ``order`` must be a total order for a deterministic result."""
    return df.orderBy(*order).limit(n)
