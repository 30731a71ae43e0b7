"""Wide <-> long reshapes for month-per-column series."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
         variable: str = "variable", value: str = "value", value_type: str = "double") -> DataFrame:
    """Columns -> rows, NULL values kept (one output row per id row and value column).

    The value columns are cast to one common type first, as ``unpivot`` needs.
    The number of value columns is found from the schema at plan time, so a
    file with a new month column needs no code change.
    """
    id_set = {i.lower() for i in ids}
    values = list(values) if values is not None else [c for c in df.columns if c.lower() not in id_set]
    if not values:
        raise ValueError("no value columns to melt")
    typed = df.select(*[F.col(f"`{i}`") for i in ids],
                      *[F.col(f"`{v}`").try_cast(value_type).alias(v) for v in values])
    return typed.unpivot([F.col(f"`{i}`") for i in ids], [F.col(f"`{v}`") for v in values], variable, value)


def header_to_date(c: str | F.Column) -> F.Column:
    """Melted header text such as '2024-10-31' -> DATE; anything else -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string").try_cast("date")


def pivot_wide(df: DataFrame, ids: Sequence[str], pivot_col: str, agg: F.Column,
               pivot_values: Sequence | None = None) -> DataFrame:
    """Long -> wide (one column per pivot value). Without ``pivot_values`` Spark
    looks the distinct values up first (bounded by spark.sql.pivotMaxValues)."""
    g = df.groupBy(*ids)
    g = g.pivot(pivot_col, list(pivot_values)) if pivot_values is not None else g.pivot(pivot_col)
    return g.agg(agg)
