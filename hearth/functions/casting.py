"""Rounding and typing to a declared target layout.

Two rounding modes appear in the source pipelines: half-even (the pandas/numpy
family) and half-up (the SQL family). ``bround`` and ``round`` are the Spark
built-ins for them. Casts never abort a load: ``try_cast`` returns NULL and the
quality layer quarantines the row instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions._util import as_col, q, ColumnLike


def round_half_even(c: ColumnLike, digits: int = 0) -> Column:
    return F.bround(as_col(c), digits)


def round_half_up(c: ColumnLike, digits: int = 0) -> Column:
    return F.round(as_col(c), digits)


ROUNDERS = {"half_even": round_half_even, "half_up": round_half_up}


def rounded(c: ColumnLike, digits: int | None, mode: str = "half_even") -> Column:
    if digits is None:
        return as_col(c)
    return ROUNDERS[mode](c, digits)


def to_int(c: ColumnLike) -> Column:
    """Truncating cast to int; overflow or bad text -> NULL."""
    return as_col(c).try_cast("int")


def to_decimal(c: ColumnLike, precision: int = 12, scale: int = 4) -> Column:
    """Fixed-point storage type used for scores (half-up at the scale)."""
    return as_col(c).try_cast(f"decimal({precision},{scale})")


def conform(df: DataFrame, target: list[tuple[str, str]], missing: str = "error") -> DataFrame:
    """Select the target columns in order, each try_cast to its declared type.

    ``target`` is a list of (column, spark SQL type). A missing column is an
    error by default; with ``missing='null'`` it is added as a typed NULL.
    """
    present = {f.name.lower(): f.name for f in df.schema.fields}
    exprs = []
    for name, dtype in target:
        src = present.get(name.lower())
        if src is None:
            if missing != "null":
                raise ValueError(f"column {name!r} is not in the frame; have {sorted(present.values())}")
            exprs.append(f"CAST(NULL AS {dtype}) AS {q(name)}")
        else:
            exprs.append(f"try_cast({q(src)} AS {dtype}) AS {q(name)}")
    return df.selectExpr(*exprs)
