"""Null and non-finite hygiene applied before a load.

Two conventions exist in the source data: fill NULL with 0 for numbers and ''
for text, or fill text with the marker 'NA'. Both are column expressions, so a
whole table is cleaned in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions._util import as_col, q, ColumnLike

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def finite_or_zero(c: ColumnLike) -> Column:
    """+inf, -inf and NaN become 0; NULL stays NULL."""
    c = as_col(c)
    bad = F.isnan(c) | (c == F.lit(float("inf"))) | (c == F.lit(float("-inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def text_default(c: ColumnLike, default: str = "NA", trim: bool = True) -> Column:
    """Cast to text, optionally trim, and replace NULL with a marker."""
    s = as_col(c).cast("string")
    if trim:
        s = F.trim(s)
    return F.coalesce(s, F.lit(default))


def us_abbrev(c: ColumnLike, default: str = "NA") -> Column:
    """NULL -> marker, then the literal 'U.S.' -> 'US' (not trimmed)."""
    return F.replace(F.coalesce(as_col(c).cast("string"), F.lit(default)), F.lit("U.S."), F.lit("US"))


def abs_int_default(c: ColumnLike, default: int = 0) -> Column:
    """|int(c)| with failed casts and NULL -> default."""
    return F.coalesce(F.abs(as_col(c).try_cast("int")), F.lit(default))


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def nonfinite_to_zero(df: DataFrame) -> DataFrame:
    """Every floating column: +-inf and NaN -> 0, found from the schema, one projection
    (built as SQL text: one call however wide the table is)."""
    exprs = []
    for f in df.schema.fields:
        c = q(f.name)
        if isinstance(f.dataType, FRACTIONAL_TYPES):
            t = f.dataType.simpleString()
            exprs.append(f"CASE WHEN isnan({c}) OR abs({c}) = CAST('Infinity' AS {t}) THEN CAST(0 AS {t}) "
                         f"ELSE {c} END AS {c}")
        else:
            exprs.append(c)
    return df.selectExpr(*exprs)


def nonfinite_to_null(df: DataFrame) -> DataFrame:
    """Every floating column: +-inf and NaN -> NULL, for loads that keep missing values missing."""
    exprs = []
    for f in df.schema.fields:
        c = q(f.name)
        if isinstance(f.dataType, FRACTIONAL_TYPES):
            t = f.dataType.simpleString()
            exprs.append(f"CASE WHEN NOT isnan({c}) AND abs({c}) < CAST('Infinity' AS {t}) THEN {c} END AS {c}")
        else:
            exprs.append(c)
    return df.selectExpr(*exprs)


def fill_defaults(df: DataFrame, numeric: list[str] | None = None, text: list[str] | None = None,
                  rest: bool = True, numeric_value=0, text_value: str = "") -> DataFrame:
    """Listed numeric columns NULL -> 0, listed text NULL -> ''; with ``rest`` every other
    numeric column -> 0 and text column -> '' as well. One projection, no loops of withColumn."""
    numeric = set(numeric or [])
    text = set(text or [])
    text_lit = "'" + text_value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    exprs = []
    for f in df.schema.fields:
        c = q(f.name)
        if _is_numeric(f.dataType) and (f.name in numeric or rest):
            exprs.append(f"coalesce({c}, CAST({numeric_value!r} AS {f.dataType.simpleString()})) AS {c}")
        elif isinstance(f.dataType, T.StringType) and (f.name in text or rest):
            exprs.append(f"coalesce({c}, {text_lit}) AS {c}")
        else:
            exprs.append(c)
    return df.selectExpr(*exprs)
