"""Text scalars used on region codes and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions._util import as_col, ColumnLike


def zero_pad_code(c: ColumnLike, width: int = 5) -> Column:
    """Left-pad a code with zeros to ``width``; longer text is kept whole (never truncated)."""
    s = as_col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def split_last_token(c: ColumnLike, sep: str = ", ") -> Column:
    """Text after the last separator ('Boston, MA' -> 'MA'); whole text when absent."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(-1))


def strip_literal(c: ColumnLike, literal: str) -> Column:
    """Remove every occurrence of a literal suffix/infix such as ' metro area'."""
    return F.replace(as_col(c), F.lit(literal), F.lit(""))


def duration_to_int(c: ColumnLike, unit: str = " weeks") -> Column:
    """'4 weeks' -> 4; malformed text -> NULL."""
    return strip_literal(c, unit).try_cast("int")
