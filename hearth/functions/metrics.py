"""Derived metrics: recover prior-period levels from published changes.

A published file gives the current level ``x`` and a change ``g`` against an
earlier period (last month, last year, or the national figure). The change is
either a ratio (``x = prior * (1 + g)``), a difference in points
(``x = prior + g``) or, for a few columns in the source data, a difference with
the opposite sign (``x = prior - g``). Division by zero yields NULL (ANSI-safe
``try_divide``); the hygiene layer later turns NULL into the load default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions._util import as_col, ColumnLike


def prior_from_ratio(x: ColumnLike, g: ColumnLike) -> Column:
    """Prior level when ``g`` is a relative change: x / (1 + g)."""
    return F.try_divide(as_col(x), F.lit(1) + as_col(g))


def prior_from_difference(x: ColumnLike, g: ColumnLike) -> Column:
    """Prior level when ``g`` is an absolute change: x - g."""
    return as_col(x) - as_col(g)


def prior_from_sum(x: ColumnLike, g: ColumnLike) -> Column:
    """Prior level for columns whose change is published with the opposite sign: x + g."""
    return as_col(x) + as_col(g)


def prior_from_ratio_guarded(x: ColumnLike, g: ColumnLike) -> Column:
    """x / (1 + g), but 0 when the change is exactly -100 %."""
    g = as_col(g)
    return F.when(g == -1, F.lit(0.0)).otherwise(prior_from_ratio(x, g))


def total_from_share(part: ColumnLike, share: ColumnLike) -> Column:
    """Whole from a part and its share of the whole; 0 when the share is 0."""
    share = as_col(share)
    return F.when(share == 0, F.lit(0.0)).otherwise(F.try_divide(as_col(part), share))


def complement(total: ColumnLike, part: ColumnLike) -> Column:
    """total - part (negative when the total was defaulted to 0)."""
    return as_col(total) - as_col(part)


def count_from_rate(rate: ColumnLike, volume: ColumnLike, digits: int = 0) -> Column:
    """A count implied by a rate of a volume, rounded half-up."""
    return F.round(as_col(rate) * as_col(volume), digits)


def guarded_ratio(numerator: ColumnLike, denominator: ColumnLike, digits: int = 0) -> Column:
    """numerator / denominator rounded half-up; 0 when the denominator is 0."""
    d = as_col(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(as_col(numerator), d), digits))


PRIOR_RULES = {
    "ratio": prior_from_ratio,
    "diff": prior_from_difference,
    "sum": prior_from_sum,
    "ratio_guarded": prior_from_ratio_guarded,
}


# The same rules as SQL expression text, for wide generated projections that are
# built with one ``selectExpr`` call instead of thousands of Column objects.
PRIOR_RULES_SQL = {
    "ratio": "try_divide({x}, 1 + {g})",
    "diff": "{x} - {g}",
    "sum": "{x} + {g}",
    "ratio_guarded": "CASE WHEN {g} = -1 THEN 0D ELSE try_divide({x}, 1 + {g}) END",
}


def prior_level_sql(kind: str, x: str, g: str) -> str:
    """SQL text of ``prior_level`` for quoted column names ``x`` and ``g``."""
    try:
        return PRIOR_RULES_SQL[kind].format(x=x, g=g)
    except KeyError:
        raise ValueError(f"unknown change kind {kind!r}; expected one of {sorted(PRIOR_RULES_SQL)}") from None


def prior_level(kind: str, x: ColumnLike, g: ColumnLike) -> Column:
    try:
        rule = PRIOR_RULES[kind]
    except KeyError:
        raise ValueError(f"unknown change kind {kind!r}; expected one of {sorted(PRIOR_RULES)}") from None
    return rule(x, g)
