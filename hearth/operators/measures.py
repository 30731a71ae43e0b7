"""Declare measures once; derive every prior-period column in one projection.

A family lists its measures, e.g. ``measure('median_sale_price')`` (ratio
change, suffixes _mom/_yoy -> _lm/_ly) or ``measure('median_dom', 'sum')``.
``with_prior_levels`` turns the whole list into a single ``select`` (never a
loop of ``withColumn``; wide tables have 40+ derived columns).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import DataFrame

from hearth.functions._util import q
from hearth.functions.metrics import prior_level_sql

# The change-column suffixes used by the two source conventions.
MONTH_YEAR_MM = (("_mm", "_lm"), ("_yy", "_ly"))
MONTH_YEAR_MOM = (("_mom", "_lm"), ("_yoy", "_ly"))


@dataclass(frozen=True)
class Derived:
    """target = rule(level, change)."""
    target: str
    level: str
    change: str
    kind: str = "ratio"


def measure(name: str, kind: str = "ratio", changes: Sequence[tuple[str, str]] = MONTH_YEAR_MM,
            kinds: dict[str, str] | None = None) -> list[Derived]:
    """Derivations for one measure; ``kinds`` overrides the rule per target suffix."""
    kinds = kinds or {}
    return [Derived(f"{name}{out}", name, f"{name}{src}", kinds.get(out, kind)) for src, out in changes]


def measures(names: Iterable[str], kind: str = "ratio",
             changes: Sequence[tuple[str, str]] = MONTH_YEAR_MM) -> list[Derived]:
    out: list[Derived] = []
    for n in names:
        out.extend(measure(n, kind, changes))
    return out


def with_prior_levels(df: DataFrame, derived: Sequence[Derived], drop_changes: bool = True,
                      drop: Sequence[str] = ()) -> DataFrame:
    """Append each derived column; optionally drop the change inputs. One projection."""
    dropped = {d.change.lower() for d in derived} if drop_changes else set()
    dropped |= {c.lower() for c in drop}
    keep = [q(c) for c in df.columns if c.lower() not in dropped]
    new = [f"{prior_level_sql(d.kind, q(d.level), q(d.change))} AS {q(d.target)}" for d in derived]
    return df.selectExpr(*keep, *new)


def round_columns(df: DataFrame, digits: dict[str, int | None], mode: str = "half_even") -> DataFrame:
    """Round the listed columns in place (others pass through). One projection."""
    lower = {k.lower(): v for k, v in digits.items()}
    fn = {"half_even": "bround", "half_up": "round"}[mode]
    exprs = []
    for c in df.columns:
        d = lower.get(c.lower())
        exprs.append(f"{fn}({q(c)}, {d}) AS {q(c)}" if d is not None else q(c))
    return df.selectExpr(*exprs)
