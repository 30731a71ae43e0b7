"""Target layout: drop, rename, order; constant tag columns."""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_layout(df: DataFrame, target: Sequence[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Rename then select exactly ``target`` in order (unlisted columns are dropped)."""
    rename = {k.lower(): v for k, v in (rename or {}).items()}
    by_new = {}
    for c in df.columns:
        by_new[rename.get(c.lower(), c).lower()] = c
    out = []
    for name in target:
        src = by_new.get(name.lower())
        if src is None:
            raise ValueError(f"target column {name!r} not produced; have {df.columns}")
        out.append(F.col(f"`{src}`").alias(name))
    return df.select(*out)


def with_tags(df: DataFrame, tags: dict[str, Any]) -> DataFrame:
    """Constant columns (series label, dataset type, pull date, load stamp) in one projection.
    Values are parameters of the run, never the wall clock, so reruns reproduce."""
    return df.select("*", *[(v if isinstance(v, F.Column) else F.lit(v)).alias(k) for k, v in tags.items()])
