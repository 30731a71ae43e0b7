"""Operators bound to the benchmark tables.

Each binding is ``fn(spark, sf_dir) -> DataFrame`` plus, where the operator is
expressible in SQL, the DuckDB SQL that computes the same relation. Column
names match between the two; the checker compares them order-insensitively.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Binding:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Binding] = {}


def binding(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate binding {name}")
        REGISTRY[name] = Binding(name, fn, sql)
        return fn
    return deco


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The benchmark table as a lazy DataFrame, resolved once per session (file
    listing and footer schema), as a catalog table would be. Every action
    still scans the data."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    hit = _TABLES.get(key)
    # The entry holds its session, so an id is never reused while cached; a
    # stopped or different session gets a fresh read.
    if hit is None or hit[0] is not spark or spark.sparkContext._jsc is None:
        hit = _TABLES[key] = (spark, spark.read.parquet(path))
    return hit[1]


def load_all() -> dict[str, Binding]:
    # Import for the registration side effect.
    from hearth.bindings import (  # noqa: F401
        metrics, hygiene, typing_text, reshape, relational, sinks, quality, families, accounting, warehouse,
    )
    return REGISTRY
