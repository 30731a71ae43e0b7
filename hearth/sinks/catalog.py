"""Tables of a catalog with a declared layout.

A declared layout is a list of (column, SQL type); VARCHAR(n) is kept in the table's
definition, and Spark refuses longer texts when rows are written. A full replacement is
written to a folder of its own and swapped in by one change of the table's location, so
readers see the old table or the new one, and a job that dies leaves the old.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from hearth.functions._util import q
from hearth.functions.casting import conform
from hearth.quality.checks import require_conformance


def declared_ddl(columns: Sequence[tuple[str, str]]) -> str:
    return ", ".join(f"{q(c)} {t.upper()}" for c, t in columns)


def create_declared(spark: SparkSession, name: str, columns: Sequence[tuple[str, str]], location: str) -> None:
    """CREATE TABLE with the declared layout; fails when the table exists."""
    spark.sql(f"CREATE TABLE {name} ({declared_ddl(columns)}) USING parquet LOCATION '{_fresh(location)}'")


def drop_declared(spark: SparkSession, name: str) -> bool:
    """Drop the table's definition. True when there was one."""
    if not spark.catalog.tableExists(name):
        return False
    spark.sql(f"DROP TABLE {name}")
    return True


def _fresh(location: str) -> str:
    return f"{location.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def _typed(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """The declared columns in order, text lengths checked by name before a row is written."""
    plain = [(c, "string" if "char" in t.lower() else t) for c, t in columns]
    return require_conformance(conform(df, plain), columns)


def insert_declared(df: DataFrame, name: str, columns: Sequence[tuple[str, str]]) -> None:
    """Append rows, typed to the declared layout."""
    _typed(df, columns).write.insertInto(name)


def replace_declared(spark: SparkSession, df: DataFrame, name: str, columns: Sequence[tuple[str, str]], location: str) -> None:
    """Create the table, or replace its rows: written beside, then swapped in by the location."""
    typed = _typed(df, columns)
    if not spark.catalog.tableExists(name):
        create_declared(spark, name, columns, location)
    have = [f.name.lower() for f in spark.table(name).schema.fields]
    if have != [c.lower() for c, _ in columns]:
        raise ValueError(f"{name} has the columns {have}, not those declared")
    new = _fresh(location)
    typed.write.parquet(new)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.sql(f"REFRESH TABLE {name}")
