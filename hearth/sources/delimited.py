"""Delimited landed files: never infer types, clean header names, then type."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.casting import conform
from hearth.session import stage
from hearth.sources.by_name import BOM_TEXT, _pattern, numbered, resolve_by_name

BOM = "﻿"


def clean_name(name: str) -> str:
    """Header cell -> column name: strip a UTF-8 byte-order mark and padding."""
    return name.replace(BOM, "").replace("ï»¿", "").strip()


def _first_rows(batches):
    """The first row of a split; the rest of it is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _same_headers(spark: SparkSession, path: str | Sequence[str], sep: str) -> bool:
    """Whether all files have the same header names. Only the head of each file is read: a
    session of its own deals every file out as a task, and a task stops at its first line."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    heads = (own.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
             .where("block = 0").select("value").mapInArrow(_first_rows, "value string"))
    names = F.transform(F.split("value", _pattern(sep)), lambda c: F.trim(F.regexp_replace(c, BOM_TEXT, "")))
    return len(heads.select(names.alias("n")).distinct().limit(2).collect()) < 2


def read_delimited_raw(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
                       header: bool = True, lower: bool = False, **options) -> DataFrame:
    """All columns as text, header names cleaned. Schema inference is off on
    purpose: an all-empty column must not become a number.

    Columns are taken by name. Where all headers agree the files are read as they are, in one
    lazy pass; else their lines are staged once and each value is found by its own file's
    header (``by_name``): a column that a file lacks is NULL. Folders like ``k=1/`` add the
    column k either way."""
    options = {"multiLine": False, **options}
    if header and not options["multiLine"] and not _same_headers(spark, path, sep):
        text = spark.read.text(path)
        keep = [c for c in text.columns if c != "value"]
        own = {k: str(v) for k, v in options.items() if k != "multiLine"}
        return resolve_by_name(stage(numbered(text, keep), "landed_lines"), None, sep, lower, keep, own)
    reader = spark.read.option("header", header).option("sep", sep).option("inferSchema", False).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.csv(path)
    names = [clean_name(c) for c in raw.columns]
    if lower:
        names = [n.lower() for n in names]
    return raw.toDF(*names)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: Sequence[tuple[str, str]] | None = None,
                   sep: str = ",", header: bool = True, **options) -> DataFrame:
    """Read as text then ``try_cast`` to the declared (column, type) list, in that order."""
    raw = read_delimited_raw(spark, path, sep=sep, header=header, **options)
    return conform(raw, list(schema)) if schema else raw
