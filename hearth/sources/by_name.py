"""Delimited lines resolved by each file's own header.

Files of one landing folder may order their columns differently or lack some. Lines keep
their file and place; the first line of a file is its header, and every value is found by
the place its column's name has there. The header table (one row per file) stays
distributed, so the plan is the same for two files and for a million.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.session import stage

BOM_TEXT = "﻿|ï»¿"
# Header tables of at most so many files are broadcast to the lines; beyond it, a shuffle join.
MAX_BROADCAST_FILES = 100_000


def line_columns() -> list[Column]:
    """A text row's line, with the file it stands in, when that landed, and where its split begins."""
    return [F.col("value").alias("__line"), F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__block"), F.col("_metadata.file_modification_time").alias("__landed")]


def numbered(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text rows (``value``) with file, block and place; ``keep`` columns stay. Places only order
    the lines of one split, so they are the same for every layout of splits."""
    return lines.select(*[F.col(f"`{c}`") for c in keep], *line_columns(), F.monotonically_increasing_id().alias("__pos"))


def _cells(line: Column, width: int, options: dict) -> Column:
    """A line's cells as an array of ``width`` texts, NULL where it has fewer."""
    row = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)), options)
    return F.array(*[row[f"c{i}"] for i in range(width)])


def clean_names(cells: Column) -> Column:
    """Header cells without byte-order marks and padding."""
    return F.transform(cells, lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), BOM_TEXT, "")))


def resolve_by_name(lines: DataFrame, columns: Sequence[str] | None = None, sep: str = ",", lower: bool = False,
                    keep: Sequence[str] = (), options: dict | None = None) -> DataFrame:
    """``numbered`` lines -> one text column for each name (default: every name some header has,
    in order of name), NULL where a file has no such column, then the ``keep`` columns.

    ``lines`` should be staged: places are read twice and must not change. A file's header is
    its first line; later lines without content are left out. Values may not hold line ends."""
    options = {"sep": sep, "mode": "PERMISSIVE", **(options or {})}
    first = lines.groupBy("__file").agg(F.min(F.struct("__block", "__pos", "__line")).alias("h"))
    heads = stage(first.select("__file", F.col("h.__block").alias("__hb"), F.col("h.__pos").alias("__hp"),
                               F.col("h.__line").alias("__head")), "file_headers")
    # A header has at most one column more than it has separators.
    width = heads.agg(F.max(F.size(F.split("__head", _pattern(sep))))).first()[0] or 1
    names = clean_names(_cells(F.col("__head"), width, options))
    heads = heads.select("__file", "__hb", "__hp", (F.transform(names, F.lower) if lower else names).alias("__names"))
    if columns is None:
        # Distinct names over all files: a few hundred however many files there are.
        got = heads.select(F.explode("__names").alias("n")).where("n <> ''").distinct().orderBy("n").collect()
        columns = [r["n"] for r in got]
    at = F.array(*[F.array_position("__names", F.lit(c)).cast("int") for c in columns])
    heads = heads.select("__file", "__hb", "__hp", at.alias("__at"))
    from hearth.operators.joins import fits
    heads = F.broadcast(heads) if fits(heads, MAX_BROADCAST_FILES) else heads
    body = lines.join(heads, "__file").where(((F.col("__block") != F.col("__hb")) | (F.col("__pos") != F.col("__hp")))
                                             & (F.length(F.trim(F.col("__line"))) > 0))
    cells = body.select(*[F.col(f"`{c}`") for c in keep], "__at", _cells(F.col("__line"), width, options).alias("__cells"))
    values = [F.when(F.col("__at")[i] > 0, F.try_element_at("__cells", F.col("__at")[i])).alias(c) for i, c in enumerate(columns)]
    return cells.select(*values, *[F.col(f"`{c}`") for c in keep])


def _pattern(sep: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in sep)
