"""Gzip TSV files with junk lines above the header.

The header of each file is the first line that contains every header token
(e.g. both period column names). Each file is handled independently and in
parallel: line order inside a file comes from the split start plus the
monotonically increasing row id within the split (gzip files are never split).
One small table (one row per file) holds the header position of every file;
it is staged in the shared folder and never collected. The numbered lines
themselves are staged first: header positions and body are read from that
table, so no row id is computed twice and the result does not depend on how
files are packed into splits. A file landing mid-run is not part of this read.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.casting import conform
from hearth.sources.delimited import clean_name


class MissingHeader(ValueError):
    pass


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.option("recursiveFileLookup", "true").text(paths)
            .select(F.col("value").alias("line"),
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos")))


# Largest per-file header table broadcast to the body scan; beyond it, a shuffle join.
MAX_BROADCAST_FILES = 100_000


def read_preamble_tsv(spark: SparkSession, path: str | Sequence[str], header_tokens: Sequence[str],
                      schema: Sequence[tuple[str, str]] | None = None, sep: str = "\t") -> DataFrame:
    """Parse every file below its own header line; raise when a file has none.

    The per-file header positions stay a (staged) DataFrame: only the distinct
    header text (at most two rows) and at most five header-less file names
    ever reach the driver, however many files have landed."""
    from hearth.operators.joins import fits
    from hearth.session import stage

    lines = stage(_lines(spark, path), "preamble_lines")
    is_header = F.lit(True)
    for tok in header_tokens:
        is_header = is_header & F.col("line").contains(tok)
    heads = stage(lines.where(is_header).groupBy("file")
                  .agg(F.min(F.struct("block", "pos", "line")).alias("h"))
                  .select("file", F.col("h.block").alias("hb"), F.col("h.pos").alias("hp"),
                          F.col("h.line").alias("ht")), "preamble_heads")
    paths = [path] if isinstance(path, str) else list(path)
    # The listing, without content: an empty file has no lines but must not pass unseen.
    landed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
              .select(F.col("_metadata.file_path").alias("file")))
    missing = landed.join(heads, "file", "left_anti").limit(5).collect()
    if missing:
        raise MissingHeader(f"no header line with {list(header_tokens)} in {[r['file'] for r in missing]}")
    texts = [r["ht"] for r in heads.select("ht").distinct().limit(2).collect()]
    if len(texts) != 1:
        raise ValueError(f"files disagree on the header line: {texts}")
    names = [clean_name(n) for n in texts[0].split(sep)]
    ddl = ", ".join(f"`{n}` string" for n in names)
    positions = heads.select("file", "hb", "hp")
    positions = F.broadcast(positions) if fits(positions, MAX_BROADCAST_FILES) else positions
    body = (lines.join(positions, "file")
            .where((F.col("block") > F.col("hb")) | ((F.col("block") == F.col("hb")) & (F.col("pos") > F.col("hp"))))
            .where(F.length("line") > 0))
    parsed = body.select(F.from_csv(F.col("line"), ddl, {"sep": sep}).alias("r")).select("r.*")
    return conform(parsed, list(schema)) if schema else parsed
