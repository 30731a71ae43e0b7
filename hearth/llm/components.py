"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hearth.session import scratch_path


def _written(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """``df`` written to the shared folder, and a fingerprint of its rows."""
    spark, seen, path = df.sparkSession, Observation(), scratch_path(df.sparkSession, name)
    h = F.xxhash64("u", "v")
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
               F.sum(F.shiftright(h, 20)).alias("s")).write.parquet(path)
    return spark.read.parquet(path), tuple(seen.get[k] for k in ("n", "x", "s"))


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node with a link to another; root is the smallest node.

    Each round hangs a node's larger neighbours, then its smaller ones, on the
    smallest node it knows. Only minima are aggregated, so a node with very many
    links needs no task that holds them all. Rounds grow with the logarithm of the
    node count; each is written to the shared folder, which cuts the lineage."""
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    now, mark = _written(now, "links")
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        after, new = _written(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        if new == mark:
            break
        now, mark = after, new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
