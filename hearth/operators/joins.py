"""Lookup joins and surrogate keys."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest lookup we broadcast by hint; anything bigger takes the shuffle join
# (AQE may still turn it into a broadcast from runtime sizes).
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops reading after max_rows + 1."""
    return df.limit(max_rows + 1).count() <= max_rows


def row_bytes(df: DataFrame):
    """About how many bytes a row takes in a broadcast: fixed columns 8 each, texts and
    binaries their length, nested values their JSON text."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + 8
    return total


def bounded(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True when ``df`` has at most so many rows and bytes; stops reading after max_rows + 1 rows."""
    got = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return got["n"] <= max_rows and got["b"] <= max_bytes


def lookup_left_join(fact: DataFrame, lookup: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                     drop: Sequence[str] = (), max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                     max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """fact LEFT JOIN lookup on differently named keys; unmatched keys get NULL.

    The lookup is broadcast only after its rows and bytes are checked; the right
    keys and ``drop`` columns are removed after the join, fact columns are kept."""
    if len(left_on) != len(right_on):
        raise ValueError("left_on and right_on differ in length")
    right = F.broadcast(lookup) if bounded(lookup, max_broadcast_rows, max_broadcast_bytes) else lookup
    cond = None
    for lk, rk in zip(left_on, right_on):
        term = fact[lk] == right[rk]
        cond = term if cond is None else cond & term
    joined = fact.join(right, cond, "left")
    gone = {c.lower() for c in list(right_on) + list(drop)} | {c.lower() for c in fact.columns}
    keep = [fact[c] for c in fact.columns] + [right[c] for c in lookup.columns if c.lower() not in gone]
    return joined.select(*keep)


def surrogate_key(df: DataFrame, label: str, key: str = "lookup_key", start: int = 0,
                  partitions: int | None = None) -> DataFrame:
    """Number the distinct labels start, start+1, ... in label order, distributed.

    Range-partition the distinct labels and sort inside each range; a row's
    key is its position in its range plus the sizes of all earlier ranges
    (a table with one row per range). The numbered labels are staged as a
    table in the shared folder, so a lost executor cannot renumber them.
    """
    spark = df.sparkSession
    from hearth.session import stage
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    labels = df.select(F.col(f"`{label}`")).where(F.col(f"`{label}`").isNotNull()).distinct()
    ranged = labels.repartitionByRange(n, F.col(f"`{label}`")).sortWithinPartitions(F.col(f"`{label}`"))
    numbered = ranged.select(F.col(f"`{label}`"), F.spark_partition_id().alias("__pid"),
                             F.monotonically_increasing_id().alias("__mid"))
    numbered = stage(numbered, "surrogate_key")
    pos = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    sizes = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window
    offsets = sizes.select("__pid", (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("__off"))
    # One row per range partition: a proven bound for the broadcast.
    return (numbered.join(F.broadcast(offsets), "__pid")
            .select(F.col(f"`{label}`"), (F.coalesce(F.col("__off"), F.lit(0)) + pos + F.lit(start))
                    .cast("long").alias(key)))


def extend_keys(df: DataFrame, label: str, stored: DataFrame | None, key: str = "lookup_key", start: int = 0) -> DataFrame:
    """The labels of ``df`` that ``stored`` (label, key) does not know, numbered on from its
    largest key in label order. Keys given before never change, so facts loaded with them
    stay right: append these rows to the stored lookup.

    New labels are found by an anti-join and numbered in ranges (``surrogate_key``); a NULL
    label gets no key."""
    if stored is None:
        return surrogate_key(df, label, key, start)
    new = df.select(F.col(f"`{label}`")).where(F.col(f"`{label}`").isNotNull()).distinct()
    new = new.join(stored.select(F.col(f"`{label}`")), label, "left_anti")
    top = stored.agg(F.max(F.col(f"`{key}`"))).first()[0]
    return surrogate_key(new, label, key, start if top is None else int(top) + 1)


def load_keys(df: DataFrame, label: str, path: str, key: str = "lookup_key") -> DataFrame:
    """The stored lookup at ``path`` after the labels of ``df`` are in it, old keys unchanged.

    A load that is run again finds its labels known and appends nothing. One writer at a time."""
    from hearth.sinks.tables import read_table, write_append
    spark = df.sparkSession
    new = extend_keys(df, label, read_table(spark, path), key)
    # The new labels are staged by surrogate_key, not read from the table they are appended to.
    write_append(new, path)
    return read_table(spark, path)
