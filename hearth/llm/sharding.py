"""Sharding by jump consistent hashing (native column expressions).

A 64-bit key drives a linear congruential generator; the shard is the last
"jump" below the shard count. No ring table exists, and going from n to n+1
shards moves only the rows that land in the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.numbering import place_in_group
from hearth.session import stage

# Fixed values of the published algorithm: the generator's multiplier, and the
# width of the three limbs the 64-bit state is kept in (22 + 22 + 20 bits), so
# that no product of limbs leaves a signed long (ANSI mode raises on overflow).
MULTIPLIER = 2862933555777941757
LIMB, MASK, TOP_MASK = 22, (1 << 22) - 1, (1 << 20) - 1
M0, M1, M2 = MULTIPLIER & MASK, (MULTIPLIER >> LIMB) & MASK, MULTIPLIER >> (2 * LIMB)


def jump_pair(key: Column, shards: int) -> Column:
    """struct(shard, grown): the shard of ``key`` among ``shards`` and among ``shards + 1``.

    One walk gives both, as the jumps for n are a prefix of those for n + 1.
    Negative keys are taken as their unsigned 64-bit pattern; a null key is key 0."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    k = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        k.bitwiseAND(F.lit(MASK)).alias("k0"),
        F.shiftrightunsigned(k, LIMB).bitwiseAND(F.lit(MASK)).alias("k1"),
        F.shiftrightunsigned(k, 2 * LIMB).alias("k2"),
        F.lit(0).cast("long").alias("j"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def step(s: Column, _: Column) -> Column:
        p0 = s.k0 * F.lit(M0) + F.lit(1)
        p1 = s.k0 * F.lit(M1) + s.k1 * F.lit(M0) + F.shiftright(p0, LIMB)
        p2 = s.k0 * F.lit(M2) + s.k1 * F.lit(M1) + s.k2 * F.lit(M0) + F.shiftright(p1, LIMB)
        k1, k2 = p1.bitwiseAND(F.lit(MASK)), p2.bitwiseAND(F.lit(TOP_MASK))
        top = F.shiftleft(k2, 11) + F.shiftright(k1, 11)  # the state's upper 31 bits
        jump = (s.j + 1).cast("double") * (F.lit(2147483648.0) / (top + 1).cast("double"))
        moved = F.struct(p0.bitwiseAND(F.lit(MASK)).alias("k0"), k1.alias("k1"), k2.alias("k2"),
                         F.floor(jump).cast("long").alias("j"),
                         F.when(s.j < shards, s.j).otherwise(s.shard).alias("shard"), s.j.alias("grown"))
        return F.when(s.j <= shards, moved).otherwise(s)

    rounds = F.sequence(F.lit(0), F.lit(shards))  # a walk below n + 1 has at most n + 1 jumps
    return F.aggregate(rounds, start, step, lambda s: F.struct(s.shard.cast("int").alias("shard"),
                                                               s.grown.cast("int").alias("grown")))


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text",
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard and ``carry`` columns.

    ``size`` is the text's UTF-8 bytes plus 8 (a null text has no bytes and the
    checksum of no bytes); ``slot`` numbers a shard's rows from 0 without gaps in
    key order. Repeated rows stay separate rows of one shard. An empty table
    gives an empty result; other columns of ``docs`` are ignored.

    Slots are numbered on narrow rows (``numbering``): the ``carry`` columns are written
    once beside a row number, stay out of every sort, and meet their slot by that number."""
    raw = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    base = docs.select(F.col(key), *[F.col(c) for c in carry], (F.octet_length(raw) + 8).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), jump_pair(F.col(key), shards).alias("__jump"))
    base = base.select(key, *carry, "size", "text_crc32", F.col("__jump.shard").alias("shard"),
                       F.col("__jump.grown").alias("grown_shard"), F.monotonically_increasing_id().alias("__tie"))
    columns = [key, *carry, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"]
    if not carry:
        return place_in_group(base, ["shard"], [key, "text_crc32", "__tie"], "slot").select(*columns)
    whole = stage(base, "shard_rows")
    narrow = whole.select("__tie", "shard", key, "text_crc32")
    slots = place_in_group(narrow, ["shard"], [key, "text_crc32", "__tie"], "slot").select("__tie", "slot")
    # The slots are the small side: hashed, so that the texts are dealt once and never sorted.
    return whole.join(slots.hint("shuffle_hash"), "__tie").select(*columns)
