"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.numbering import place_in_group
from hearth.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
BUCKETS = 4096
ADDED = ("__size", "__source_size", "__target", "__times")


def word_count(text: str):
    """Words of a text between ASCII blanks; a null text has none."""
    return F.coalesce(F.size(F.filter(F.split(F.col(text), BLANKS), lambda w: w != "")), F.lit(0)).cast("long")


def seeded_hash(key: str, text: str, seed: str):
    """A 60-bit number that (seed, key, text) decides; a null counts as the empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, text)]
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), parts[0], F.lit("\x1f"), parts[1])), 1, 15), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, source_size) -> (source, place, source_size, target).

    Sources in code-point order (null last) get the weights, repeated in turn.
    Clamping every source above ``cap`` times its size and resharing the excess
    by weight until none is above ends where target = min(cap, level * weight)
    for one level; sources sorted by cap / weight give it in one pass of prefix
    sums. The window runs over one row per source, never over documents."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    s = sizes.select("source", "source_size", (F.row_number().over(by_name) - 1).alias("place"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (F.col("place") % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("ratio", F.col("limit") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").isNull(), "source")
    s = s.select("*", F.coalesce(F.sum("limit").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
                 .alias("filled"),
                 F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("left"),
                 F.sum("source_size").over(Window.partitionBy()).alias("total"))
    s = s.withColumn("level", (F.col("total") - F.col("filled")) / F.col("left"))
    free = F.col("ratio") > F.col("level")
    level = F.min_by(F.when(free, F.col("level")), F.when(free, F.col("ratio"))).over(Window.partitionBy())
    return s.select("source", "place", "source_size", F.least("limit", F.coalesce(level, F.lit(0.0)) * F.col("weight"))
                    .alias("target"))


def mixing_plan(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3) -> DataFrame:
    """(source, size, h) rows -> one row per source: target, whole epochs, and the
    hash below which a document is taken once more (``cutoff``).

    Documents in hash order join the fractional repetition while their middle is
    below the remainder. Documents of one hash (equal in key and text) are copies of
    equal rank: at the cut, ``copies`` of them follow the size ``before`` and share the
    size ``n``, and those whose own middle is below ``rest`` are taken. The cut is searched in two steps, hash buckets and then
    the one bucket that holds it, so no task sorts a whole source."""
    plan = water_fill(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("int"))
    plan = stage(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mixing_targets")

    def bucket():
        return F.floor(F.col("h") / F.lit((1 << 60) // BUCKETS)).cast("int")

    same = F.col("p.source").eqNullSafe(F.col("b.source"))
    sums = sized.groupBy("source", bucket().alias("bucket")).agg(F.sum("size").alias("n"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "bucket", "n", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"))
    cut = (sums.alias("b").join(plan.alias("p"), same)
           .where((F.col("rest") > 0) & (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest")))
           .select("b.source", "bucket", "before", "rest"))
    inside = (sized.withColumn("bucket", bucket()).alias("d")
              .join(cut.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.bucket") == F.col("c.bucket")))
              .groupBy("d.source", "before", "rest", "h").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("copies")))
    walk = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(walk), F.lit(0)))
    left_out = ~copy_taken(F.col("copies") - 1)  # the last copy, so not all are taken
    cutoff = inside.groupBy("source").agg(
        F.min(F.when(left_out, F.struct("h", "before", "n", "copies"))).alias("at"), (F.max("h") + 1).alias("past"))
    out = plan.alias("p").join(cutoff.alias("b"), same, "left").select(
        "p.source", "place", "source_size", "target", "whole", "rest",
        F.coalesce("at.h", "past", F.lit(0)).cast("long").alias("cutoff"), "at.before", "at.n",
        F.coalesce("at.copies", F.lit(0)).alias("copies"))
    return stage(out, "mixing_plan")


def copy_taken(number):
    """Whether copy ``number`` (from 0) of the documents at the cut has its middle below the remainder."""
    share = F.col("n").cast("double") / F.col("copies")
    return F.col("before") + (number.cast("double") + F.lit(0.5)) * share <= F.col("rest")


def _mix(docs: DataFrame, weights: Sequence[float], cap: float, seed: str, key: str, text: str, source: str) -> DataFrame:
    """(doc: all columns of ``docs``, size, source_size, target, times)."""
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(source).alias("source"),
                        word_count(text).alias("size"), seeded_hash(key, text, seed).alias("h"))
    narrow = stage(sized.select("source", "size", "h"), "mixing_sizes")
    plan = mixing_plan(narrow, weights, cap).withColumnRenamed("source", "named")
    both = sized.join(plan, F.col("source").eqNullSafe(F.col("named")))
    out = ["doc", "size", "source_size", "target"]
    once = F.when(F.col("h") < F.col("cutoff"), 1).otherwise(0)
    if plan.where("copies > 1").isEmpty():
        return both.select(*out, (F.col("whole") + once).alias("times"))
    # Copies of one document at a source's cut: numbered, however many they are, and split.
    tied = (F.col("h") == F.col("cutoff")) & (F.col("copies") > 1)
    ties = stage(both.where(tied).withColumn("row", F.monotonically_increasing_id()), "mixing_ties")
    numbers = place_in_group(ties.select("place", "row"), ["place"], ["row"], "number").select("row", "number")
    split = ties.join(numbers, "row").select(
        *out, (F.col("whole") + F.when(copy_taken(F.col("number")), 1).otherwise(0)).alias("times"))
    return both.where(~tied).select(*out, (F.col("whole") + once).alias("times")).unionByName(split)


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, seed: str = "mix",
                key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with __size, __source_size, __target and __times (copies the mix takes).

    Size is the words of the text (null: 0). A document's copies are its source's
    whole epochs, plus one when its seeded hash lies below the source's cut. (seed, key,
    text) alone decide, so reruns agree; rows equal in key and text have one rank, and
    where the cut falls among them as many are taken as the target asks for. Null sources
    form a source of their own, the last; all sizes 0 gives targets 0 and nothing taken;
    an empty table gives an empty result. Other columns of ``docs`` are kept whatever
    their names, but for the four that are added."""
    kept = [f"doc.`{c}`" for c in docs.columns if c not in ADDED]
    return _mix(docs, weights, cap, seed, key, text, source).select(
        *kept, F.col("size").alias("__size"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"), F.col("times").cast("int").alias("__times"))


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3, seed: str = "mix",
          key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every document repeated as often as the mix takes it, columns of ``docs``.

    Empty and null texts have size 0: they come with their source's whole epochs and add
    nothing to them. Repeated rows are rows of their own; see ``mix_sources``."""
    out = _mix(docs, weights, cap, seed, key, text, source).where("times > 0")
    return out.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("copy")).select("doc.*")
