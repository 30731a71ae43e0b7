"""Fill-down: carry the last non-null value forward in file (or key) order.

Most keys are small, and a window over the key fills them. A plain window would send a
hot key (a third of all rows), or a file without keys, to one task; so the rows of each key
are counted first (key and order columns only), and a key of more than ``max_rows`` rows is
cut into buckets of its own order range:

1. last non-null value of each (hot key, bucket), by ``max_by`` with partial aggregation;
   the same fill across a key's buckets, shifted by one, gives every bucket's carry. This
   table has one row for each ``max_rows`` rows of hot keys and is staged; without a hot
   key there is none.
2. one pass over the data: shuffled once on (key, bucket), filled by the window inside, and
   a bucket's leading NULLs take its carry.

The result equals the window over the whole key, whatever the skew.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.joins import fits
from hearth.session import stage

MAX_ROWS = 1 << 16      # rows of a key that one window takes as they are
WHOLE_SHARE = 8         # a file without keys is cut this much finer: its buckets are all its tasks
MAX_HOT_KEYS = 100_000  # broadcast to the data; beyond it, a shuffle join


def _order_key(df: DataFrame, order_col: str) -> F.Column:
    """A monotonic integer view of the order column (dates and timestamps map
    to epoch days / microseconds), used only to form buckets."""
    c = F.col(f"`{order_col}`")
    dtype = df.schema[order_col].dataType
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c


def _default_for(dtype: T.DataType):
    """A non-null stand-in of the key's own type (paired with an is-null flag)."""
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    return None


def _keyed(df: DataFrame, order_col: str, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with non-nullable grouping columns (a typed stand-in for NULL and an is-null flag
    for each key: a NULL key stays its own group, and joins on them are plain equi-joins) and
    the integer order key."""
    grp = []
    for i, k in enumerate(keys):
        kc = F.col(f"`{k}`")
        d = _default_for(df.schema[k].dataType)
        if d is None:
            kc, d = kc.cast("string"), F.lit("")
        grp += [F.coalesce(kc, d).alias(f"__g{i}"), F.isnull(F.col(f"`{k}`")).alias(f"__n{i}")]
    names = [f"__g{i}" for i in range(len(keys))] + [f"__n{i}" for i in range(len(keys))]
    return df.select("*", *grp, _order_key(df, order_col).alias("__o")), names


def _bucketed(base: DataFrame, names: list[str], max_rows: int) -> tuple[DataFrame, bool]:
    """``base`` with __gb, the bucket (-1: rows without a place, which come first), and whether
    any key is cut. Keys of at most ``max_rows`` rows are one bucket."""
    def bucket(lo, width):
        return F.coalesce(F.floor((F.col("__o") - lo) / width), F.lit(-1)).cast("long")
    max_rows = max_rows if names else max(1, max_rows // WHOLE_SHARE)
    counted = base.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows"), F.min("__o").alias("__lo"), F.max("__o").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo") + 1).cast("double") * max_rows / F.col("__rows")
    hot = counted.where((F.col("__rows") > max_rows) & F.col("__lo").isNotNull()).select(
        *names, "__lo", width.alias("__width"), F.lit(True).alias("__hot"))
    if not names:
        whole = hot.first()
        if whole is None:
            return base.select("*", F.lit(0).cast("long").alias("__gb"), F.lit(False).alias("__hot")), False
        return base.select("*", bucket(F.lit(whole["__lo"]), F.lit(whole["__width"])).alias("__gb"), F.lit(True).alias("__hot")), True
    hot = stage(hot, "hot_keys")
    if hot.isEmpty():
        return base.select("*", F.lit(0).cast("long").alias("__gb"), F.lit(False).alias("__hot")), False
    few = F.broadcast(hot) if fits(hot, MAX_HOT_KEYS) else hot
    joined = base.join(few, names, "left")
    cut = F.coalesce(F.col("__hot"), F.lit(False))
    return joined.select(*[F.col(f"`{c}`") for c in base.columns],
                         F.when(cut, bucket(F.col("__lo"), F.col("__width"))).otherwise(F.lit(0).cast("long")).alias("__gb"),
                         cut.alias("__hot")), True


def fill_down(df: DataFrame, columns: Sequence[str], order_col: str, keys: Sequence[str] = (),
              bucket_width: int | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """Forward-fill ``columns`` ordered by ``order_col`` (a row number in file
    order, or a date/timestamp; unique within a key), optionally within
    ``keys``. Keys of more than ``max_rows`` rows are cut into buckets; ``bucket_width``
    (in order-key units) cuts every key at that width instead, without counting."""
    if not columns:
        return df
    base, names = _keyed(df, order_col, list(keys))
    if bucket_width is not None:
        cut = F.coalesce(F.floor(F.col("__o") / F.lit(bucket_width)), F.lit(-1)).cast("long")
        base, buckets = base.select("*", cut.alias("__gb"), F.lit(True).alias("__hot")), True
    else:
        base, buckets = _bucketed(base, names, max_rows)
    order = F.col(f"`{order_col}`")
    part = [*names, "__gb"]
    inside = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = base.select(*[F.col(f"`{c}`") for c in base.columns if c not in columns],
                         *[F.last(F.col(f"`{c}`"), ignorenulls=True).over(inside).alias(c) for c in columns])
    if not buckets:
        return filled.select(*[F.col(f"`{c}`") for c in df.columns])
    # Aggregated from the input with partial aggregation: only per-task partials are shuffled.
    summary = base.where("__hot").groupBy(*part).agg(
        *[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), order)).alias(c) for c in columns])
    across = Window.partitionBy(*names).orderBy("__gb").rowsBetween(Window.unboundedPreceding, -1)
    carry = stage(summary.select(*[F.col(n).alias(f"__c{n}") for n in part],
                                 *[F.last(F.col(f"`{c}`"), ignorenulls=True).over(across).alias(f"__carry_{c}") for c in columns]),
                  "fill_carries")
    carry = F.broadcast(carry) if fits(carry, MAX_HOT_KEYS) else carry
    cond = None
    for n in part:
        term = F.col(n) == F.col(f"__c{n}")
        cond = term if cond is None else cond & term
    joined = filled.join(carry, cond, "left")
    out = [F.coalesce(F.col(f"`{c}`"), F.col(f"`__carry_{c}`")).alias(c) if c in columns else F.col(f"`{c}`")
           for c in df.columns]
    return joined.select(*out)
