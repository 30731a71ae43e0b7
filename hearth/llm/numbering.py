"""Gapless numbers within groups, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import stage


def place_in_group(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``name``: each row's number within its group, from 0 without gaps, in ``order``.

    One range partitioning by (group, order): a row's number is its place in its range
    plus the group's rows in earlier ranges, so a group of any size is spread over ranges.
    ``order`` must tell all rows of a group apart. The ranges are staged, so a lost
    executor cannot renumber them. ``rows`` should be narrow: it is sorted and staged."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    by = [*group, *order]
    ranged = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    ranged = stage(ranged.withColumn("__range", F.spark_partition_id()), "ranges")
    place = Window.partitionBy("__range", *group).orderBy(*order)
    placed = ranged.withColumn("__place", F.row_number().over(place) - 1)
    # At most one row per range and group it holds: ranges + groups rows in all.
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__n")).select(
        *group, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return placed.join(F.broadcast(starts), [*group, "__range"]).withColumn(
        name, (F.col("__start") + F.col("__place")).cast("long")).drop("__range", "__place", "__start")
