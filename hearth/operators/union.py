"""Tagged union of several sources into one long table."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(frames: Mapping[str, DataFrame], label_col: str = "data_type") -> DataFrame:
    """Each frame gets its label as a constant column; frames are combined by
    name in one Union node (no loop-carried re-concatenation)."""
    if not frames:
        raise ValueError("no frames to union")
    tagged = [df.withColumn(label_col, F.lit(label)) for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
