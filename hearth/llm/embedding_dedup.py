"""Embedding near-dedup by p-stable hashing of normalised vectors.

For unit vectors cosine >= c means distance <= sqrt(2 - 2c). A table hashes a vector
by several quantised Gaussian projections; near vectors fall into one bucket in one of
the tables at least with the wanted recall. Pairs in a bucket are compared exactly, in
blocks, and a pair that meets in several tables counts in the first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import textops as T
from hearth.llm.components import components
from hearth.session import stage

WIDTH = 2.0          # quantisation step of a projection
RECALL = 0.98        # wanted share of pairs at exactly the threshold
CROWD = 16           # unrelated vectors a bucket should hold at most, on average
BLOCK = 2048         # members of one bucket one task compares; larger buckets become a grid of blocks
PER_TASK = 40_000    # bucket entries one task holds


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees for two points ``distance`` apart."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(count: int, cosine: float) -> tuple[int, int]:
    """(projections of a table, tables): buckets stay small as the count grows, recall as wanted.

    Unrelated vectors are taken as orthogonal."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    projections = max(1, math.ceil(math.log(max(count, 2) / CROWD) / -math.log(far)))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - near ** projections))
    return projections, tables


def _matrix(column, size):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(size, -1)


def _sign(dim, projections, tables, seed):
    r = np.random.default_rng(seed)
    normal = r.standard_normal((dim, projections * tables))
    shift = r.uniform(0, WIDTH, projections * tables)
    mixer = r.integers(1, 1 << 62, projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2), batch.num_rows).astype(np.float64)
            # Scaled first, so that squares of very large or small components stay finite.
            x /= np.abs(x).max(1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            cell = np.floor((x @ normal + shift) / WIDTH).astype(np.int64).reshape(len(x), tables, projections)
            keys = T.mix((T.mix(cell.view(np.uint64)) * mixer).sum(2, dtype=np.uint64)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
            unit = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * dim), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), unit, lists], ["id", "weight", "unit", "keys"])
    return run


def _roots(n, a, b):
    """The smallest node of each node's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def _compare(cosine):
    """In one task: for each vector the weight of those it links with here, and the smallest
    vector its links here lead to."""
    def run(table):
        n = table.num_rows
        num = lambda c: table.column(c).to_numpy()
        order = np.lexsort((num("side"), num("key"), num("cell"), num("tab")))
        tab, key, cell, side, ids, weight = (num(c)[order] for c in ("tab", "key", "cell", "side", "id", "weight"))
        keys = _matrix(table.column("keys").combine_chunks(), n)[order]
        unit = _matrix(table.column("unit").combine_chunks(), n)[order]
        new = np.concatenate([[True], (tab[1:] != tab[:-1]) | (cell[1:] != cell[:-1]) | (key[1:] != key[:-1])])
        heads = np.flatnonzero(new)
        links, left, right = np.zeros(n, np.int64), [], []
        for lo, hi in zip(heads, np.append(heads[1:], n)):
            # A grid cell off the diagonal compares its two sides; any other cell all its members.
            split = lo + int(np.searchsorted(side[lo:hi], 1))
            rows, cols = (lo, split) if split < hi else (lo, hi), (split, hi) if split < hi else (lo, hi)
            if hi - lo < 2 or split == lo:
                continue
            for i in range(rows[0], rows[1], 256):
                j = min(i + 256, rows[1])
                near = unit[i:j] @ unit[cols[0]:cols[1]].T >= cosine
                if split == hi:
                    near &= np.arange(lo, hi)[None, :] > np.arange(i, j)[:, None]
                a, b = np.nonzero(near)
                a, b = a + i, b + cols[0]
                earlier = ((keys[a] == keys[b]) & (np.arange(keys.shape[1]) < tab[lo])).any(1)
                a, b = a[~earlier], b[~earlier]
                links += np.bincount(a, weights=weight[b], minlength=n).astype(np.int64)
                links += np.bincount(b, weights=weight[a], minlength=n).astype(np.int64)
                left.append(a)
                right.append(b)
        some = np.flatnonzero(links)
        # The smallest id, not the smallest place, stands for a component.
        _, name = np.unique(ids, return_inverse=True)
        a = np.concatenate(left) if left else np.zeros(0, int)
        b = np.concatenate(right) if right else np.zeros(0, int)
        values = np.unique(ids)
        root = values[_roots(len(values), name[a], name[b])] if n else ids
        return pa.table({"id": ids[some], "links": links[some], "root": root[name[some]]})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", vector: str = "embedding",
                    seed: int = 0) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, and so do vectors of different lengths. Equal vectors are one class that is
    compared once; each copy links with all others. A null key links like any other row
    but is never a component's smallest id. Only ``key`` and ``vector`` are read.

    A bucket with over BLOCK members becomes a grid of blocks, each pair of blocks a unit
    of its own, so no task holds a large bucket; tasks return a count for each vector and
    the smallest vector its links lead to, never pairs."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("v").isNotNull() & F.coalesce(~bad, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    # Minus zero equals zero; two hashes of the components name a class.
    clean = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    rows = rows.withColumn("class", F.when(usable, F.struct(F.size("v").alias("dim"), F.xxhash64(clean).alias("h1"),
                                                            F.xxhash64(F.lit(7), clean).alias("h2"))))
    members = stage(rows.select("id", "class"), "vector_classes")
    classes = stage(rows.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")), "vector_first")
    sizes = classes.groupBy("class.dim").count().collect()  # one row for each length of vector
    classes = classes.withColumn("node", F.xxhash64("class"))
    found = None
    for dim, count in sizes:
        projections, tables = plan(count, cosine)
        same = classes.where(F.col("class.dim") == dim).select("node", "weight", "v")
        signed = stage(same.mapInArrow(_sign(dim, projections, tables, seed),
                                       "id long, weight long, unit array<double>, keys array<long>"), "vector_keys")
        crowded = (signed.select(F.posexplode("keys").alias("tab", "key")).groupBy("tab", "key")
                   .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
                   .select("tab", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
        entries = signed.select("*", F.posexplode("keys").alias("tab", "key")).join(crowded, ["tab", "key"], "left")
        blocks = F.coalesce("blocks", F.lit(1))
        mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
        entries = entries.withColumn("blocks", blocks).withColumn("mine", mine)
        entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        entries = entries.select("id", "weight", "unit", "keys", "tab", "key",
                                 (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).cast("long").alias("cell"),
                                 F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"))
        tasks = max(1, math.ceil(count * tables / PER_TASK))
        got = entries.withColumn("task", F.pmod(F.xxhash64("tab", "key", "cell"), F.lit(tasks))).groupBy("task").applyInArrow(
            _compare(cosine), "id long, links long, root long")
        found = got if found is None else found.unionByName(got)
    if found is None:
        return members.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"),
                              F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = stage(found, "vector_links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found, "id", "root").select(F.col("node").alias("id"), "root")
    labels = classes.select("class", "node", "weight").join(links, classes.node == links.id, "left").drop("id")
    labels = labels.join(roots, labels.node == roots.id, "left").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("root", "node").alias("label"))
    least = classes.select("class", F.col("id").alias("first")).join(labels, "class").groupBy("label").agg(
        F.min("first").alias("component"))
    labels = labels.join(least, "label").select("class", "n", "component")
    out = members.join(labels, members["class"].eqNullSafe(labels["class"]), "left").select(
        F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
