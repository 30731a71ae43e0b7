"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Shingles are 64-bit hashes, ordered rarest first by how many different sets hold
them. The order is cut into ranges (fragments): every fragment counts its own
shingles over all documents, and a pair's overlap is the sum of the overlaps
counted in each fragment. Equal sets are one class throughout, known by a hash
of the set; copies are never paired with one another.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import textops as T
from hearth.llm.components import components
from hearth.operators.joins import MAX_BROADCAST_ROWS, fits
from hearth.session import stage

PER_FRAGMENT = 2_000_000  # shingles one fragment task holds
OVERLAP_FRAGMENTS = 4     # ranges a pair's overlap is counted in
DENSE = 255               # documents from which shingles count as equally frequent


def _sets(batch, k, max_bytes=8 << 20):
    """(rows, values, offsets, signatures) of slices of a (doc_id, text) batch."""
    for lo, hi, data, offsets in T.text_batches(batch.column(1), max_bytes):
        values, at = T.shingle_sets(*T.hash_words(T.lower_ascii(data), offsets), k)
        sizes = np.diff(at)
        folded = np.concatenate([[np.uint64(0)], np.cumsum(T.mix(values + np.uint64(1)), dtype=np.uint64)])
        signature = T.mix(folded[at[1:]] - folded[at[:-1]] + sizes.astype(np.uint64)).view(np.int64)
        yield batch.slice(lo, hi - lo), values, at, signature


def _signatures(k):
    def run(batches):
        for batch in batches:
            for rows, _, at, signature in _sets(batch, k):
                sizes = np.diff(at)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sizes), pa.array(signature, mask=sizes == 0)], ["doc_id", "n", "sig"])
    return run


def _packed(frag, sigs, ns, lens, values, extra=None):
    names = ["frag", "sigs", "ns", "lens", "vals"] + (["dfs"] if extra is not None else [])
    cols = [pa.array(frag, pa.int32())] + [pa.array(c, pa.binary()) for c in (sigs, ns, lens, values)]
    return pa.RecordBatch.from_arrays(cols + ([pa.array(extra, pa.binary())] if extra is not None else []), names)


def _emit(group, groups, owner, sigs, ns, values, dfs=None):
    """Rows (group, sets, their sizes, run lengths, values): one for each group."""
    out = [[] for _ in range(6)]
    columns = (owner, values) + ((dfs,) if dfs is not None else ())
    for g, (own, vals, *more) in T.split_packed(group, groups, *columns):
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        who = own[heads]
        for column, x in zip(out, (g, sigs[who], ns[who], np.diff(np.append(heads, len(own))).astype(np.int32), vals, *more)):
            column.append(x if column is out[0] else T.pack(x))
    return _packed(*out[:5], out[5] if dfs is not None else None)


def _segments(k, fragments):
    def run(batches):
        for batch in batches:
            for _, values, at, signature in _sets(batch, k):
                sizes = np.diff(at)
                first = np.unique(signature, return_index=True)[1]  # one copy of a set in this slice
                chosen = np.zeros(len(sizes), bool)
                chosen[first] = True
                owner = np.repeat(np.arange(len(sizes)), sizes)
                keep = chosen[owner]
                if keep.any():
                    yield _emit(T.part_of(values[keep], fragments), fragments, owner[keep], signature,
                                sizes.astype(np.int32), values[keep])
    return run


def _load(table, dfs=False):
    """(sigs, ns, lens, values[, dfs]) of packed rows, each set's run as often as it came."""
    kinds = [("sigs", np.int64), ("ns", np.int32), ("lens", np.int32), ("vals", np.uint64)] + [("dfs", np.uint8)] * dfs
    return [T.unpack(table.column(c), t) for c, t in kinds]


def _shared(buckets):
    """In one fragment: the shingles that two or more sets hold, dealt out by set."""
    def run(table):
        sigs, ns, lens, values = _load(table)
        at = np.concatenate([[0], np.cumsum(lens)])
        u, first = np.unique(sigs, return_index=True)
        keep = np.zeros(len(sigs), bool)
        keep[first] = True
        owner = np.repeat(np.arange(len(sigs)), lens)
        mask = keep[owner]
        owner, values = owner[mask], values[mask]
        order = np.argsort(values)
        ordered = values[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        df = np.empty(len(values), np.int64)
        df[order] = np.repeat(np.diff(np.append(heads, len(ordered))), np.diff(np.append(heads, len(ordered))))
        mask = df >= 2
        owner, values, df = owner[mask], values[mask], np.minimum(df[mask], DENSE).astype(np.uint8)
        bucket = T.part_of(T.mix(sigs.view(np.uint64)), buckets)[owner]
        return pa.Table.from_batches([_emit(bucket, buckets, owner, sigs, ns, values, df)])
    return run


def _least_overlap(n, percent):
    """The fewest shingles that a set of n shares with any partner: ceil(n * percent / 100)."""
    return -(-n * percent // 100)


def _survivors(percent):
    """Sets enough of whose shingles occur elsewhere, with those, rarest first."""
    def run(table):
        sigs, ns, lens, values, dfs = _load(table, True)
        u, at, which = np.unique(sigs, return_index=True, return_inverse=True)
        n = ns[at].astype(np.int64)
        shared = np.bincount(which, weights=lens, minlength=len(u)).astype(np.int64)
        keep = shared >= _least_overlap(n, percent)
        owner = np.repeat(which, lens)
        mask = keep[owner]
        owner, values, dfs = owner[mask], values[mask], dfs[mask]
        order = np.lexsort((values, dfs, owner))
        counts = shared[keep]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                                         pa.array(values[order].view(np.int64)))
        return pa.table({"sig": u[keep], "n": n[keep], "vals": lists})
    return run


def _prefixes(percent, fragments):
    """A partner shares one of a set's first n - overlap + 1 shingles, rarest first.
    Those that no other set holds come before all others and need no row."""
    def run(batches):
        for b in batches:
            sig, n, root = (b.column(c).to_numpy() for c in ("sig", "n", "root"))
            lists = b.column("vals")
            at = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy().view(np.uint64)
            shared = np.diff(at)
            take = np.minimum(np.maximum(shared - _least_overlap(n, percent) + 1, 0), shared)
            if not take.sum():
                continue
            owner = np.repeat(np.arange(len(sig)), take)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(take) - take, take)
            vals = flat[at[owner] + place]
            rest = shared[owner] - place  # this shingle and all that follow it
            alone = ((n - shared) * 1000 // n)[owner]
            out = [[] for _ in range(7)]
            for g, (own, v, left, few) in T.split_packed(T.part_of(vals, fragments), fragments, owner, vals, rest, alone):
                for column, x in zip(out, (g, sig[own], n[own], root[own], left, few, v)):
                    column.append(x if column is out[0] else T.pack(x))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32())] + [pa.array(c, pa.binary()) for c in out[1:]],
                                             ["frag", *POSTING, "vals"])
    return run


POSTING = ["sigs", "ns", "roots", "rests", "alone"]


def _postings(table):
    """[sig, n, root, rest] and the list bounds of one fragment: the sets that hold a
    shingle, those with the fewest shingles of their own first; lists of several roots."""
    sig, n, root, rest, alone = (T.unpack(table.column(c), np.int64) for c in POSTING)
    vals = T.unpack(table.column("vals"), np.uint64)
    order = np.lexsort((sig, alone, vals))
    sig, n, root, rest, vals = (x[order] for x in (sig, n, root, rest, vals))
    heads = np.flatnonzero(np.concatenate([[True], vals[1:] != vals[:-1]]))
    several = np.minimum.reduceat(root, heads) != np.maximum.reduceat(root, heads)
    ends = np.append(heads[1:], len(vals))
    return (sig, n, root, rest), list(zip(heads[several], ends[several]))


def _possible(n, m, rest_n, rest_m, percent):
    """Whether two sets whose first common shingle this is can reach the similarity:
    the overlap is at most what follows in either set."""
    return np.minimum(rest_n, rest_m) * (100 + percent) >= (n + m) * percent


def _pair_table(pairs):
    pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _hub_pairs(percent, hubs=3):
    """Each set with the few hubs it meets most often; a list's first sets are its hubs."""
    def run(table):
        (sig, n, root, rest), lists = _postings(table)
        met = []
        for lo, hi in lists:
            for h in range(lo, min(lo + hubs, hi - 1)):
                ok = _possible(n[h + 1:hi], n[h], rest[h + 1:hi], rest[h], percent) & (root[h + 1:hi] != root[h])
                if ok.any():
                    met.append(np.stack([sig[h + 1:hi][ok], np.full(int(ok.sum()), sig[h])], 1))
        if not met:
            return _pair_table([])
        pairs, count = np.unique(np.concatenate(met), axis=0, return_counts=True)
        order = np.lexsort((pairs[:, 1], -count, pairs[:, 0]))
        pairs = pairs[order]
        heads = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0]]))
        nth = np.arange(len(pairs)) - np.repeat(heads, np.diff(np.append(heads, len(pairs))))
        return _pair_table([pairs[nth < hubs]])
    return run


def _all_pairs(percent, block=1_000_000):
    """Every possible pair of a list whose sets lie in different components, in blocks;
    pairs inside one component are settled and never made."""
    def run(table):
        (sig, n, root, rest), lists = _postings(table)
        held, size, out = [], 0, []
        for lo, hi in lists:
            names, which, counts = np.unique(root[lo:hi], return_inverse=True, return_counts=True)
            s, m, left = sig[lo:hi], n[lo:hi], rest[lo:hi]
            large = int(np.argmax(counts))
            for i in np.flatnonzero(which != large):  # a pair has at least one set outside the largest component
                ok = _possible(m, m[i], left, left[i], percent) & (which != which[i])
                if ok.any():
                    held.append(np.stack([np.maximum(s[ok], s[i]), np.minimum(s[ok], s[i])], 1))
                    size += int(ok.sum())
                if size >= block:
                    out.append(np.unique(np.concatenate(held), axis=0))
                    held, size = [], 0
        return _pair_table(out + held)
    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose overlap, summed over the fragments, reaches the similarity."""
    width = -(-(1 << 64) // OVERLAP_FRAGMENTS)
    cuts = [-(1 << 63) + i * width for i in range(1, OVERLAP_FRAGMENTS)]

    def piece(i):
        low, high = F.lit(cuts[i - 1] if i else -(1 << 63)), F.lit(cuts[i] if i < len(cuts) else (1 << 63) - 1)
        last = i == len(cuts)
        return F.struct(F.lit(i).alias("part"), F.filter(
            "vals", lambda x: (x >= low) & ((x <= high) if last else (x < high))).alias("seg"))
    parts = F.array(*[piece(i) for i in range(OVERLAP_FRAGMENTS)])
    segments = sets.select("sig", "n", F.explode(parts).alias("p")).select("sig", "n", "p.part", "p.seg")
    left = segments.select(F.col("sig").alias("a"), F.col("n").alias("na"), "part", F.col("seg").alias("sa"))
    right = segments.select(F.col("sig").alias("b"), F.col("n").alias("nb"), "part", F.col("seg").alias("sb"))
    counted = (pairs.select("a", "b").join(left, "a").join(right, ["b", "part"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("partial"))
               .groupBy("a", "b", "na", "nb").agg(F.sum("partial").alias("overlap")))
    return counted.where(F.lit(100) * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def link_classes(docs: DataFrame, k: int, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n, sig), (sig, root)): the documents' classes, and the components of linked classes."""
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    members = stage(texts.mapInArrow(_signatures(k), f"doc_id {kind}, n long, sig long"), "shingle_classes")
    total = members.agg(F.sum("n")).first()[0] or 0
    fragments = max(1, math.ceil(total / PER_FRAGMENT))
    packed = "frag int, sigs binary, ns binary, lens binary, vals binary"
    shared = (texts.mapInArrow(_segments(k, fragments), packed).groupBy("frag")
              .applyInArrow(_shared(fragments), packed + ", dfs binary"))
    sets = stage(shared.groupBy("frag").applyInArrow(_survivors(percent), "sig long, n long, vals array<long>"),
                 "shingle_sets")
    roots = None
    for make in (_hub_pairs, _all_pairs):
        ranked = sets.withColumn("root", F.col("sig")) if roots is None else sets.join(
            roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        lists = ranked.mapInArrow(_prefixes(percent, fragments), "frag int, " + ", ".join(f"{c} binary" for c in [*POSTING, "vals"]))
        pairs = lists.groupBy("frag").applyInArrow(make(percent), "a long, b long").distinct()
        links = stage(_linked(pairs, sets, percent), "shingle_links")
        if not links.isEmpty():
            every = links if roots is None else links.unionByName(
                roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = components(every, "a", "b")
    if roots is None:
        roots = members.sparkSession.createDataFrame([], "node long, root long")
    return members, roots.select(F.col("node").alias("sig"), "root")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest id reachable by links).

    Two documents link when 100 * |intersection| >= percent * |union| of their
    distinct k-word shingles. A document without words has no shingles and links
    with nothing; a null key stays a row and is never a component's smallest id.
    Repeated rows share their component. Only ``key`` and ``text`` are read.

    Plan: (1) a set's shingles go to their fragments, packed; a fragment finds those
    that two sets or more hold. (2) Sets too few of whose shingles occur elsewhere
    cannot link and stop here. (3) The others meet in the lists of their rarest
    shingles. A first round pairs each with a few hubs only (sets with the fewest
    shingles of their own) and joins what links, so a large group of near copies
    costs a few pairs for each member; a second round makes every pair of a list that
    still lies in different components and that the shingles left after their first
    common one allow. Each pair's overlap is counted over all fragments, so the links
    are exact."""
    members, roots = link_classes(docs, k, percent, key, text)
    labelled = members.join(roots, "sig", "left").select(
        "doc_id", "n", F.coalesce("root", "sig").alias("label"))
    least = labelled.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(least, "label", "left").select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def row_name(docs: DataFrame, key: str = "doc_id", text: str = "text"):
    """What tells rows apart: the key and a hash of the text (null and empty texts differ)."""
    return F.struct(F.isnull(F.col(f"`{key}`")).alias("unnamed"), F.col(f"`{key}`").alias("key"),
                    F.xxhash64(F.col(f"`{text}`")).alias("sum"))


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that link to another with a smaller (key, hash of the text).

    Rows are judged by key and text: rows of one key but different texts are different
    documents, and of rows equal in both one stays. Texts without words, null and empty
    ones included, link with nothing. Rows with a null key, which nothing can name, all
    stay and stand for no group. An empty table gives an empty result."""
    name = row_name(docs, key, text)
    groups = near_duplicates(docs.select(name.alias("name"), F.col(f"`{text}`").alias("text")), key="name", **options)
    gone = stage(groups.where((F.col("name") != F.col("component_id")) & ~F.col("name.unnamed")).select("name").distinct(),
                 "copies")
    kept = without_rows(docs, gone, key, text)
    again = stage(docs.where(F.col(f"`{key}`").isNotNull()).groupBy(name.alias("name")).count().where("count > 1")
                  .select("name"), "repeated_rows")
    if again.isEmpty():
        return kept
    whole = kept.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), name.alias("name"))
    repeated = whole.join(again, "name", "left_semi").groupBy("name").agg(F.any_value("doc").alias("doc"))
    return without_rows(kept, again, key, text).unionByName(repeated.select("doc.*"))


def without_rows(docs: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` whose name (``row_name``) is not among ``names``: those are broadcast where a
    count shows that they are few, so the texts are not moved; else both sides are shuffled."""
    few = F.broadcast(names) if fits(names, MAX_BROADCAST_ROWS) else names
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_name(docs, key, text).alias("name"))
    return whole.join(few, "name", "left_anti").select("doc.*")
