"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Benchmark items are read in blocks of bounded size. A first pass counts each block's words
and word pairs in the corpus; the rarest of an item's are its seeds, as many as it takes
that no passage scoring as a copy can do without all of them. A second pass aligns the
words around every seed hit with the item, word by word, which also scores edited and
paraphrased copies; places that hold too few of the item's words to reach the threshold
are passed over. So every alignment that reaches the threshold is found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import textops as T
from hearth.llm.ngram_jaccard import row_name, without_rows
from hearth.session import stage

SHORTEST = 3                  # words that an item needs to name anything
LEAST_WORDS = 5               # a leak scores at least as this many words in a row (or the whole of a shorter item)
MATCH, MISMATCH, GAP = 2, -1, 1
THRESHOLD = 0.5               # alignment score, as a share of the item's own score, that marks a leak
BLOCK_BYTES = 4 << 20         # benchmark text of one block
FILTER_BITS = 22
HITS = 1 << 20                # seed hits looked at together, and words of texts aligned together


class Grams:
    """The distinct seeds of a block of items, with a bit table that rejects most others."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[(self.values >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, gram numbers) of the hashes that are seeds."""
        if not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] & ok)
        gram = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
        same = self.values[gram] == hashes[at]
        return at[same], gram[same]


def _hits(grams, words, first):
    """(positions, gram numbers), ascending by position, of the words and word pairs that are seeds."""
    pairs = T.windows(words, 2)
    one = grams.hits(words, np.ones(len(words), bool))
    two = grams.hits(pairs, T.within_text(first, 2)[:len(pairs)])
    at, gram = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
    order = np.argsort(at, kind="stable")
    return at[order], gram[order]


def _slices(batch, column):
    for lo, hi, data, offsets in T.text_batches(batch.column(column), 4 << 20):
        yield lo, *T.hash_words(T.lower_ascii(data), offsets)


def least_score(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """The alignment score from which a passage counts as a copy of an item of so many words."""
    return np.maximum(np.ceil(MATCH * threshold * sizes - 1e-9), MATCH * np.minimum(sizes, LEAST_WORDS)).astype(np.int64)


def _features(words, first):
    """(values, item, place) of all words and word pairs of the items that are long enough."""
    pairs = T.windows(words, 2)
    at = np.flatnonzero(T.within_text(first, 2)[:len(pairs)]) if len(pairs) else np.zeros(0, np.int64)
    place = np.concatenate([at, np.arange(len(words))])
    values = np.concatenate([pairs[at], words])
    item = np.searchsorted(first, place, "right") - 1
    able = np.diff(first)[item] >= SHORTEST
    return values[able], item[able], (place - first[item])[able]


def _counted(grams):
    """(gram, how often it occurs) in the corpus, one partial count for each task."""
    def run(batches):
        total = np.zeros(len(grams.values), np.int64)
        for batch in batches:
            for _, words, first in _slices(batch, 0):
                total += np.bincount(_hits(grams, words, first)[1], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])
    return run


def _rarest(values, item, counts, sizes, least):
    """Which features are seeds: each item's rarest, as many as no copy can miss.

    An alignment of m matches and e other columns scores 2m - e. Its matches lie in at most
    e + 1 unbroken stretches, which hold at least m - e - 1 matched pairs, so at least
    score - 1 of the item's 2L - 1 words and pairs are matched: a copy misses at most
    2L - least of them, and one more than that cannot all be missed."""
    need = 2 * sizes - least + 1
    order = np.lexsort((values, counts, item))
    heads = np.searchsorted(item[order], np.arange(len(sizes)))
    rank = np.arange(len(order)) - heads[item[order]]
    return order[rank < need[item[order]]]


def align(item: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, column after its end) of one item against each row of ``texts``.

    A row of the score table is a running maximum along the text, so all texts go at once."""
    rows, width = texts.shape
    slope = GAP * np.arange(width + 1, dtype=np.int32)
    above = np.zeros((rows, width + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    for word in item:
        now = np.zeros((rows, width + 1), np.int32)
        np.maximum(above[:, :-1] + np.where(texts == word, MATCH, MISMATCH), above[:, 1:] - GAP, out=now[:, 1:])
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.argmax(1)
        score = now[np.arange(rows), top]
        better = score > best
        best, end = np.where(better, score, best), np.where(better, top, end)
        above = now
    return best, end


def _regions(doc, item, start, length):
    """Seed hits whose implied item starts lie close together, as (doc, item, first start, last start)."""
    order = np.lexsort((start, item, doc))
    doc, item, start, length = doc[order], item[order], start[order], length[order]
    same = np.concatenate([[False], (doc[1:] == doc[:-1]) & (item[1:] == item[:-1])])
    gap = np.concatenate([[0], np.diff(start)])
    head = ~same | (gap > length // 2 + 1)
    # A chain of hits is cut where it would outgrow the item's length.
    group = np.cumsum(head) - 1
    origin = start[np.flatnonzero(head)][group]
    head |= np.concatenate([[False], ((start - origin) // np.maximum(length, 1))[1:] != ((start - origin) // np.maximum(length, 1))[:-1]]) & same
    heads = np.flatnonzero(head)
    return doc[heads], item[heads], np.minimum.reduceat(start, heads), np.maximum.reduceat(start, heads)


def _held(item, texts):
    """How many words of one item each row of ``texts`` holds: no alignment matches more."""
    names, times = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(names, texts), len(names) - 1)
    row, place = np.nonzero(names[at] == texts)
    count = np.bincount(row * len(names) + at[row, place], minlength=len(texts) * len(names)).reshape(len(texts), -1)
    return np.minimum(count, times).sum(1)


def _passages(doc, item, low, high, words, first, sizes, words_of, least):
    """(regions, scores, starts, ends) of the regions whose best alignment reaches the threshold."""
    # An alignment that reaches the threshold has no more gaps than this on either side of a seed.
    pad = (MATCH * sizes[item] - least[item]) // GAP
    left = np.maximum(low - pad, first[doc])
    right = np.minimum(high + sizes[item] + pad, first[doc + 1])
    rows = [[], [], [], []]
    order = np.argsort(item, kind="stable")
    for mine in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
        target = words_of(item[mine[0]])
        step = max(1, HITS // int((right[mine] - left[mine]).max()))
        for part in range(0, len(mine), step):
            some = mine[part:part + step]
            width = int((right[some] - left[some]).max())
            spot = left[some, None] + np.arange(width)
            text = np.where(spot < right[some, None], words[np.minimum(spot, len(words) - 1)], 0)
            able = MATCH * _held(target, text) >= least[item[mine[0]]]
            if not able.any():
                continue
            some, text = some[able], text[able]
            score, end = align(target, text)
            share = score / (MATCH * len(target))
            good = np.flatnonzero(score >= least[item[mine[0]]])
            if len(good):
                # The start is the end of the best alignment of both read backwards.
                back, tail = align(target[::-1], text[good][:, ::-1])
                for column, x in zip(rows, (some[good], share[good], left[some[good]] + width - tail, left[some[good]] + end[good])):
                    column.append(x)
    return [np.concatenate(x) for x in rows] if rows[0] else None


def _leaks(ids, sizes, words_of, grams, post_gram, post_item, post_at, least):
    """(doc_id, item_id, score, start, end) of the documents' aligned passages."""
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            keys = batch.column(0)
            for lo, words, first in _slices(batch, 1):
                at, gram = _hits(grams, words, first)
                if not len(at):
                    continue
                owner = np.searchsorted(first, at, "right") - 1
                a, b = np.searchsorted(post_gram, gram), np.searchsorted(post_gram, gram, "right")
                # A document's hits stay together.
                heads = np.flatnonzero(np.diff(owner, prepend=-1))
                piece = (np.cumsum(b - a) - (b - a))[heads] // HITS
                cuts = np.append(heads[np.flatnonzero(np.diff(piece, prepend=-1))], len(at))
                for head, tail in zip(cuts[:-1], cuts[1:]):
                    begins, times = a[head:tail], (b - a)[head:tail]
                    post = np.repeat(begins - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
                    start = np.repeat(at[head:tail], times) - post_at[post]
                    doc, item, low, high = _regions(np.repeat(owner[head:tail], times), post_item[post], start, sizes[post_item[post]])
                    found = _passages(doc, item, low, high, words, first, sizes, words_of, least)
                    if found is None:
                        continue
                    region, share, begin, end = found
                    order = np.lexsort((begin, -share, item[region], doc[region]))
                    d, i = doc[region][order], item[region][order]
                    top = order[np.concatenate([[True], (d[1:] != d[:-1]) | (i[1:] != i[:-1])])]
                    d = doc[region[top]]
                    out[0].append(keys.take(pa.array(d + lo)))
                    for column, x in zip(out[1:], (ids[item[region[top]]], share[top], begin[top] - first[d], end[top] - first[d])):
                        column.append(pa.array(x))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in out], ["doc", "item", "score", "first_word", "last_word"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: key, item_id, score (share of the
    item's own alignment score), first_word and last_word (the best passage's words, from 0).

    Every passage whose best local alignment (match 2, mismatch -1, gap -1) scores at least
    ``threshold`` of the item's own score, and at least as ``LEAST_WORDS`` words in a row, is
    found: an item shorter than that must stand there whole. Words are compared with A-Z
    lower-cased. An item of fewer than ``SHORTEST`` words, null ones included, is never found;
    an item id is a whole number, rows with a null one are left out. Repeated documents are
    rows of their own, a repeated item counts once. Empty tables give an empty result; other
    columns are not read. Counts only order an item's words and pairs: which are seeds
    changes the work, not the result."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc"]
    schema = f"doc {kind}, item long, score double, first_word long, last_word long"
    items = (benchmark.where(F.col(item_key).isNotNull()).select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("text"))
             .where(F.col("text").isNotNull()).distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    found = rows.sparkSession.createDataFrame([], schema)
    for block in range(blocks):  # each block is a scan of its own; a block's text is bounded
        got = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).orderBy("item", "text").toArrow()
        offsets = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in got.column("text").to_pylist()])]).astype(np.int64)
        data = np.frombuffer("".join(got.column("text").to_pylist()).encode().lower(), np.uint8)
        words, first = T.hash_words(data, offsets)
        ids, sizes = got.column("item").to_numpy(), np.diff(first)
        least = least_score(sizes, threshold)
        values, owner, at = _features(words, first)
        every = Grams(values)
        if not len(values):
            continue  # no item of this block is long enough
        # At most one row for each word and pair of the block.
        seen = (rows.select("text").mapInArrow(_counted(every), "gram long, n long").groupBy("gram")
                .agg(F.sum("n").alias("n")).toArrow())
        count = np.zeros(len(every.values), np.int64)
        count[seen.column("gram").to_numpy()] = seen.column("n").to_numpy()
        seeds = _rarest(values, owner, count[np.searchsorted(every.values, values)], sizes, least)
        values, owner, at = values[seeds], owner[seeds], at[seeds]
        grams = Grams(values)
        gram = np.searchsorted(grams.values, values)
        by = np.argsort(gram, kind="stable")

        def words_of(i, words=words, first=first):
            return words[first[i]:first[i + 1]]
        part = rows.mapInArrow(_leaks(ids, sizes, words_of, grams, gram[by], owner[by], at[by], least), schema)
        found = found.unionByName(part)
    return found.select(F.col("doc").alias(key), F.col("item").alias("item_id"), "score", "first_word", "last_word")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item.

    Rows are judged by key and text, so a clean row stays beside a leaked one of its key,
    and repeated rows go or stay together. Rows with a null key are judged like others;
    null and empty texts hold nothing. An empty benchmark takes nothing away."""
    named = docs.select(row_name(docs, key, text).alias("name"), F.col(f"`{text}`").alias("text"))
    leaked = stage(find_leaks(named, benchmark, key="name", **options).select("name").distinct(), "leaked_rows")
    return without_rows(docs, leaked, key, text)
