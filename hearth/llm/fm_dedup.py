"""Substring dedup: compressed FM-index shards answer matching statistics.

A window of ``window`` consecutive words that also starts anywhere else marks its
words for removal. Windows are routed by their minimizer (the smallest hash of the
``seed``-word sequences inside), so equal windows meet in one shard and a document
is streamed only against the shards its own windows name:

1. every document's minimizers are counted; a window whose minimizer occurs once in
   the corpus has no copy and goes no further,
2. the remaining windows, as runs that share a minimizer, go to their shard,
3. a shard indexes its runs (suffix array, Burrows-Wheeler transform, wavelet matrix
   with rank directory) and searches every run backwards in it; a match of ``window``
   words or more that occurs twice is reported.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import textops as T
from hearth.session import stage

WINDOW, SEED = 35, 8
PER_FRAGMENT = 2_000_000   # minimizers one counting task holds
PER_SHARD = 1_000_000      # words one shard's index holds
HOT = 20_000               # minimizers with more occurrences are routed window by window
DOCS_PER_BUCKET = 50_000


# ---- minimizers -----------------------------------------------------------

def sequences(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word hashes, by doubling."""
    total, width, covered = None, 1, 0
    level = hashes
    while True:
        if k & width:
            n = len(hashes) - k + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            piece = level[covered:covered + n]
            total = piece.copy() if total is None else total * np.uint64(0xD6E8FEB86659FD93) + piece
            covered += width
        if width * 2 > k:
            return T.mix(total)
        if len(level) <= width:
            return np.zeros(0, np.uint64)
        level = T.mix(level[:-width] * np.uint64(0x9FB21C651E98DF25) + level[width:])
        width *= 2


def minimizers(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window start: (position, hash) of the leftmost smallest seed in the window."""
    h = sequences(hashes, seed)
    span = window - seed + 1
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), h[:0]
    at, width = np.arange(len(h)), 1

    def lower(at, h, shift, size):
        a, b = h[:size], h[shift:shift + size]
        right = b < a
        return np.where(right, at[shift:shift + size], at[:size]), np.where(right, b, a)
    while width * 2 <= span:
        at, h = lower(at, h, width, len(h) - width)
        width *= 2
    if width < span:
        at, h = lower(at, h, span - width, n)
    return at[:n], h[:n]


def _hashed(batch, text_column):
    for lo, hi, data, offsets in T.text_batches(batch.column(text_column), 4 << 20):
        hashes, first = T.hash_words(data, offsets)
        yield lo, hi, hashes, first


def _column(batch, i, kind):
    return batch.column(i).fill_null(0).to_numpy(zero_copy_only=False).astype(kind)


def _seeds(fragments, window, seed):
    """(frag, documents, run lengths, positions, hashes) of every document's minimizers."""
    def run(batches):
        for batch in batches:
            ids, sums = _column(batch, 0, np.int64), _column(batch, 1, np.int64)
            for lo, hi, hashes, first in _hashed(batch, 2):
                at, h = minimizers(hashes, window, seed)
                if not len(at):
                    continue
                ok = T.within_text(first, window)[:len(at)]
                at, h = at[ok], h[ok]
                new = np.concatenate([[True], at[1:] != at[:-1]])[:len(at)]
                at, h = at[new], h[new]
                if not len(at):
                    continue
                doc = np.searchsorted(first, at, "right") - 1
                out = [[] for _ in range(6)]
                for g, (d, a, x) in T.split_packed(T.part_of(h, fragments), fragments, doc, at - first[doc], h):
                    heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                    who = d[heads] + lo
                    for c, v in zip(out, (g, ids[who], sums[who], np.diff(np.append(heads, len(d))).astype(np.int32),
                                          a.astype(np.int32), x)):
                        c.append(v if c is out[0] else T.pack(v))
                yield _batch(out, ["frag", "ids", "sums", "lens", "at", "hash"])
    return run


def _batch(columns, names):
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]], names)


def _bucket(ids, sums, buckets):
    return T.part_of(T.mix(ids.view(np.uint64) ^ sums.view(np.uint64)), buckets)


def _repeated(buckets):
    """In one fragment: the minimizers that occur more than once, dealt by document."""
    def run(table):
        lens = T.unpack(table.column("lens"), np.int32)
        ids, sums = (np.repeat(T.unpack(table.column(c), np.int64), lens) for c in ("ids", "sums"))
        at, h = T.unpack(table.column("at"), np.int32), T.unpack(table.column("hash"), np.uint64)
        order = np.argsort(h)
        heads = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        size = np.diff(np.append(heads, len(h)))
        count = np.empty(len(h), np.int64)
        count[order] = np.repeat(size, size)
        mask = count > 1
        ids, sums, at, hot = ids[mask], sums[mask], at[mask], (count[mask] > HOT).astype(np.uint8)
        out = [[] for _ in range(5)]
        for g, cells in T.split_packed(_bucket(ids, sums, buckets), buckets, ids, sums, at, hot):
            for c, v in zip(out, (g, *cells)):
                c.append(v if c is out[0] else T.pack(v))
        return pa.Table.from_batches([_batch(out, ["bucket", "ids", "sums", "a", "b"])])
    return run


def _per_document(first_kind, second_kind, merge):
    """One row (id, sum, a, b) for each document of a bucket, ``a`` and ``b`` as packed arrays."""
    def run(table):
        ids, sums = T.unpack(table.column("ids"), np.int64), T.unpack(table.column("sums"), np.int64)
        a, b = T.unpack(table.column("a"), first_kind), T.unpack(table.column("b"), second_kind)
        order = np.lexsort((a, sums, ids))
        ids, sums, a, b = ids[order], sums[order], a[order], b[order]
        heads = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (sums[1:] != sums[:-1])])) if len(ids) else np.zeros(0, int)
        rows = [merge(a[lo:hi], b[lo:hi]) for lo, hi in zip(heads, np.append(heads[1:], len(ids)))]
        return pa.table({"id": ids[heads], "sum": sums[heads], "a": pa.array([T.pack(r[0]) for r in rows], pa.binary()),
                         "b": pa.array([T.pack(r[1]) for r in rows], pa.binary())})
    return run


def _distinct(a, b):
    """Positions once each (rows repeated in the input bring them again)."""
    at, first = np.unique(a, return_index=True)
    return at, b[first]


def _joined(a, b):
    """Overlapping or touching intervals [a, b) as one."""
    top = np.maximum.accumulate(b)
    heads = np.flatnonzero(np.concatenate([[True], a[1:] > top[:-1]]))
    return a[heads], np.maximum.reduceat(b, heads)


# ---- runs -----------------------------------------------------------------

def _runs(shards, window, seed):
    """(shard, id, sum, start, windows, multiplicity, words) of the windows whose minimizer is repeated.

    Windows of a hot minimizer go one by one, by a hash of all their words; of equal ones
    in a slice one is sent with its multiplicity, and the others are sent as found: their
    rows hold no words."""
    def run(batches):
        for batch in batches:
            ids, sums = _column(batch, 0, np.int64), _column(batch, 1, np.int64)
            marks = [batch.column(3).to_pylist(), batch.column(4).to_pylist()]
            for lo, hi, hashes, first in _hashed(batch, 2):
                at, h = minimizers(hashes, window, seed)
                if not len(at):
                    continue
                wanted = np.zeros(len(hashes), np.uint8)
                for d in range(lo, hi):
                    wanted[np.frombuffer(marks[0][d], np.int32) + first[d - lo]] = 1 + np.frombuffer(marks[1][d], np.uint8)
                start = np.flatnonzero(T.within_text(first, window)[:len(at)] & (wanted[at] > 0))
                if not len(start):
                    continue
                at, h, hot = at[start], h[start], wanted[at[start]] == 2
                doc = np.searchsorted(first, start, "right") - 1
                head = np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]) | hot
                heads = np.flatnonzero(head)
                start, route, doc, hot = start[heads], h[heads], doc[heads], hot[heads]
                wins = np.diff(np.append(heads, len(at))).astype(np.int64)
                times = np.ones(len(start), np.int64)
                size = wins + window - 1
                if hot.any():
                    whole = sequences(hashes, window)[start[hot]]
                    route[hot] = whole
                    _, where, inverse, count = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
                    index = np.flatnonzero(hot)
                    times[index] = count[inverse]
                    rest = np.ones(len(index), bool)
                    rest[where] = False
                    size[index[rest]] = 0
                out = [[] for _ in range(7)]
                for g, (d, s, w, t, z) in T.split_packed(T.part_of(T.mix(route), shards), shards, doc, start, wins, times, size):
                    words = np.repeat(s, z) + np.arange(int(z.sum())) - np.repeat(np.cumsum(z) - z, z)
                    cells = (g, ids[d + lo], sums[d + lo], (s - first[d]).astype(np.int32),
                             np.where(z > 0, w, -w).astype(np.int16), t.astype(np.int32), hashes[words])
                    for c, v in zip(out, cells):
                        c.append(v if c is out[0] else T.pack(v))
                yield _batch(out, RUN_ROWS)
    return run


RUN_ROWS = ["shard", "ids", "sums", "start", "wins", "times", "words"]


# ---- the index ------------------------------------------------------------

class WaveletMatrix:
    """Rank over a sequence of symbols: one bit plane for each bit of the symbols, packed
    in 64-bit words with a count of ones before each word."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.planes, self.zeros = len(symbols), [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            bit = (now >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1]
            self.planes.append((packed, ones.astype(np.int32)))
            zero = bit == 0
            self.zeros.append(int(zero.sum()))
            now = np.concatenate([now[zero], now[~zero]])

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the front ``at`` of the sequence ends among the symbols' own places on the last plane."""
        level = len(self.planes)
        for (packed, ones), zeros in zip(self.planes, self.zeros):
            level -= 1
            word = at >> 6
            below = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            rank = ones[word] + np.bitwise_count(below)
            at = np.where((symbols >> level) & 1, zeros + rank, at - rank)
        return at


class FMIndex:
    """An index of runs of symbols 1..sigma, each run ended by a mark of its own."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, weights: np.ndarray, sigma: int):
        runs = len(bounds) - 1
        size = np.diff(bounds)
        n = len(symbols) + runs
        owner = np.repeat(np.arange(runs), size + 1)
        text = np.zeros(n, np.int64)
        ends = bounds[1:] + np.arange(runs)
        inner = np.ones(n, bool)
        inner[ends] = False
        text[inner] = symbols
        rank = text + runs - 1
        rank[ends] = np.arange(runs)
        width, longest = 1, int(size.max()) + 1 if runs else 1
        order = np.argsort(rank, kind="stable")
        while width < longest:  # ends differ, so a run's suffixes are told apart within its length
            ahead = np.zeros(n, np.int64)
            ahead[:-width] = rank[width:] + 1
            pair = rank * np.int64(n + runs + sigma + 2) + ahead
            order = np.argsort(pair, kind="stable")
            new = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            width *= 2
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[order]])])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        self.matrix = WaveletMatrix(text[order - 1], max(1, int(sigma).bit_length()))
        self.base = self.matrix.place(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))

    def extend(self, symbols, low, high):
        """The intervals of the patterns with ``symbols`` put before them."""
        both = self.matrix.place(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        shift = self.first[symbols] - self.base[symbols]
        return both[:len(symbols)] + shift, both[len(symbols):] + shift

    def occurrences(self, low, high):
        return self.weight[high] - self.weight[low]


def repeated_windows(symbols: np.ndarray, bounds: np.ndarray, weights: np.ndarray, window: int) -> np.ndarray:
    """For every run of distinct content, which of its positions start a window that occurs twice.

    Each run is searched from its right end leftwards for as long as the match occurs
    twice: matching statistics at that end. When a word breaks the match at i, the next
    end to try is that of the window which starts at i."""
    names, text = np.unique(symbols, return_inverse=True)
    text = text + 1
    index = FMIndex(text, bounds, weights, len(names))
    found = np.zeros(len(symbols) + 1, np.int64)
    run = np.flatnonzero(np.diff(bounds) >= window)
    head, end = bounds[:-1][run], bounds[1:][run]
    at = end.copy()
    low, high = np.zeros(len(run), np.int64), np.full(len(run), index.matrix.n, np.int64)
    while len(run):
        lo, hi = index.extend(text[at - 1], low, high)
        more = index.occurrences(lo, hi) >= 2
        at = at - more
        low, high = np.where(more, lo, low), np.where(more, hi, high)
        stop = ~more | (at == head)
        full = stop & (end - at >= window)
        found[at[full]] += 1
        found[end[full] - window + 1] -= 1
        # Go on with the window that starts at the word which broke the match.
        done = stop & (at == head)
        again = stop & ~done
        new_end = np.minimum(end - 1, at - 1 + window)
        end = np.where(again, new_end, end)
        at = np.where(again, new_end, at)
        low, high = np.where(again, 0, low), np.where(again, index.matrix.n, high)
        done |= again & (end - head < window)
        if done.any():
            left = ~done
            run, head, end, at, low, high = run[left], head[left], end[left], at[left], low[left], high[left]
    return np.cumsum(found[:-1]) > 0


def _search(buckets, window):
    """In one shard: the runs' repeated windows as intervals of their documents, dealt by document."""
    def run(table):
        ids, sums, start, wins, times, words = (T.unpack(table.column(c), k) for c, k in zip(
            RUN_ROWS[1:], (np.int64, np.int64, np.int32, np.int16, np.int32, np.uint64)))
        known = wins < 0  # copies within one slice of a window that was sent
        wins = np.abs(wins).astype(np.int64)
        size = np.where(known, 0, wins + window - 1)
        bounds = np.concatenate([[0], np.cumsum(size)])
        sent = np.flatnonzero(~known)
        # Runs of equal content are indexed once, with their number.
        place = (np.arange(len(words)) - np.repeat(bounds[:-1], size)).astype(np.uint64)
        sums_of = np.concatenate([[np.uint64(0)], np.cumsum(T.mix(T.mix(words) + place * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
        content = T.mix(sums_of[bounds[1:]] - sums_of[bounds[:-1]] + size.astype(np.uint64))[sent]
        _, chosen, which = np.unique(content, return_index=True, return_inverse=True)
        weights = np.bincount(which, weights=times[sent]).astype(np.int64) if len(sent) else np.zeros(0, np.int64)
        picked = sent[chosen]
        length = size[picked]
        cuts = np.concatenate([[0], np.cumsum(length)])
        spots = np.repeat(bounds[picked], length) + np.arange(int(cuts[-1])) - np.repeat(cuts[:-1], length)
        hit = repeated_windows(words[spots], cuts, weights, window) if len(picked) else np.zeros(0, bool)
        # Intervals of window starts within each distinct run, then for each of its occurrences.
        inside = np.zeros(len(hit) + 1, np.int8)
        inside[:-1] = hit
        edge = np.diff(np.concatenate([[0], inside]))
        opened, closed = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        of = np.searchsorted(cuts, opened, "right") - 1
        first = np.searchsorted(of, np.arange(len(picked) + 1))
        number = np.diff(first)[which] if len(sent) else np.zeros(0, int)
        take = np.repeat(first[:-1][which] - np.cumsum(number) + number, number) + np.arange(int(number.sum())) if len(sent) else np.zeros(0, int)
        row = np.repeat(sent, number)
        a = start[row] + (opened[take] - cuts[of[take]])
        b = start[row] + (closed[take] - 1 - cuts[of[take]]) + window
        also = np.flatnonzero(known)
        row = np.concatenate([row, also])
        a = np.concatenate([a, start[also]]).astype(np.int32)
        b = np.concatenate([b, start[also] + wins[also] - 1 + window]).astype(np.int32)
        out = [[] for _ in range(5)]
        for g, cells in T.split_packed(_bucket(ids[row], sums[row], buckets), buckets, ids[row], sums[row], a, b):
            for c, v in zip(out, (g, *cells)):
                c.append(v if c is out[0] else T.pack(v))
        return pa.Table.from_batches([_batch(out, ["bucket", "ids", "sums", "a", "b"])])
    return run


def repeated_intervals(rows: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(id, sum, text) rows -> (id, sum, a, b): packed int32 word intervals [a, b) that repeated windows cover."""
    total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    words = (total[1] or 0) / 5
    fragments = max(1, math.ceil(words * 2 / (window - seed + 2) / PER_FRAGMENT))
    buckets = max(1, math.ceil(total[0] / DOCS_PER_BUCKET))
    binary = lambda names: ", ".join(f"{c} binary" for c in names)
    dealt = "bucket int, " + binary(["ids", "sums", "a", "b"])
    marks = (rows.mapInArrow(_seeds(fragments, window, seed), "frag int, " + binary(["ids", "sums", "lens", "at", "hash"]))
             .groupBy("frag").applyInArrow(_repeated(buckets), dealt).groupBy("bucket")
             .applyInArrow(_per_document(np.int32, np.uint8, _distinct), "id long, sum long, a binary, b binary"))
    marks = stage(marks, "fm_minimizers")
    found = marks.agg(F.sum(F.octet_length("a"))).first()[0] or 0
    # A minimizer stands for a run of about half the seeds of a window, and brings the words around it.
    shards = max(1, math.ceil(found / 4 * (window + (window - seed) / 2) / PER_SHARD))
    runs = (rows.join(marks, ["id", "sum"]).select("id", "sum", "text", "a", "b")
            .mapInArrow(_runs(shards, window, seed), "shard int, " + binary(RUN_ROWS[1:])))
    out = (runs.groupBy("shard").applyInArrow(_search(buckets, window), dealt).groupBy("bucket")
           .applyInArrow(_per_document(np.int32, np.int32, _joined), "id long, sum long, a binary, b binary"))
    return stage(out, "fm_intervals")


def _cut(batches):
    """Words, removed words, and what is left of each text."""
    for batch in batches:
        n, gone, left = [], [], []
        texts, opened, closed = (batch.column(i).to_pylist() for i in (1, 2, 3))
        for text, a, b in zip(texts, opened, closed):
            words = (text or "").encode().split()
            n.append(len(words))
            if a:
                keep, at = [], 0
                for lo, hi in zip(np.frombuffer(a, np.int32).tolist(), np.frombuffer(b, np.int32).tolist()):
                    keep += words[at:lo]
                    at = hi
                words = keep + words[at:]
            gone.append(n[-1] - len(words))
            left.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([x.decode() for x in left], pa.string())],
            ["id", "n_words", "n_removed", "kept"])


def remove_repeated(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_removed, kept (the words left, one blank between).

    Words are separated by ASCII blanks and compared byte for byte. Windows are judged on
    the input: every copy goes, the first too. A null or empty text has no words; a text
    shorter than a window loses none. Repeated rows are copies of each other. ``key`` is a
    whole number; a null key stays a row. Other columns are not read."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("sum"))
    # A null key is told apart from 0 by the sum.
    rows = rows.select("key", F.coalesce("key", F.lit(0).cast("long")).alias("id"),
                       F.when(F.col("key").isNull(), F.bitwise_not("sum")).otherwise(F.col("sum")).alias("sum"), "text")
    spans = repeated_intervals(rows.select("id", "sum", "text"), window)
    kind = dict(docs.dtypes)[key]
    cut = rows.join(spans, ["id", "sum"], "left").select("key", "text", "a", "b").mapInArrow(
        _cut, "id long, n_words long, n_removed long, kept string")
    return cut.select(F.col("id").cast(kind).alias(key), "n_words", "n_removed", "kept")
