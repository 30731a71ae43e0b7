"""Periodic runs of words, by seeds that are extended along diagonals.

Words that repeat with period q match the words q places on: a stretch of a diagonal
(lag q) of the document laid against itself. A run of smallest period q and length
>= max(24, 3q) holds matched stretches of at least max(24 - q, 2q) words. So for lags up
to 16 every run holds seeds of 16 words, and for lags of k/2 + 1 to k seeds of k words
(k = 32, 64, ...): the k-grams of this least guaranteed overlap are indexed, and pairs of
places in one document that hold the same k-gram are seeds on the diagonal of their lag.

Only neighbouring places of a k-gram need be paired. Within a run of smallest period q <= k
whose length is at least q + k, an occurrence nearer than q would give the run a smaller
period (two periods d < q of a stretch of at least d + q words have their common divisor as
a period). So the pairs are no more than the words, however often a k-gram occurs, and a
stretch with lag q found between neighbours has q as its smallest period.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import textops as T

LEAST = 24      # words of the shortest run
REPEATS = 3     # periods that a run holds at least
SHORT = 16      # seed length for lags up to itself; longer lags take the power of two above them
BATCH_WORDS = 1 << 20


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 0 in order of appearance."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _renamed(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dense numbers of equal values, places sorted by value then place)."""
    order = np.argsort(names, kind="stable")
    new = np.concatenate([[False], names[order][1:] != names[order][:-1]]).astype(np.int64)
    dense = np.empty(len(names), np.int64)
    dense[order] = np.cumsum(new)
    return dense, order


def _seeds(dense: np.ndarray, order: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of neighbouring places of one k-gram, low < lag <= high, by lag and place."""
    lag = order[1:] - order[:-1]
    good = (dense[order[1:]] == dense[order[:-1]]) & (lag > low) & (lag <= high)
    lag, place = lag[good], order[:-1][good]
    by = np.lexsort((place, lag))
    return lag[by], place[by]


def _first_break(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """Going from ``at`` by ``step`` (1 or -1): the first place whose word differs from that ``lag`` further on."""
    width = 64
    while True:
        lo, hi = (at, min(at + width, len(words) - lag)) if step > 0 else (max(at - width + 1, 0), at + 1)
        if hi <= lo:
            return at
        differs = np.flatnonzero(words[lo:hi] != words[lo + lag:hi + lag])
        if len(differs):
            return lo + int(differs[0 if step > 0 else -1])
        at = hi if step > 0 else lo - 1
        width *= 2


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Every run of a document's word numbers as (start, length, period), by start, then period."""
    n, runs = len(words), []
    covered: dict[int, int] = {}  # lag -> end of the furthest stretch already extended on its diagonal
    dense, order, k = words, np.zeros(0, np.int64), 1
    low = 0
    while n >= LEAST and (k < SHORT or n >= REPEATS * (low + 1)):
        while k < max(SHORT, 2 * low):  # names of 2k words from those of k
            if n < 2 * k:
                return sorted(runs, key=lambda r: (r[0], r[2]))
            dense, order = _renamed(dense[:n - 2 * k + 1] * np.int64(n + 1) + dense[k:n - k + 1])
            k *= 2
        lag, place = _seeds(dense, order, low, k)
        # Seeds that follow one another lie on one stretch; one too short for any run is passed over.
        heads = np.flatnonzero(np.concatenate([[True], (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)])) if len(lag) else []
        sizes = np.diff(np.append(heads, len(lag)))
        for h, size in zip(heads, sizes):
            q, i = int(lag[h]), int(place[h])
            if size + k - 1 + q < max(LEAST, REPEATS * q) or covered.get(q, 0) > i:
                continue
            start = _first_break(words, i, q, -1) + 1 if i else 0
            end = _first_break(words, i + k, q, 1)
            covered[q] = end
            if end - start + q >= max(LEAST, REPEATS * q):
                runs.append((start, end - start + q, q))
        low = k
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in runs:  # in order of start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run covers after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def repeated_places(key: str | None, n: int) -> np.ndarray | None:
    """The place whose original word each place takes, where the id's checksum asks for
    a repeated tail; None elsewhere."""
    if key is None or not n:
        return None
    h = zlib.crc32(key.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return np.where(place < a, place, a + (place - a) % p)


def _may_repeat(numbers: list[np.ndarray]) -> np.ndarray:
    """Which documents hold some SHORT words twice: the others have no run of any period.

    All documents' window hashes are sorted at once; equal windows have equal hashes, so
    no run is missed, and a document that a collision lets through is found to have none."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in numbers])])
    if not first[-1]:
        return np.zeros(len(numbers), bool)
    owner = np.repeat(np.arange(len(numbers)), np.diff(first)).astype(np.uint64)
    hashes = T.windows(T.mix(np.concatenate(numbers).astype(np.uint64) + np.uint64(1)), SHORT)
    ok = T.within_text(first, SHORT)[:len(hashes)]
    owner = owner[:len(hashes)][ok]
    mixed = T.mix(hashes[ok] + owner * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(mixed)
    twice = np.flatnonzero(mixed[order][1:] == mixed[order][:-1])
    out = np.zeros(len(numbers), bool)
    out[owner[order[twice]].astype(np.int64)] = True
    return out


FIELDS = ["key", "n_words", "starts", "lengths", "periods", "text"]


def _documents(repeat_tails: bool):
    def emit(keys, words, numbers):
        rows = [[] for _ in FIELDS]
        for key, w, x, able in zip(keys, words, numbers, _may_repeat(numbers)):
            runs = find_runs(x) if able else []
            if runs:
                w = [w[i] for i in np.flatnonzero(collapsed(len(x), runs)).tolist()]
            for column, v in zip(rows, (key, len(x), [r[0] for r in runs], [r[1] for r in runs], [r[2] for r in runs],
                                        b" ".join(w).decode())):
                column.append(v)
        longs = pa.list_(pa.int64())
        kinds = [None, pa.int64(), longs, longs, longs, pa.string()]
        keys = pa.concat_arrays(rows[0]) if rows[0] else None
        return pa.RecordBatch.from_arrays([keys] + [pa.array(c, k) for c, k in zip(rows[1:], kinds[1:])], FIELDS)

    def run(batches):
        for batch in batches:
            held = [[], [], []]
            size = 0
            ids, names, texts = batch.column(0), batch.column(1), batch.column(2)
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                numbers = word_numbers(words)
                place = repeated_places(names[i].as_py(), len(words)) if repeat_tails else None
                if place is not None:
                    words, numbers = [words[j] for j in place.tolist()], numbers[place]
                for column, v in zip(held, (ids.slice(i, 1), words, numbers)):
                    column.append(v)
                size += len(words)
                if size >= BATCH_WORDS:
                    yield emit(*held)
                    held, size = [[], [], []], 0
            if held[0]:
                yield emit(*held)
    return run


def periodic_runs(docs: DataFrame, repeat_tails: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, runs (start, length, period by start, then
    period), text (the words left, one blank between).

    A run is a stretch of words between ASCII blanks, compared byte for byte, with smallest
    period q and at least ``LEAST`` words and ``REPEATS`` periods, that no neighbouring word
    extends; runs may overlap. The text loses every word that some run covers after its
    first period. With ``repeat_tails`` each document whose id's crc32 is divisible by 10 is
    read with its tail repeated (``repeated_places``); a null id never is. A null or empty
    text has no words and no run. Each row is worked on by itself in one pass, whole texts
    of any length, without a shuffle: repeated rows stay rows of their own, an empty table
    gives an empty result, other columns are not read."""
    rows = docs.select(F.col(key).alias("key"), F.col(key).cast("string").alias("name"), F.col(text).alias("text"))
    longs = ", ".join(f"{c} array<long>" for c in FIELDS[2:5])
    out = rows.mapInArrow(_documents(repeat_tails), f"key {dict(rows.dtypes)['key']}, n_words long, {longs}, text string")
    return out.select(F.col("key").alias(key), "n_words", F.arrays_zip(
        F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period")).alias("runs"), "text")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_runs, the strongest run (start, length, period, exponent_milli), and hashes of
    all runs and of the words left, by column functions on ``periodic_runs``."""
    def stronger(best, run):
        # Cross products compare length / period exactly (a text has under 2**30 words); earlier runs win ties.
        more = best.isNull() | (run.length * best.period > best.length * run.period)
        return F.when(more, run).otherwise(best)
    kind = dict(found.select(F.element_at("runs", 1).alias("r")).dtypes)["r"]
    best = F.aggregate("runs", F.lit(None).cast(kind), stronger)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n"))))
    rows = found.select(key, F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "text")
    return rows.select(
        key, "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
