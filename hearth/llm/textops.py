"""Words and their hashes in Arrow text columns, by numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
PIECE = 1 << 20  # bytes hashed at once: working arrays stay within a few tens of MB
_MULT = 0x9E3779B97F4A7C15


class _Kept:
    """What one process computed once. A function that travels to a worker by value
    takes this module's objects along, but not what is kept here."""

    def __init__(self):
        self.arrays: tuple[np.ndarray, ...] = ()

    def __reduce__(self):
        return type(self), ()


_POWERS = _Kept()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the odd multiplier and of its inverse, modulo 2**64."""
    if not _POWERS.arrays or len(_POWERS.arrays[0]) < n:
        def run(base):
            p = np.full(max(n, PIECE + 1), base, np.uint64)
            p[0] = 1
            return np.cumprod(p, dtype=np.uint64)
        _POWERS.arrays = (run(_MULT), run(pow(_MULT, -1, 1 << 64)))
    return _POWERS.arrays


def text_batches(column: pa.Array, max_bytes: int = 8 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of slices of about ``max_bytes``; null is ''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + max_bytes, "right")) - 1)
        yield lo, hi, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().lower(), np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte bounds of the words, and each text's first word."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = SPACES[data]
    solid = ~space
    start, end = solid.copy(), solid.copy()
    start[1:] &= space[:-1]
    end[:-1] &= space[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    start[heads] = solid[heads]
    end[tails] = solid[tails]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span (ascending, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        piece = data[base:int(ends[j - 1])]
        power, inverse = _powers(len(piece))
        v = _BYTE[piece]
        v *= power[:len(piece)]
        a, b = starts[i:j] - base, ends[i:j] - base
        firsts = v[a]
        np.cumsum(v, out=v)
        h = v[b - 1] - v[a] + firsts
        h *= inverse[a]
        h += (b - a).astype(np.uint64)
        out[i:j] = mix(h)
        i = j
    return out


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, each text's first word)."""
    starts, ends, first = word_bounds(data, offsets)
    return hash_spans(data, starts, ends), first


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive word hashes (across texts too)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = pow(_MULT, k, 1 << 64)
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += hashes[j:j + n] * np.uint64(pow(power + 2 * j, 3, 1 << 64) | 1)
    return mix(total)


def within_text(first: np.ndarray, k: int) -> np.ndarray:
    """True for the word positions whose ``k``-word window ends in the same text."""
    ok = np.ones(int(first[-1]), bool)
    heads, tails = first[:-1], first[1:]
    full = tails > heads
    for j in range(1, k):
        ok[np.maximum(tails[full] - j, heads[full])] = False
    short = full & (tails - heads < k)
    for a, b in zip(heads[short], tails[short]):
        ok[a:b] = False
    if k > 1:
        exact = full & (tails - heads >= k)
        ok[heads[exact]] = True
    return ok


def shingle_sets(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): each text's distinct ``k``-word shingles in ascending order;
    a text of fewer words has its whole sequence as the one shingle, an empty text none."""
    words = np.diff(first)
    short = (words > 0) & (words < k)
    counts = np.where(words >= k, words - k + 1, short.astype(np.int64))
    at = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(at[-1]), np.uint64)
    regular = np.ones(len(out), bool)
    regular[at[:-1][short]] = False
    if regular.any():
        out[regular] = windows(hashes, k)[np.flatnonzero(within_text(first, k))]
    for d in np.flatnonzero(short):
        part = hashes[first[d]:first[d + 1]]
        out[at[d]] = windows(part, len(part))[0]
    sets = [np.unique(out[a:b]) for a, b in zip(at[:-1], at[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else out), np.concatenate([[0], np.cumsum(sizes)])


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpack(parts, dtype) -> np.ndarray:
    """One array of all packed values of an Arrow binary column."""
    return np.frombuffer(b"".join(parts.to_pylist()), dtype)


def split_packed(group: np.ndarray, groups: int, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each group that has any, in their order."""
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(groups + 1))
    sorted_columns = [c[order] for c in columns]
    for g in np.flatnonzero(np.diff(cuts)):
        yield int(g), [c[cuts[g]:cuts[g + 1]] for c in sorted_columns]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of the 64-bit order a hash lies in."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
