"""LM scoring with a probabilistic suffix tree.

The text is read as symbols: the lower-cased bytes of its words, a blank after
each word and an end mark. The tree holds contexts of up to ``DEPTH`` symbols.
A longer context is retained only where its next-symbol distribution diverges
from that of its suffix, and it stands LEAST times in the training texts, whatever
their size; distributions are smoothed towards the suffix's. A text is scored symbol
by symbol from the longest retained context, so the product is the probability of
its words and end.

The tree grows with the corpus and is a staged table. Its commonest contexts, a bounded
number, travel with the scoring function as a cache; a position that goes on into the
rest of the tree is sent to the part of the tree that holds its context. What the cache
holds decides where a position is scored, never its probability.

Beside it, an add-half word model over all training words is the base score.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm import textops as T
from hearth.session import stage

DEPTH = 6                # symbols of the longest context
BITS, SYMBOLS = 6, 64
END, BLANK, OTHER = 0, 1, 2
LEAST = 4                # times a context stands in the training texts
CACHE_SHARE = 4e-6       # retained contexts of at least this share of all positions are cached with the
#                          scoring function: at most DEPTH / CACHE_SHARE of them, whatever the corpus
MARGIN = 2.0             # nats of divergence asked for beyond the penalty for a context's parameters
PER_FRAGMENT = 2_000_000  # (document, word) entries or n-gram counts one fragment task holds
WORD_SHARE = 1e-5        # words of at least this share of all training words are counted before and cached:
#                          at most 1 / WORD_SHARE of them
PAIRS = SYMBOLS * SYMBOLS  # the two nearest symbols of a context decide its part of the tree
PER_PART = 64_000_000    # positions whose n-grams one part of the tree counts, on average
PER_SLICE = 16_000_000   # positions of one group of parts that one task may have to score
BLOCK_TEXTS, BLOCK_ENTRIES = 30_000, 1_000_000  # of a block of neighbouring texts sent on together
DOCS_PER_BUCKET = 50_000


# ---- symbols --------------------------------------------------------------

def alphabet(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each byte, log10 probability of the byte given its symbol)."""
    symbol = np.full(256, OTHER, np.uint8)
    order = [b for b in np.argsort(-counts, kind="stable") if counts[b] > 0 and not T.SPACES[b]][:SYMBOLS - 3]
    symbol[order] = np.arange(3, 3 + len(order))
    rest = symbol == OTHER
    share = np.zeros(256)
    share[rest] = np.log10((counts[rest] + 0.5) / (counts[rest] + 0.5).sum())
    return symbol, share


def symbol_stream(data, starts, ends, first, symbol):
    """(symbols, heads, bytes): DEPTH end marks, the words each with a blank, an end mark, for
    every text in turn; ``heads`` bounds the texts, ``bytes`` has the source byte (0: none)."""
    words = np.diff(first)
    size = ends - starts
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    source = data[np.repeat(starts, size) + inner]
    word_of = np.repeat(np.arange(len(size)), size)
    text_of = np.repeat(np.arange(len(words)), words)[word_of]
    at = np.arange(len(source)) + word_of + (text_of + 1) * DEPTH + text_of
    per_text = np.bincount(text_of, minlength=len(words)) + words + DEPTH + 1
    heads = np.concatenate([[0], np.cumsum(per_text)])
    raw = np.zeros(int(heads[-1]), np.uint8)
    out = np.zeros(int(heads[-1]), np.uint8)
    raw[at] = source
    out[at] = symbol[source]
    if len(size):
        out[at[np.cumsum(size) - 1] + 1] = BLANK
    return out, heads, raw


def contexts(symbols: np.ndarray) -> np.ndarray:
    """For positions DEPTH..: the DEPTH symbols before, the nearest in the lowest bits."""
    n = len(symbols) - DEPTH
    code = np.zeros(n, np.int64)
    for back in range(DEPTH, 0, -1):
        code = code << BITS | symbols[DEPTH - back:DEPTH - back + n]
    return code


def predicted(heads: np.ndarray) -> np.ndarray:
    """Marks the positions from DEPTH on that a model predicts: all but the end marks before a text."""
    ok = np.ones(max(int(heads[-1]) - DEPTH, 0), bool)
    for j in range(DEPTH):
        at = heads[1:-1] + j - DEPTH
        ok[at] = False
    return ok


# ---- counting -------------------------------------------------------------

def _texts(batch, column, max_bytes=1 << 20):
    for lo, hi, data, offsets in T.text_batches(batch.column(column), max_bytes):
        data = T.lower_ascii(data)
        yield lo, hi, data, *T.word_bounds(data, offsets)


def _first_counts(batches):
    """Of a partition: its byte counts, words and texts in one row; one row for each distinct word."""
    counts, words, docs, held, size = np.zeros(256, np.int64), 0, 0, [], 0
    total = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows(word, n):
        for i in range(0, len(word), 100_000):
            w = pa.array(word[i:i + 100_000].view(np.int64))
            none = pa.nulls(len(w), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(w), pa.list_(pa.int64())), none, none, w, pa.array(n[i:i + 100_000])], COUNT_ROWS)

    for batch in batches:
        for lo, hi, data, starts, ends, first in _texts(batch, 0):
            counts += np.bincount(data, minlength=256)
            words, docs = words + int(first[-1]), docs + hi - lo
            held.append(T.hash_spans(data, starts, ends))
            size += len(starts)
            if size >= BLOCK_ENTRIES:
                total = _merge(*(np.concatenate(x) for x in zip(total, np.unique(np.concatenate(held), return_counts=True))))
                held, size = [], 0
            if len(total[0]) >= PER_FRAGMENT:
                yield from rows(*total)
                total = total[0][:0], total[1][:0]
    if held:
        total = _merge(*(np.concatenate(x) for x in zip(total, np.unique(np.concatenate(held), return_counts=True))))
    yield from rows(*total)
    yield pa.RecordBatch.from_arrays([pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([words], pa.int64()), pa.array([docs], pa.int64()),
                                      pa.array([None], pa.int64()), pa.array([None], pa.int64())], COUNT_ROWS)


COUNT_ROWS = ["bytes", "words", "docs", "word", "n"]


def _merge(codes, counts):
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, int)
    return codes[heads], (np.add.reduceat(counts, heads) if len(heads) else counts)


def part_of_pair(parts: int) -> np.ndarray:
    """The part of each pair of nearest symbols."""
    return np.arange(PAIRS) * 2654435761 % (1 << 32) * parts >> 32


def _ngram_counts(symbol, parts, block=500_000):
    """(part, codes, counts): n-gram counts of a partition, dealt by the two nearest context symbols.
    Sent in batches of about ``block`` counts, so that neither side holds all of a partition's as one batch."""
    part = part_of_pair(parts)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array([r[2] for r in rows], pa.binary())], ["part", "codes", "counts"])

    def packed(codes, counts):
        rows, size = [], 0
        for g, (c, k) in T.split_packed(part[(codes >> BITS) & (PAIRS - 1)], parts, codes, counts):
            rows.append((g, T.pack(c), T.pack(k)))
            size += len(c)
            if size >= block:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def run(batches):
        held, size, done = [], 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            for _, _, data, starts, ends, first in _texts(batch, 0):
                symbols, heads, _ = symbol_stream(data, starts, ends, first, symbol)
                code = (contexts(symbols) << BITS | symbols[DEPTH:])[predicted(heads)]
                held.append(code)
                size += len(code)
                if size >= block:
                    new = np.unique(np.concatenate(held), return_counts=True)
                    done = _merge(np.concatenate([done[0], new[0]]), np.concatenate([done[1], new[1]]))
                    held, size = [], 0
                if len(done[0]) >= PER_FRAGMENT:
                    yield from packed(*done)
                    done = (done[0][:0], done[1][:0])
        if held:
            new = np.unique(np.concatenate(held), return_counts=True)
            done = _merge(np.concatenate([done[0], new[0]]), np.concatenate([done[1], new[1]]))
        if len(done[0]):
            yield from packed(*done)
    return run


# ---- the tree -------------------------------------------------------------

def _level(codes, counts, depth):
    """(context, next, count) of contexts of ``depth`` symbols."""
    code, count = _merge(codes & ((1 << BITS * (depth + 1)) - 1), counts)
    return code >> BITS, code & (SYMBOLS - 1), count


def _totals(context, count):
    heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, int)
    return context[heads], np.add.reduceat(count, heads) if len(heads) else count[:0], heads


GRAM, BEYOND, SUBTREE = 0, 1, 2  # kinds of rows of the staged tree
TREE_ROWS = ("kind int, depth int, context long, symbol int, count long, kept boolean, part int, "
             "grams binary, counts binary")


def _kinds(context, heads):
    return np.diff(np.append(heads, len(context)))


def _sub_tree(codes, counts):
    """{depth: (context, symbol, count, names, totals, heads, kept names)} of a part: contexts of two
    symbols or more that stand LEAST times, and diverge from their suffix or lead to one that does."""
    levels, keep = {}, {}
    for depth in range(2, DEPTH + 1):
        context, symbol, count = _level(codes, counts, depth)
        names, totals, heads = _totals(context, count)
        levels[depth] = context, symbol, count, names, totals, heads
        if depth == 2:
            keep[depth] = totals >= LEAST
            continue
        p_context, p_symbol, p_count, p_names, p_totals, _ = levels[depth - 1]
        suffix = context & ((1 << BITS * (depth - 1)) - 1)
        at = np.searchsorted(p_context << BITS | p_symbol, suffix << BITS | symbol)
        kinds = _kinds(context, heads)
        own = np.repeat(totals, kinds)
        parent = p_totals[np.searchsorted(p_names, suffix)]
        gain = np.add.reduceat(count * np.log(count / own * (parent / p_count[at])), heads) if len(heads) else count[:0]
        keep[depth] = (totals >= LEAST) & (gain > (kinds - 1) * np.log(np.maximum(totals, 2)) / 2 + MARGIN)
    for depth in range(DEPTH, 2, -1):  # every suffix of a retained context is retained
        names = levels[depth][3][keep[depth]] & ((1 << BITS * (depth - 1)) - 1)
        keep[depth - 1] |= np.isin(levels[depth - 1][3], names)
    return {depth: (*level, keep[depth]) for depth, level in levels.items()}


def _tree_rows(positions, cache_share):
    """The staged rows of a part: the n-grams of its cached contexts (and of all of two symbols, for the
    levels above), the cached contexts that lead beyond the cache, and, packed, all it retains."""
    def run(key, table):
        tree = _sub_tree(*_merge(T.unpack(table.column("codes"), np.int64), T.unpack(table.column("counts"), np.int64)))
        rows, packs, cached = [], [], None
        for depth, (context, symbol, count, names, totals, heads, keep) in tree.items():
            kinds = _kinds(context, heads)
            cache = keep & (totals >= positions * cache_share)
            mask = np.repeat(cache | (depth == 2), kinds)
            n = int(mask.sum())
            rows.append((np.full(n, GRAM), np.full(n, depth), context[mask], symbol[mask], count[mask], np.repeat(cache, kinds)[mask]))
            more = names[keep & ~cache]
            above, far = more & ((1 << BITS * (depth - 1)) - 1), more >> BITS * (depth - 1)
            if cached is not None:
                inside = np.isin(above, cached)
                above, far = above[inside], far[inside]
            n = len(above)
            rows.append((np.full(n, BEYOND), np.full(n, depth - 1), above, far, np.zeros(n, np.int64), np.zeros(n, bool)))
            cached = names[cache]
            kept = np.repeat(keep, kinds)
            packs.append((depth, T.pack(context[kept] << BITS | symbol[kept]), T.pack(count[kept])))
        columns = [np.concatenate(x) for x in zip(*rows)]
        n, m, part = len(columns[0]), len(packs), key[0].as_py()
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
        tail = [[SUBTREE] * m, [d for d, _, _ in packs], [None] * m, [None] * m, [None] * m, [None] * m]
        arrays = [pa.concat_arrays([pa.array(c).cast(t), pa.array(x, t)]) for c, t, x in zip(columns, types, tail)]
        arrays.append(pa.array([part] * (n + m), pa.int32()))
        arrays += [pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([p[i] for p in packs], pa.binary())]) for i in (1, 2)]
        return pa.table(arrays, names=["kind", "depth", "context", "symbol", "count", "kept", "part", "grams", "counts"])
    return run


def deep_probability(first, levels):
    """codes -> probability of their last symbol, from the longest context of ``levels`` ({depth:
    (grams in order, counts)}); ``first`` has the probabilities after one symbol."""
    ready = {}
    for depth, (grams, counts) in levels.items():
        names, totals, heads = _totals(grams >> BITS, counts)
        ready[depth] = grams, counts, names, totals, _kinds(grams, heads)

    def find(sorted_values, wanted):
        at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
        return at, sorted_values[at] == wanted

    def run(codes):
        context, symbol = codes >> BITS, codes & (SYMBOLS - 1)
        p = first[context & (SYMBOLS - 1), symbol]
        alive = np.arange(len(codes))
        for depth in sorted(ready):
            grams, counts, names, totals, kinds = ready[depth]
            if not len(names) or not len(alive):
                break
            name = context[alive] & ((1 << BITS * depth) - 1)
            at, ok = find(names, name)
            alive, name, at = alive[ok], name[ok], at[ok]
            gram, seen = find(grams, name << BITS | symbol[alive])
            p[alive] = (np.where(seen, counts[gram], 0) + kinds[at] * p[alive]) / (totals[at] + kinds[at])
        return p
    return run


class SuffixTree:
    """Retained contexts as a trie over the symbols before a position, nearest first. ``beyond``
    (depth, context, symbol before it) names retained contexts that lie outside this trie."""

    def __init__(self, depth, context, symbol, count, kept, beyond=None):
        # Counts of no and one symbol of context are sums of those of two.
        two = depth == 2
        rows = [(0, *_level((context[two] << BITS) | symbol[two], count[two], 0)),
                (1, *_level((context[two] << BITS) | symbol[two], count[two], 1))]
        rows += [(d, *(x[(depth == d) & kept] for x in (context, symbol, count))) for d in range(2, DEPTH + 1)]
        self.child = [np.zeros((1, SYMBOLS), np.int32)]
        log = np.full((1, SYMBOLS), 1 / SYMBOLS)
        known, tables = {}, []
        size = 0
        for d, c, s, n in rows:
            order = np.lexsort((s, c))
            c, s, n = c[order], s[order], n[order]
            names, totals, heads = _totals(c, n)
            if d == 0 and not len(names):
                names, totals = np.zeros(1, np.int64), np.zeros(1, np.int64)
            node = size + np.arange(len(names))
            if d == 0:
                above = np.repeat(log, len(names), 0)
            else:
                parents, first = known[d - 1]
                up = first + np.searchsorted(parents, names & ((1 << BITS * (d - 1)) - 1))
                above = np.concatenate(tables)[up]
            seen = np.zeros((len(names), SYMBOLS))
            if len(c):
                seen[np.searchsorted(names, c), s] = n
            strength = np.maximum((seen > 0).sum(1, keepdims=True), 1)
            tables.append((seen + strength * above) / (totals[:, None] + strength))
            if d:
                self.child.append(np.zeros((len(names), SYMBOLS), np.int32))
                flat = np.concatenate(self.child)
                flat[up, names >> BITS * (d - 1)] = node
                self.child = [flat]
            known[d] = names, size
            size += len(names)
        for d, c, s in zip(*beyond) if beyond is not None else ():
            names, first = known[d]
            self.child[0][first + np.searchsorted(names, c), s] = -1
        self.child = self.child[0][:size].ravel()
        self.log = np.log10(np.concatenate(tables)).astype(np.float32).ravel()
        self.first = np.full((SYMBOLS, SYMBOLS), 1 / SYMBOLS)
        self.first[known[1][0]] = tables[1]

    def log10(self, symbols: np.ndarray) -> np.ndarray:
        return self.score(symbols)[0]

    def score(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability of each symbol from position DEPTH on, from its longest context in this
        trie; the places among them whose context goes on outside it)."""
        n = len(symbols) - DEPTH
        node = np.zeros(n, np.int32)
        out = np.empty(n, np.float32)
        alive = np.arange(n)
        wide = symbols.astype(np.int32)
        here, outside = node, []
        for back in range(1, DEPTH + 1):
            step = self.child[here * SYMBOLS + wide[DEPTH - back + alive]]
            outside.append(alive[step < 0])
            go = step > 0
            alive, here = alive[go], step[go]
            node[alive] = here
        np.take(self.log, node * SYMBOLS + wide[DEPTH:], out=out)
        return out, np.sort(np.concatenate(outside))


class Model(NamedTuple):
    tree: SuffixTree        # the cached top
    sub_trees: DataFrame    # (part, depth, grams, counts): all that is retained
    parts: int
    after_pair: np.ndarray  # training positions after each pair of symbols
    symbol: np.ndarray
    share: np.ndarray
    words: int
    docs: int
    common: np.ndarray      # hashes of the cached words, in order
    times: np.ndarray       # their counts


def learn(train: DataFrame, text: str = "text", cache_share: float = CACHE_SHARE, word_share: float = WORD_SHARE) -> Model:
    """The driver receives the counts of at most DEPTH / cache_share contexts, of the pairs of symbols
    and of at most 1 / word_share words."""
    texts = train.select(F.col(text).alias("text"))
    rows = stage(texts.mapInArrow(_first_counts, "bytes array<long>, words long, docs long, word long, n long"), "lm_words")
    first = rows.where(F.col("word").isNull()).agg(F.sum("words").alias("w"), F.sum("docs").alias("d"),
                     *[F.sum(F.col("bytes")[b]).alias(f"b{b}") for b in range(256)]).first()
    counts = np.array([first[f"b{b}"] or 0 for b in range(256)], np.int64)
    words, docs = int(first["w"] or 0), int(first["d"] or 0)
    symbol, share = alphabet(counts)
    positions = int(counts[~T.SPACES].sum()) + words + docs
    common = (rows.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= max(words * word_share, 1)).toArrow())
    hashes = common.column("word").to_numpy().astype(np.int64).view(np.uint64)
    by_hash = np.argsort(hashes)
    parts = min(PAIRS, max(64, math.ceil(positions / PER_PART)))
    rows = (texts.mapInArrow(_ngram_counts(symbol, parts), "part int, codes binary, counts binary").groupBy("part")
            .applyInArrow(_tree_rows(positions, cache_share), TREE_ROWS))
    tree = stage(rows, "lm_tree")
    got = tree.where(F.col("kind") == GRAM).select("depth", "context", "symbol", "count", "kept").toArrow()
    depth, context, after, count, kept = (got.column(c).to_numpy() for c in ("depth", "context", "symbol", "count", "kept"))
    # One row for each pair of a cached context and a symbol before it, at most.
    far = tree.where(F.col("kind") == BEYOND).select("depth", "context", "symbol").distinct().toArrow()
    beyond = [far.column(c).to_numpy() for c in ("depth", "context", "symbol")]
    pairs = np.bincount(context[depth == 2], weights=count[depth == 2], minlength=PAIRS)
    sub_trees = tree.where(F.col("kind") == SUBTREE).select("part", "depth", "grams", "counts")
    return Model(SuffixTree(depth, context, after, count, kept, beyond), sub_trees, parts, pairs, symbol, share, words, docs,
                 hashes[by_hash], common.column("n").to_numpy().astype(np.int64)[by_hash])


# ---- scoring --------------------------------------------------------------
#
# A block is some neighbouring texts of a partition; a text is named by its block and its place
# there. Rows of three kinds meet in the fragments: the words of a block, the positions of a block
# whose context lies outside the cache, and the part of the tree that holds such contexts.

WORDS, PLACES, TREE = 0, 1, 2
INFO = ["doc_ids", "nulls", "held", "words", "scores", "bases", "knowns"]
INFO_TYPES = [np.int64, np.uint8, np.uint8, np.int64, np.float64, np.float64, np.int64]
HELD = 1 << 15
WORD_ROWS = ["frag", "kind", "block", "values", "lens", "owners", "times", *[f"i_{c}" for c in INFO]]
SUM_ROWS = ["bucket", "block", "owners", "base", "known", "score", "vocab", *[f"i_{c}" for c in INFO]]


def planes(x: np.ndarray) -> bytes:
    """Packed byte by byte, all lowest bytes first: small numbers compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _grouped(values, owners):
    """(distinct values, number of their owners, owners, times) of entries, owners in order for each value."""
    order = np.argsort(values, kind="stable")  # entries come in the order of their owners
    v, o = values[order], owners[order]
    if not len(v):
        return v, np.zeros(0, np.uint32), o.astype(np.uint16), np.zeros(0, np.uint32)
    new = np.concatenate([[True], v[1:] != v[:-1]])
    heads = np.flatnonzero(new | np.concatenate([[True], o[1:] != o[:-1]]))
    first = np.flatnonzero(new[heads])
    return (v[heads][first], np.diff(np.append(first, len(heads))).astype(np.uint32), o[heads].astype(np.uint16),
            np.diff(np.append(heads, len(v))).astype(np.uint32))


class Slots(NamedTuple):
    """Which fragments score the positions of which parts of the tree. Parts form groups; a group
    with very many positions is cut into slices by block."""
    group_of_pair: np.ndarray
    slices: np.ndarray
    offset: np.ndarray

    def of(self, block):
        return self.offset + (int(T.mix(np.array([block], np.uint64))[0]) >> 1) % self.slices


def slots(model: Model, first: int) -> tuple[Slots, int]:
    groups = min(model.parts, max(32, model.parts // 16))
    group_of_pair = part_of_pair(model.parts) % groups
    load = np.bincount(group_of_pair, weights=model.after_pair, minlength=groups)
    slices = 1 + (load // PER_SLICE).astype(np.int64)
    return Slots(group_of_pair, slices, first + np.cumsum(slices) - slices), groups


def _blank(**cells):
    return [cells.get(c) for c in WORD_ROWS]


def _word_batch(rows):
    kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * (len(WORD_ROWS) - 3)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], WORD_ROWS)


def _scored(tree, symbol, share, common, times, fragments, places):
    """Scores each text as far as the caches go. Deals the other words of a block to the words' fragments
    and the positions that go on outside the cache to their part of the tree. What is known of the
    texts travels with fragment 0."""
    def rows_of(block, hashes, owners, codes, at, info):
        held = info[2]
        values, lens, who, times = _grouped(hashes, owners)
        who = who | np.where(held[who] > 0, np.uint16(HELD), np.uint16(0))
        part = T.part_of(values, fragments)
        cut, ends = np.searchsorted(part, np.arange(fragments + 1)), np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        for g in range(fragments):
            lo, hi = cut[g], cut[g + 1]
            if lo < hi or g == 0:
                x = slice(ends[lo], ends[hi])
                extra = {f"i_{c}": T.pack(v) for c, v in zip(INFO, info)} if g == 0 else {}
                yield _blank(frag=g, kind=WORDS, block=block, values=T.pack(values[lo:hi]), lens=planes(lens[lo:hi]),
                             owners=planes(who[x]), times=planes(times[x]), **extra)
        slot = places.of(block)
        values, lens, who, times = _grouped(codes, at)
        ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        group = places.group_of_pair[(values >> BITS) & (PAIRS - 1)]
        for g, (index, size) in T.split_packed(group, len(places.slices), np.arange(len(values)), lens):
            before = np.cumsum(size, dtype=np.int64) - size
            mine = np.repeat(ends[index] - before, size) + np.arange(int(size.sum()))
            yield _blank(frag=int(slot[g]), kind=PLACES, block=block, values=planes(np.diff(values[index], prepend=0)),
                         lens=planes(size), owners=planes(who[mine]), times=planes(times[mine]))

    log = np.log10(times + 0.5)

    def run(batches):
        key = TaskContext.get().partitionId() << 36
        block, held_back, size = key, [], 0

        def flush():
            cells = [np.concatenate(x) for x in zip(*held_back)]
            rows = list(rows_of(block, *cells[:4], cells[4:]))
            for i in range(0, len(rows), 64):
                yield _word_batch(rows[i:i + 64])

        for batch in (b.slice(i, BLOCK_TEXTS // 3) for b in batches for i in range(0, b.num_rows, BLOCK_TEXTS // 3)):
            for lo, hi, data, starts, ends, first in _texts(batch, 2):
                if held_back and (size >= BLOCK_ENTRIES or key - block + hi - lo > BLOCK_TEXTS):
                    yield from flush()
                    block, held_back, size = key, [], 0
                symbols, heads, raw = symbol_stream(data, starts, ends, first, symbol)
                value, outside = tree.score(symbols)
                ok = predicted(heads)
                outside = outside[ok[outside]]
                value = value.astype(np.float64)
                value[outside] = 0
                value += np.where(symbols[DEPTH:] == OTHER, share[raw[DEPTH:]], 0)
                value *= ok
                sums = np.add.reduceat(np.append(value, 0.0), heads[:-1])
                words = np.diff(first)
                owner = np.repeat(np.arange(hi - lo), words)
                hashes = T.hash_spans(data, starts, ends)
                place = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
                cached = common[place] == hashes if len(common) else np.zeros(len(hashes), bool)
                base = np.bincount(owner[cached], weights=log[place[cached]], minlength=hi - lo)
                known = np.bincount(owner[cached], minlength=hi - lo)
                hashes, owner = hashes[~cached], owner[~cached] + (key - block)
                codes = np.zeros(len(outside), np.int64)
                for back in range(DEPTH, -1, -1):
                    codes = codes << BITS | symbols[outside + DEPTH - back]
                at = np.searchsorted(heads, outside, "right") - 1 + (key - block)
                ids = batch.column(0).slice(lo, hi - lo)
                held = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.uint8)
                held_back.append((hashes, owner, codes, at, ids.fill_null(0).to_numpy().astype(np.int64),
                                  ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), held, words.astype(np.int64), sums, base, known))
                key += hi - lo
                size += len(owner) + len(outside)
        if held_back:
            yield from flush()
    return run


def _dealt_tree(places, groups):
    """Each part of the tree, for each slice of its group."""
    def run(batches):
        for batch in batches:
            rows = []
            for part, depth, grams, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "depth", "grams", "counts"))):
                g = part % groups
                rows += [_blank(frag=int(places.offset[g]) + i, kind=TREE, block=depth, values=grams, lens=counts)
                         for i in range(int(places.slices[g]))]
            if rows:
                yield _word_batch(rows)
    return run


def _sum_row(buckets, block, **cells):
    cells |= {"block": block, "bucket": int(T.mix(np.array([block], np.uint64))[0] % buckets)}
    return [cells.get(c) for c in SUM_ROWS]


def _word_sums(rows, buckets):
    """Each word's training count, and every text's sum over its words here."""
    decoded = [(r["block"], np.frombuffer(r["values"], np.uint64), from_planes(r["lens"], np.uint32),
                from_planes(r["owners"], np.uint16), from_planes(r["times"], np.uint32).astype(np.int64)) for r in rows]
    _, name = np.unique(np.concatenate([d[1] for d in decoded]), return_inverse=True)
    cuts = np.cumsum([0] + [len(d[1]) for d in decoded])
    count = np.zeros(int(name.max()) + 1 if len(name) else 0, np.int64)
    for (_, _, lens, owners, times), lo, hi in zip(decoded, cuts, cuts[1:]):
        taught = times * (owners < HELD)
        count += np.bincount(np.repeat(name[lo:hi], lens), weights=taught, minlength=len(count)).astype(np.int64)
    log = np.log10(count + 0.5)
    for i, (row, (block, _, lens, owners, times), lo, hi) in enumerate(zip(rows, decoded, cuts, cuts[1:])):
        word, owners = np.repeat(name[lo:hi], lens), owners & (HELD - 1)
        who, of = np.unique(owners, return_inverse=True)
        yield _sum_row(buckets, block, owners=planes(who), base=T.pack(np.bincount(of, weights=times * log[word], minlength=len(who))),
                       known=planes(np.bincount(of, weights=times * (count[word] > 0), minlength=len(who)).astype(np.int64)),
                       vocab=int((count > 0).sum()) if i == 0 else 0, **{f"i_{c}": row[f"i_{c}"] for c in INFO})


def _place_sums(first, rows, buckets):
    """Every text's sum over its positions here, from this part of the tree."""
    levels = {}
    for r in rows:
        if r["kind"] == TREE:
            levels.setdefault(r["block"], []).append((np.frombuffer(r["values"], np.int64), np.frombuffer(r["lens"], np.int64)))
    probability = deep_probability(first, {d: _merge(*(np.concatenate(x) for x in zip(*v))) for d, v in levels.items()})
    for r in rows:
        if r["kind"] == PLACES:
            value = np.log10(probability(np.cumsum(from_planes(r["values"], np.int64))))
            owners, times = from_planes(r["owners"], np.uint16), from_planes(r["times"], np.uint32)
            who, of = np.unique(owners, return_inverse=True)
            each = np.repeat(value, from_planes(r["lens"], np.uint32)) * times
            yield _sum_row(buckets, r["block"], owners=planes(who), score=T.pack(np.bincount(of, weights=each, minlength=len(who))))


def _fragment_sums(first, fragments, buckets):
    def run(key, table):
        rows = table.to_pylist()
        out = list(_word_sums(rows, buckets) if key[0].as_py() < fragments else _place_sums(first, rows, buckets))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.int64(), *[pa.binary()] * len(INFO)]
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=SUM_ROWS)
    return run


def _text_rows(table):
    """In one bucket of blocks: one row for each text, and one with the vocabulary's share."""
    rows = table.to_pylist()
    texts = {r["block"]: [np.frombuffer(r[f"i_{c}"], t) for c, t in zip(INFO, INFO_TYPES)] for r in rows if r["i_words"] is not None}
    sums = {b: [i[5].copy(), i[6].copy(), i[4].copy()] for b, i in texts.items()}
    for r in rows:
        who, (base, known, score) = from_planes(r["owners"], np.uint16), sums[r["block"]]
        if r["score"] is None:
            base[who] += np.frombuffer(r["base"], np.float64)
            known[who] += from_planes(r["known"], np.int64)
        else:
            score[who] += np.frombuffer(r["score"], np.float64)
    n, vocab = sum(len(i[0]) for i in texts.values()), sum(r["vocab"] or 0 for r in rows)
    join = lambda parts, dtype: np.concatenate([np.zeros(0, dtype), *parts])
    info = [join([i[k] for i in texts.values()], t) for k, t in enumerate(INFO_TYPES)]
    base, known, score = (join([s[k] for s in sums.values()], t) for k, t in enumerate((np.float64, np.int64, np.float64)))
    pad = lambda x, kind: pa.concat_arrays([pa.array(x).cast(kind), pa.nulls(1, kind)])
    return pa.table({"id": pa.concat_arrays([pa.array(info[0], mask=info[1] > 0), pa.nulls(1, pa.int64())]),
                     "held_out": pad(info[2] > 0, pa.bool_()), "words": pad(info[3], pa.int64()), "score": pad(score, pa.float64()),
                     "base": pad(base, pa.float64()), "known": pad(known, pa.int64()),
                     "vocab": pa.array([None] * n + [vocab], pa.int64())})


def held_out(key: str):
    """Never learned from: crc32 of the id as text, modulo 5, is 1."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 1


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", cache_share: float = CACHE_SHARE,
                    word_share: float = WORD_SHARE) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end mark alone. With no training document the tree is
    uniform and no token is known. Repeated rows are scored, and taught, one by one; a
    null key is a training document. ``key`` is a whole number; other columns are not read.

    Word counts and the tree grow with the corpus, so neither is held whole: the common
    words are counted before and cached, at most 1 / word_share of them, so no fragment
    receives a word that all texts hold; a partition sends the other words of its texts to
    the words' fragments, and the positions that the cached
    top of the tree does not decide to the part of the tree that does, packed by blocks of
    texts; a fragment returns a sum for each text. The two shares
    move work, not results: the cached top has at most DEPTH / cache_share contexts."""
    rows = docs.select(F.col(key).cast("long").alias("id"), held_out(key).alias("held"), F.col(text).alias("text"))
    model = learn(rows.where(~F.col("held")), cache_share=cache_share, word_share=word_share)
    words, taught = model.words, model.docs
    total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    fragments = max(1, math.ceil((total[1] or 0) / 8 / PER_FRAGMENT))  # about eight bytes an entry
    buckets = max(1, math.ceil(total[0] / DOCS_PER_BUCKET))
    places, groups = slots(model, fragments)
    packed = lambda names: ", ".join(f"{c} binary" for c in names)
    columns = "frag int, kind int, block long, " + packed(WORD_ROWS[3:])
    parts = rows.mapInArrow(_scored(model.tree, model.symbol, model.share, model.common, model.times,
                                   fragments, places), columns).unionByName(
        model.sub_trees.mapInArrow(_dealt_tree(places, groups), columns))
    sums = parts.groupBy("frag").applyInArrow(
        _fragment_sums(model.tree.first, fragments, buckets),
        "bucket int, block long, " + packed(SUM_ROWS[2:6]) + ", vocab long, " + packed(SUM_ROWS[7:]))
    texts = stage(sums.groupBy("bucket").applyInArrow(
        _text_rows, "id long, held_out boolean, words long, score double, base double, known long, vocab long"), "lm_texts")
    vocabulary = (texts.agg(F.sum("vocab")).first()[0] or 0) + len(model.common) + (1 if taught else 0)
    tokens = words + taught
    scale = math.log10(tokens + 0.5 * (vocabulary + 1))
    return texts.where(F.col("vocab").isNull()).select(
        F.col("id").cast(dict(docs.dtypes)[key]).alias(key), "held_out", (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + F.lit(1 if taught else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(math.log10(taught + 0.5)) - (F.col("words") + 1) * F.lit(scale)).alias("base_score"), "score")
