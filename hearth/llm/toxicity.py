"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each word enters as a learned word vector joined with the mean of its learned
character n-gram vectors. The network reads windows of words in both directions,
attention pools a window into one logit, and a document's logit is that of its
most toxic window. Every labelled document that is not held out is learned from, by its
whole text: what words and n-grams tell is counted on Spark, and training goes in rounds.
In a round each task seeks its documents' most toxic windows among all of them, goes on
from the shared parameters by Adam on these windows, in numpy, and the tasks' parameters are
averaged by their numbers of documents. The threshold errs least on all these documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm import textops as T
from hearth.session import stage

WINDOW, STRIDE = 64, 32   # words of a window, words between window starts
HIDDEN, EMBED, ATTEND = 8, 12, 8
WORDS, GRAMS = 4096, 8192  # learned word and n-gram vectors; others share vector 0
SAMPLE_WINDOWS = 1        # windows that a clean document gives to a round, its most toxic; a toxic one gives its most
#                           toxic: the one whose logit is the document's
ROUNDS = 2                # of training and averaging: after counted evidence, then by the network
BATCH, STEPS = 256, 80    # windows of an update; a task's updates in all rounds, at least
PER_TASK = 4096           # labelled documents of one training task, on average
BLOCK = 8192              # documents whose chosen windows a task holds at once
TABLE = 1 << 23           # marks of things in documents at once
PER_FLUSH = 500_000       # counted words and n-grams that a task holds at once
CHUNK = 4096              # parameters of a row that is averaged
CELLS = 1024              # cells of a logit in which the threshold's errors are summed
TABLE_BITS = 20           # n-gram codes are looked up in a table of 2 ** bits

# Bytes that make a word here: ASCII letters and digits, and all of UTF-8 beyond ASCII.
SOLID = np.zeros(256, bool)
SOLID[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def tokens(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first) of the words of lower-cased texts."""
    return T.word_bounds(np.where(SOLID[data], data, np.uint8(0x20)), offsets)


def grams_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(hashes, word numbers): the 3- and 4-byte n-grams of the marked words ^word$."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size + 2)])
    marked = np.empty(int(at[-1]) + 4, np.uint32)
    marked[:] = 1
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    owner = np.repeat(np.arange(len(size)), size)
    marked[at[owner] + 1 + inner] = data[starts[owner] + inner]
    marked[at[1:] - 1] = 2
    whose = np.repeat(np.arange(len(size)), size + 2)
    place = np.arange(len(whose))
    left = at[whose + 1] - place  # bytes from here to the word's end mark
    n = len(whose)
    three = marked[:n] | marked[1:n + 1] << np.uint32(8) | marked[2:n + 2] << np.uint32(16)
    four = three | marked[3:n + 3] << np.uint32(24)
    ok3, ok4 = left >= 3, left >= 4
    codes = np.concatenate([three[ok3].astype(np.uint64), four[ok4].astype(np.uint64) | np.uint64(1 << 32)])
    return T.mix(codes), np.concatenate([whose[ok3], whose[ok4]])


class Vocabulary:
    """Word and n-gram numbers; 0 is any other."""

    def __init__(self, words: np.ndarray, grams: np.ndarray):
        self.words = np.sort(words)
        self.table = np.zeros(1 << TABLE_BITS, np.uint16)
        self.table[(grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = np.arange(1, len(grams) + 1)

    def word_ids(self, hashes):
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)

    def gram_ids(self, hashes):
        return self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tanh(x):
    return 2 * sigmoid(2 * x) - 1


class Net:
    """The network's parameters, forward pass and gradients."""

    def __init__(self, seed=0):
        r = np.random.default_rng(seed)
        g = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
        h = HIDDEN
        self.p = {
            "word": (r.standard_normal((WORDS + 1, EMBED)) * 0.1).astype(np.float32),
            "gram": (r.standard_normal((GRAMS + 1, EMBED)) * 0.1).astype(np.float32),
            "wx": g(2, 2 * EMBED, 3 * h), "bx": np.zeros((2, 1, 3 * h), np.float32),
            "uzr": g(2, h, 2 * h), "un": g(2, h, h),
            "wa": g(2 * h, ATTEND), "va": g(ATTEND, 1)[:, 0], "wo": g(2 * h, 1)[:, 0], "bo": np.zeros(1, np.float32)}

    def inputs(self, word_ids, gram_ids, gram_owner, count):
        """The input vector of each distinct word, from its known n-grams (in the order of their words)
        and its number of all."""
        x = np.zeros((len(word_ids), 2 * EMBED), np.float32)
        x[:, :EMBED] = self.p["word"][word_ids]
        if len(gram_owner):
            heads = np.flatnonzero(np.concatenate([[True], gram_owner[1:] != gram_owner[:-1]]))
            own = gram_owner[heads]
            x[own, EMBED:] = np.add.reduceat(self.p["gram"][gram_ids], heads, axis=0) / count[own, None]
        return x

    def evidence(self, word_ids, gram_ids, gram_owner, count):
        """Of each distinct word the parts that start as counted evidence; a last value for padding."""
        return np.append(self.p["word"][word_ids, 0] + np.bincount(gram_owner, weights=self.p["gram"][gram_ids, 0],
                                                                  minlength=len(word_ids)) / count, -9)

    def project(self, x):
        """The gates' input part for each distinct word and direction, and a last row for padding."""
        xw = x @ self.p["wx"] + self.p["bx"]
        return np.concatenate([xw, np.zeros((2, 1, xw.shape[2]), np.float32)], 1)

    def forward(self, xw, index, keep=False):
        """Logits of windows; ``index`` [B, T] holds word rows, the last row is padding."""
        p, h = self.p, HIDDEN
        both = np.stack([index, index[:, ::-1]])
        mask = (both < xw.shape[1] - 1).astype(np.float32)[..., None]
        b, steps = index.shape
        state = np.zeros((2, b, h), np.float32)
        seen = np.empty((steps, 2, b, h), np.float32)
        trail = []
        for t in range(steps):
            g = np.stack([xw[0][both[0, :, t]], xw[1][both[1, :, t]]])
            zr = sigmoid(g[..., :2 * h] + state @ p["uzr"])
            z, r = zr[..., :h], zr[..., h:]
            n = tanh(g[..., 2 * h:] + (r * state) @ p["un"])
            m = mask[:, :, t]
            new = state + m * (1 - z) * (n - state)
            if keep:
                trail.append((state, z, r, n, m))
            state = new
            seen[t] = new
        out = np.concatenate([seen[:, 0], seen[::-1, 1]], -1)  # [T, B, 2H], in reading order
        valid = mask[0, :, :, 0].T
        tied = tanh(out @ p["wa"])
        e = np.where(valid > 0, tied @ p["va"], -30)
        a = np.exp(e - e.max(0)) * valid
        a /= np.maximum(a.sum(0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", a, out)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (both, out, tied, a, pooled, trail)) if keep else logit

    def gates(self, xw):
        """``xw`` for ``logits``: padding is a gate that lets nothing in, and a sigmoid is taken as a
        hyperbolic tangent of the half, the half taken into the weights."""
        n = xw.shape[1]
        gates = xw.reshape(2 * n, -1).astype(np.float32)
        gates[:, :2 * HIDDEN] *= 0.5
        gates[[n - 1, 2 * n - 1], :HIDDEN] = 50
        return gates

    def logits(self, gates, index):
        """The logits that ``forward`` gives, with less work."""
        p, h, n = self.p, HIDDEN, len(gates) // 2
        half = p["uzr"] * np.float32(0.5)
        rows = index.T
        steps, b = rows.shape
        both = np.stack([rows, rows[::-1] + n])  # [2, T, B]
        out = np.empty((steps, b, 2 * h), np.float32)
        state, g = np.zeros((2, b, h), np.float32), np.empty((2, b, 3 * h), np.float32)
        for t in range(steps):
            np.take(gates, both[:, t], axis=0, out=g, mode="clip")
            zr = state @ half
            zr += g[..., :2 * h]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            new = (zr[..., h:] * state) @ p["un"]
            new += g[..., 2 * h:]
            np.tanh(new, out=new)
            new -= state
            new *= 1 - zr[..., :h]
            state = state + new
            out[t, :, :h], out[steps - 1 - t, :, h:] = state
        valid = rows < n - 1
        tied = out.reshape(-1, 2 * h) @ p["wa"]
        np.tanh(tied, out=tied)
        e = np.where(valid, (tied @ p["va"]).reshape(steps, b), -30)
        a = np.exp(e - e.max(0)) * valid
        a /= np.maximum(a.sum(0), 1e-9)
        return (a * (out @ p["wo"])).sum(0) + p["bo"][0]

    def gradients(self, x, index, target, weight):
        """Gradients of the weighted logistic loss; ``d_x`` for the words' input vectors."""
        p, h = self.p, HIDDEN
        xw = self.project(x)
        logit, (both, out, tied, a, pooled, trail) = self.forward(xw, index, keep=True)
        d_logit = ((sigmoid(logit) - target) * weight / len(target)).astype(np.float32)
        g = {"wo": pooled.T @ d_logit, "bo": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["wo"]
        d_out = a[..., None] * d_pooled
        d_a = np.einsum("tbh,bh->tb", out, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(0))
        g["va"] = d_e.ravel() @ tied.reshape(-1, tied.shape[2])
        d_tied = d_e[..., None] * p["va"] * (1 - tied ** 2)
        g["wa"] = out.reshape(-1, 2 * h).T @ d_tied.reshape(-1, d_tied.shape[2])
        d_out += d_tied @ p["wa"].T
        steps = index.shape[1]
        g["uzr"], g["un"] = np.zeros_like(p["uzr"]), np.zeros_like(p["un"])
        d_xw = np.zeros_like(xw)
        d_gate = np.empty((steps, 2, len(index), 3 * h), np.float32)
        carry = np.zeros_like(trail[0][0])
        for t in range(steps - 1, -1, -1):
            state, z, r, n, m = trail[t]
            d = carry + np.stack([d_out[t, :, :h], d_out[steps - 1 - t, :, h:]])
            dm = d * m
            carry = d - dm + dm * z
            an = dm * (1 - z) * (1 - n ** 2)
            az = dm * (state - n) * z * (1 - z)
            back = an @ p["un"].transpose(0, 2, 1)
            ar = back * state * r * (1 - r)
            zr = np.concatenate([az, ar], -1)
            carry = carry + back * r + zr @ p["uzr"].transpose(0, 2, 1)
            g["uzr"] += state.transpose(0, 2, 1) @ zr
            g["un"] += (r * state).transpose(0, 2, 1) @ an
            d_gate[t] = np.concatenate([zr, an], -1)
        for way in (0, 1):  # the words' shares, summed by sorting
            rows = both[way].T.ravel()
            order = np.argsort(rows, kind="stable")
            heads = np.flatnonzero(np.concatenate([[True], rows[order][1:] != rows[order][:-1]]))
            d_xw[way][rows[order][heads]] = np.add.reduceat(d_gate[:, way].reshape(len(rows), -1)[order], heads)
        d_xw = d_xw[:, :-1]
        g["wx"] = x.T @ d_xw
        g["bx"] = d_xw.sum(1, keepdims=True)
        d_x = d_xw[0] @ p["wx"][0].T + d_xw[1] @ p["wx"][1].T
        return logit, g, d_x


class Read:
    """The windows of lower-cased texts, over their distinct words."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.first = tokens(data, offsets)
        count = np.diff(self.first)
        wins = np.where(count > 0, np.maximum(-(-(count - WINDOW) // STRIDE), 0) + 1, 0)
        self.text = np.repeat(np.arange(len(count)), wins)
        nth = np.arange(len(self.text)) - np.repeat(np.cumsum(wins) - wins, wins)
        self.head = self.first[self.text] + nth * STRIDE
        self.hashes, at, which = np.unique(T.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        self.padded = np.append(which, len(self.hashes))
        gram_hash, owner = grams_of(data, starts[at], ends[at])
        gram_ids = vocabulary.gram_ids(gram_hash)
        known = np.flatnonzero(gram_ids)
        known = known[np.argsort(owner[known], kind="stable")]
        self.words = (vocabulary.word_ids(self.hashes), gram_ids[known], owner[known],
                      np.maximum(np.bincount(owner, minlength=len(at)), 1).astype(np.float32))

    def index(self, rows) -> np.ndarray:
        """The distinct words of windows; one past the last is padding."""
        at = self.head[rows][:, None] + np.arange(WINDOW)
        return self.padded[np.where(at < self.first[self.text[rows] + 1][:, None], at, len(self.padded) - 1)]

    def logits(self, net: Net, evidence: bool = False) -> np.ndarray:
        """Of every window; with ``evidence``, that of its most telling word."""
        if not len(self.text):
            return np.zeros(0)
        table = net.evidence(*self.words) if evidence else net.gates(net.project(net.inputs(*self.words)))
        value = (lambda index: table[index].max(1)) if evidence else (lambda index: net.logits(table, index))
        return np.concatenate([value(self.index(slice(lo, lo + 1024))) for lo in range(0, len(self.text), 1024)]).astype(np.float64)


class Toxicity:
    """A model: ``score(texts)`` gives one logit for each text."""

    def __init__(self, words, word_odds, grams, gram_odds, positive: int, docs: int, seed: int = 0):
        """Untrained, from the telling words' and n-grams' hashes and log odds and the documents of the classes."""
        self.vocabulary = Vocabulary(words, grams)
        self.net = Net(seed)
        p = self.net.p  # the first component starts as the evidence counted
        p["word"][0, 0] = p["gram"][0, 0] = 0
        p["word"][self.vocabulary.word_ids(words), 0] = np.clip(word_odds, -4, 4) / 2
        p["gram"][self.vocabulary.gram_ids(grams), 0] = np.clip(gram_odds, -4, 4) / 2
        self.balance = docs / (2 * (docs - positive)), docs / (2 * positive)  # the classes' weights
        self.empty = math.log((positive + 0.5) / (docs - positive + 0.5)) if 2 * positive < docs else -1.0
        self.shift = 0.0  # until the threshold is set

    @staticmethod
    def _cut(logit, positive):
        """The logit between the classes with the fewest errors, in the middle of the gap it lies in: what
        ``_threshold`` finds on Spark, for logits that differ."""
        order = np.argsort(logit, kind="stable")
        v, y = logit[order], positive[order].astype(np.int64)
        errors = np.concatenate([[0], np.cumsum(y)]) + (len(y) - y.sum()) - np.concatenate([[0], np.cumsum(1 - y)])
        edges = np.concatenate([[v[0] - 1], (v[1:] + v[:-1]) / 2, [v[-1] + 1]])
        width = np.concatenate([[1], v[1:] - v[:-1], [1]])
        return float(edges[np.lexsort((-width, errors))[0]])

    def highest(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The highest logit of each lower-cased text's windows, before the threshold; -inf without a word."""
        read = Read(self.vocabulary, data, offsets)
        out = np.full(len(offsets) - 1, -np.inf)
        np.maximum.at(out, read.text, read.logits(self.net))
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A logit for each lower-cased text: its highest window. Above 0 is toxic."""
        best = self.highest(data, offsets)
        return np.where(np.isfinite(best), best - self.shift, self.empty)


def held_out(key: str):
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0


# ---- what words and n-grams tell -------------------------------------------

WORD, GRAM, DOCUMENT = 0, 1, 2  # kinds of counted things


def _held(things, docs, positive, n):
    """(documents that hold each of ``n`` things, the positive ones among them); ``things`` are those
    of each of ``docs``, which come in order. Marked in a table, some documents at a time."""
    held, told = np.zeros(n, np.int64), np.zeros(n, np.int64)
    step = max(1, TABLE // max(n, 1))
    for lo in range(0, len(positive), step):
        mine = slice(*np.searchsorted(docs, [lo, lo + step]))
        marks = np.zeros((min(step, len(positive) - lo), n), bool)
        marks[docs[mine] - lo, things[mine]] = True
        held += marks.sum(0)
        told += marks[positive[lo:lo + step]].sum(0)
    return held, told


def _sum_by(names, *counts):
    order = np.argsort(names, kind="stable")
    names = names[order]
    heads = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, int)
    return names[heads], *(np.add.reduceat(c[order], heads) if len(heads) else c for c in counts)


def _counts(batches):
    """(kind, hash, held, positive): in how many documents of a partition words and n-grams stand."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
    total, parts = {WORD: none, GRAM: none, DOCUMENT: none}, {WORD: [], GRAM: [], DOCUMENT: []}

    def rows(kind):
        for i in range(0, len(total[kind][0]), 100_000):
            name, held, positive = (c[i:i + 100_000] for c in total[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(name), kind, np.int32)), pa.array(name.view(np.int64)),
                                              pa.array(held), pa.array(positive)], ["kind", "hash", "held", "positive"])

    def add(kind):
        total[kind] = _sum_by(*(np.concatenate(c) for c in zip(total[kind], *parts[kind])))
        parts[kind] = []

    for batch in batches:
        labels = batch.column(0).to_numpy() == 1
        for lo, hi, data, offsets in T.text_batches(batch.column(1), 1 << 20):
            data, positive = T.lower_ascii(data), labels[lo:hi]
            starts, ends, first = tokens(data, offsets)
            if not len(starts):
                continue
            hashes, at, which = np.unique(T.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
            # The distinct words of each document, by document.
            code = np.sort(np.repeat(np.arange(hi - lo) * np.int64(len(hashes)), np.diff(first)) + which)
            code = code[np.concatenate([[True], code[1:] != code[:-1]])]
            doc, word = code // len(hashes), code % len(hashes)
            parts[WORD].append((hashes, *_held(word, doc, positive, len(hashes))))
            gram_hash, owner = grams_of(data, starts[at], ends[at])
            grams, gram = np.unique(gram_hash, return_inverse=True)
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(hashes) + 1))
            size = np.diff(cuts)[word]
            take = np.repeat(cuts[word] - np.cumsum(size) + size, size) + np.arange(size.sum())
            parts[GRAM].append((grams, *_held(gram[order[take]], np.repeat(doc, size), positive, len(grams))))
            some = np.diff(first) > 0
            parts[DOCUMENT].append((np.zeros(1, np.uint64), np.array([some.sum()]), np.array([(some & positive).sum()])))
            for kind in (WORD, GRAM):
                if sum(len(p[0]) for p in parts[kind]) >= PER_FLUSH:
                    add(kind)
                if len(total[kind][0]) >= PER_FLUSH:
                    yield from rows(kind)
                    total[kind] = none
    for kind in total:
        if parts[kind]:
            add(kind)
        yield from rows(kind)


def _telling(counts: DataFrame, kind: int, positive: int, docs: int, most: int):
    """(hashes, smoothed log odds) of the ``most`` telling ones that two documents or more hold."""
    odds = (F.log((F.col("positive") + 0.5) / (positive + 1.0))
            - F.log((F.col("held") - F.col("positive") + 0.5) / (docs - positive + 1.0)))
    got = (counts.where((F.col("kind") == kind) & (F.col("held") >= 2)).select("hash", odds.alias("odds"), "held")
           .withColumn("worth", F.abs("odds") * F.sqrt("held")).where(F.col("worth") > 0)
           .orderBy(F.desc("worth"), "hash").limit(most).toArrow())
    return got.column("hash").to_numpy().astype(np.int64).view(np.uint64), got.column("odds").to_numpy().astype(np.float64)


# ---- training -------------------------------------------------------------

class Descent:
    """Adam from the shared parameters on one task's windows."""

    def __init__(self, net: Net, balance):
        self.net, self.balance, self.steps = net, np.array(balance, np.float32), 0
        self.moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}

    def epoch(self, index, label, words, order):
        """One pass over the windows ``index`` of the distinct ``words``, the next past the last being padding."""
        word_ids, gram_ids, gram_owner, count = words
        net, n = self.net, len(word_ids)
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            used, local = np.unique(np.append(index[rows].ravel(), n), return_inverse=True)
            real = used[:-1]
            at = np.full(n, -1)
            at[real] = np.arange(len(real))
            mine = np.flatnonzero(at[gram_owner] >= 0)
            ids, own = gram_ids[mine], at[gram_owner[mine]]
            x = net.inputs(word_ids[real], ids, own, count[real])
            _, g, d_x = net.gradients(x, local[:-1].reshape(len(rows), -1), label[rows], self.balance[label[rows].astype(int)])
            g["word"], g["gram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["gram"])
            share = d_x[:, EMBED:] / count[real][:, None]
            for d in range(EMBED):
                g["word"][:, d] = np.bincount(word_ids[real], weights=d_x[:, d], minlength=WORDS + 1)
                g["gram"][:, d] = np.bincount(ids, weights=share[own, d], minlength=GRAMS + 1)
            g["gram"][0] = 0
            self.steps += 1
            for k, v in net.p.items():
                m, s = self.moment[k]
                m += 0.1 * (g[k] - m)
                s += 0.001 * (g[k] ** 2 - s)
                v -= 0.01 * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(s / (1 - 0.999 ** self.steps)) + 1e-7)


def _chosen(model, data, offsets, positive, evidence):
    """(hashes, words, index, labels) of the windows that texts give to a round."""
    read = Read(model.vocabulary, data, offsets)
    order = np.lexsort((-read.logits(model.net, evidence), read.text))
    owner = read.text[order]
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    nth = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    rows = order[(nth == 0) | (nth < SAMPLE_WINDOWS) & ~positive[owner]]
    index = read.index(rows)
    used, local = np.unique(np.append(index.ravel(), len(read.hashes)), return_inverse=True)
    real = used[:-1]
    at = np.full(len(read.hashes), -1)
    at[real] = np.arange(len(real))
    word_ids, gram_ids, gram_owner, count = read.words
    mine = np.flatnonzero(at[gram_owner] >= 0)
    return (read.hashes[real], (word_ids[real], gram_ids[mine].astype(np.uint16), at[gram_owner[mine]], count[real]),
            np.where(local[:-1] < len(real), local[:-1], -1).reshape(-1, WINDOW).astype(np.int32), positive[read.text[rows]])


def _joined(parts):
    """(words, index, labels) of a block's slices over the distinct words of all."""
    hashes, at, which = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    base = np.cumsum([0] + [len(p[0]) for p in parts])
    index = np.concatenate([np.where(p[2] < 0, len(hashes), which[np.minimum(p[2] + b, base[-1] - 1)]).astype(np.int32)
                            for p, b in zip(parts, base)])
    word_ids, count = (np.concatenate([p[1][i] for p in parts])[at] for i in (0, 3))
    place = np.full(base[-1], -1)
    place[at] = np.arange(len(at))  # a word's n-grams are taken from the first slice that has it
    owner = np.concatenate([place[p[1][2] + b] for p, b in zip(parts, base)])
    grams = np.concatenate([p[1][1] for p in parts]).astype(np.int64)
    mine = np.flatnonzero(owner >= 0)
    mine = mine[np.argsort(owner[mine], kind="stable")]
    return (word_ids, grams[mine], owner[mine], count), index, np.concatenate([p[3] for p in parts]).astype(np.float32)


def _round(model, nth, seed=0):
    """A task's part of a round: its parameters after its documents, in chunks, and their number."""
    def run(batches):
        net = Net.__new__(Net)
        net.p = {k: v.copy() for k, v in model.net.p.items()}
        descent, docs, held, parts = Descent(net, model.balance), 0, 0, []
        r = np.random.default_rng([seed, nth])

        def learn():
            words, index, label = _joined(parts)
            for _ in range(max(1, -(-STEPS // (ROUNDS * -(-len(index) // BATCH))))):
                descent.epoch(index, label, words, r.permutation(len(index)))

        for batch in batches:
            labels = batch.column(0).to_numpy() == 1
            for lo, hi, data, offsets in T.text_batches(batch.column(1), 1 << 20):
                part = _chosen(model, T.lower_ascii(data), offsets, labels[lo:hi], nth == 0)
                if len(part[2]):
                    parts.append(part)
                    docs, held = docs + hi - lo, held + hi - lo
                if held >= BLOCK:
                    learn()
                    held, parts = 0, []
        if parts:
            learn()
        if docs:
            flat = np.concatenate([v.ravel() for v in net.p.values()])
            cuts = range(0, len(flat), CHUNK)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cuts)), pa.int32()), pa.array([task] * len(cuts), pa.int32()), pa.array([docs] * len(cuts), pa.int64()),
                 pa.array([T.pack(flat[i:i + CHUNK].astype(np.float32)) for i in cuts], pa.binary())], ["chunk", "task", "docs", "values"])
    return run


def _average(table):
    """One row of a chunk's rows: their mean by documents."""
    table = table.sort_by("task")
    docs = table.column("docs").to_numpy()
    mean = sum(np.frombuffer(v.as_buffer(), np.float32) * n for v, n in zip(table.column("values"), docs / docs.sum()))
    return pa.table({"chunk": table.column("chunk")[:1], "task": table.column("task")[:1], "docs": pa.array([docs.sum()], pa.int64()),
                     "values": pa.array([T.pack(mean.astype(np.float32))], pa.binary())})


PARAMETER_ROWS = "chunk int, task int, docs long, values binary"


def _trained(model, rows: DataFrame, nth: int) -> None:
    """One round over all rows (toxic, text). The driver receives one model."""
    tasks = rows.mapInArrow(_round(model, nth), PARAMETER_ROWS)
    some = tasks.groupBy("chunk", (F.col("task") % 32).alias("share")).applyInArrow(_average, PARAMETER_ROWS)
    got = some.groupBy("chunk").applyInArrow(_average, PARAMETER_ROWS).select("chunk", "values").toArrow().sort_by("chunk")
    flat = T.unpack(got.column("values"), np.float32)
    at = 0
    for k, v in model.net.p.items():
        model.net.p[k] = flat[at:at + v.size].reshape(v.shape).copy()
        at += v.size


def _highest(model):
    """(toxic, logit) of the texts that have words, by all their windows."""
    def run(batches):
        for batch in batches:
            best = np.empty(batch.num_rows)
            for lo, hi, data, offsets in T.text_batches(batch.column(1), 1 << 20):
                best[lo:hi] = model.highest(T.lower_ascii(data), offsets)
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(best)], ["toxic", "logit"])
            yield out.filter(pa.array(np.isfinite(best)))
    return run


def _threshold(best: DataFrame) -> float:
    """The logit with the fewest errors over all rows (toxic, logit), in the middle of the widest gap that has it.

    Errors are summed in Spark within cells of the logits; the driver sums those of the cells. A logit is
    bounded by the output weights, so the cells are bounded too."""
    rows = best.select("toxic", "logit", F.floor(F.col("logit") * CELLS).alias("cell"))
    cells = (rows.groupBy("cell").agg(F.sum("toxic").alias("positive"), F.count(F.lit(1)).alias("n"), F.min("logit").alias("least"))
             .orderBy("cell").toArrow())
    cell, positive, n, least = (cells.column(c).to_numpy() for c in ("cell", "positive", "n", "least"))
    clean = int((n - positive).sum())
    # Errors of a threshold below each cell.
    below = np.cumsum(positive) - positive + clean - (np.cumsum(n - positive) - (n - positive))
    nexts = [*least[1:].tolist(), None]
    known = best.sparkSession.createDataFrame(list(zip(cell.tolist(), below.tolist(), nexts)), "cell long, below long, after double")
    each = rows.groupBy("cell", "logit").agg(F.sum(2 * F.col("toxic") - 1).alias("change"))
    order = Window.partitionBy("cell").orderBy("logit")
    after = F.coalesce(F.lead("logit").over(order), F.col("after"))
    cut = (each.join(F.broadcast(known), "cell")
           .select("logit", after.alias("after"), (F.col("below") + F.sum("change").over(order)).alias("errors"))
           .select("errors", F.coalesce(F.col("after") - F.col("logit"), F.lit(1.0)).alias("width"),
                   F.coalesce((F.col("after") + F.col("logit")) / 2, F.col("logit") + 1).alias("cut"))
           .orderBy("errors", F.desc("width"), "cut").first())
    all_toxic = (clean, -1.0, float(least[0]) - 1)
    return min(all_toxic, (cut["errors"], -cut["width"], cut["cut"]))[2]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Toxicity | None:
    """A model of all labelled documents, held-out ids left out; None where a class has no
    document with words. Several labels of one id count as toxic if one does; null ids and labels
    are left out. Rows that share a labelled id are documents of their own.

    The driver receives at most WORDS and GRAMS counted evidence, the parameters and the sums of cells."""
    known = (labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & ~held_out(key))
             .groupBy(key).agg((F.max("toxic") == 1).cast("int").alias("toxic")))
    parts = max(1, math.ceil(known.count() / PER_TASK), math.ceil(docs.count() / (8 * PER_TASK)))
    texts = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull() & ~held_out(key)).select(F.col(key), F.col(text).alias("text"))
    # In the order of a hash, so that each run learns in the same order.
    rows = stage(texts.repartition(parts, key).join(known.repartition(parts, key).hint("shuffle_hash"), key)
                 .sortWithinPartitions(F.xxhash64(key), key, "text").select("toxic", "text"), "toxicity_texts")
    counts = stage(rows.mapInArrow(_counts, "kind int, hash long, held long, positive long").groupBy("kind", "hash")
                   .agg(F.sum("held").alias("held"), F.sum("positive").alias("positive")), "toxicity_counts")
    total = counts.where(F.col("kind") == DOCUMENT).first()
    if total is None or total["positive"] in (0, total["held"]):
        return None
    size = total["positive"], total["held"]
    model = Toxicity(*_telling(counts, WORD, *size, WORDS), *_telling(counts, GRAM, *size, GRAMS), *size)
    for nth in range(ROUNDS):
        _trained(model, rows, nth)
    model.shift = _threshold(stage(rows.mapInArrow(_highest(model), "toxic int, logit double"), "toxicity_logits"))
    return model


def _scorer(model):
    def run(batches):
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for lo, hi, data, offsets in T.text_batches(batch.column(1), 1 << 20):
                scores[lo:hi] = model.score(T.lower_ascii(data), offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(scores))], ["id", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, score (0 to 1), predicted.

    Whole texts are read, in overlapping windows. A text without words (null
    included) gets the rate of toxic documents learned from, below one half. Without labels of both
    classes nothing can be learned and every score is 0. Repeated rows stay."""
    model = train(docs, labels, key, text)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    out = rows.select("id", F.lit(0.0).alias("score")) if model is None else rows.mapInArrow(
        _scorer(model), f"id {kind}, score double")
    return out.select(F.col("id").alias(key), held_out("id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that the model rejects, judged row by row in one pass."""
    model = train(docs, labels, key, text)
    if model is None:
        return docs
    at = docs.columns.index(text)

    def keep(batches):
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for lo, hi, data, offsets in T.text_batches(batch.column(at), 1 << 20):
                scores[lo:hi] = model.score(T.lower_ascii(data), offsets)
            yield batch.filter(pa.array(scores < 0))
    return docs.mapInArrow(keep, docs.schema)
