"""Language profiles, periodic runs and whitening against brute force."""

import collections
import hashlib
import math
import random
import unicodedata
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.test_operators import DOC_SCHEMA, rows

CASES = 300


# --- periodic runs ---------------------------------------------------------------------------

def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and not any(w[i:i + length - d] == w[i + d:i + length] for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    n = rng.randint(0, 400)
    w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):  # plant runs, some inside others, some broken in one place
        q = rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 20, 31, 32, 33, 50, 64, 65])
        unit = [rng.randrange(rng.choice([2, 5, 1000])) for _ in range(q)]
        if rng.random() < 0.4 and q > 4:
            unit = (unit[:q // 4] * 4)[:q] if rng.random() < 0.5 else unit[:q // 2] + unit[:q - q // 2]
        part = (unit * 8)[:rng.randint(1, 5 * q + 40)]
        if rng.random() < 0.3 and part:
            part[rng.randrange(len(part))] = -1
        at = rng.randint(0, len(w))
        w[at:at + rng.choice([0, len(part)])] = part
    return w


def test_runs_equal_brute_force():
    from hearth.llm.periodic_runs import find_runs, word_numbers
    rng = random.Random(11)
    seen = 0
    for _ in range(CASES):
        w = periodic_words(rng)
        numbers = word_numbers([str(x).encode() for x in w])
        expected = brute_runs(w)
        seen += len(expected)
        assert find_runs(numbers) == expected, w
    assert seen > CASES // 2


def test_long_periods_and_one_word():
    from hearth.llm.periodic_runs import find_runs
    rng = np.random.default_rng(2)
    unit = rng.integers(0, 30, 700)
    w = np.concatenate([rng.integers(100, 10**6, 50), np.tile(unit, 4)[:2300], rng.integers(100, 10**6, 60)])
    _, w = np.unique(w, return_inverse=True)
    assert find_runs(w) == [(50, 2300, 700)]
    assert find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert find_runs(np.zeros(23, np.int64)) == [] and find_runs(np.zeros(24, np.int64)) == [(0, 24, 1)]


def brute_row(doc_id, text, tails=True):
    w = (text or "").encode().split()
    n = len(w)
    if tails and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (str(doc_id), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.fixture(scope="module")
def run_docs():
    rng = random.Random(4)
    out = [(0, None), (1, ""), (2, " \n\t"), (None, "no id " * 30), (None, "no id " * 30), (3, "a b " * 12), (4, "a " * 23), (-5, "x y z " * 40)]
    out += [(i, " ".join(f"w{x}" for x in periodic_words(rng))) for i in range(10, 90)]
    return out + [out[-1], (91, "é ß  é ß " * 20), (92, " ".join(str(i) for i in range(5000)))]


def test_periodic_runs(spark, run_docs, monkeypatch):
    from hearth.llm import periodic_runs as M
    docs = spark.createDataFrame(rows(run_docs), DOC_SCHEMA).repartition(3)
    out = M.digest(M.periodic_runs(docs, repeat_tails=True))
    got = sorted(((str(r.doc_id), *tuple(r)[1:]) for r in out.collect()), key=str)
    expected = sorted((brute_row(*d) for d in run_docs), key=str)
    assert got == expected and out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sum(r[1] for r in expected) > 40 and any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in run_docs)
    plain = {str(r.doc_id): r for r in M.periodic_runs(docs).collect()}
    assert plain["3"].text == "a b" and [tuple(x) for x in plain["3"].runs] == [(0, 24, 2)]
    assert all(brute_row(d, t, False)[1] == len(plain[str(d)].runs) for d, t in run_docs)
    monkeypatch.setattr(M, "BATCH_WORDS", 50)
    assert sorted(map(str, M.digest(M.periodic_runs(docs, repeat_tails=True)).collect())) == sorted(map(str, out.collect()))


# --- language profiles -----------------------------------------------------------------------

def brute_grams(text):
    out = collections.Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c)[0] == "L":
            word += c
        elif word:
            padded = f" {word} "
            for n in (1, 2, 3):
                out.update(g for g in (padded[i:i + n] for i in range(len(padded) - n + 1)) if g.strip() and (n < 3 or g[1] != " "))
            word = ""
    return out


def brute_profile(counts, size):
    def packed(g):  # one order of n-grams: by their packed code points, a blank is 0, pairs last
        v = 0
        for c in g:
            v = v << 21 | (0 if c == " " else ord(c))
        return v | (1 << 62 if len(g) == 2 else 0)
    return sorted(counts, key=lambda g: (-counts[g], packed(g)))[:size]


LANGUAGES = {"en": "the of and to in that was his with for it is not on at by had from but which they are".split(),
             "de": "der die und das nicht ist mit von dem sich auf für ein über schön größe auch wir".split(),
             "el": "και το να του η για την από με που ένα δεν στο".split()}


@pytest.fixture(scope="module")
def lang_docs():
    rng = random.Random(8)
    out = []
    for i in range(120):
        lang = rng.choice(sorted(LANGUAGES))
        text = " ".join(rng.choice(LANGUAGES[lang]) + rng.choice(["", "", ".", "\n", "!!", "'s"]) for _ in range(rng.randint(1, 60)))
        out.append((i, text.upper() if i % 7 == 0 else text, lang if i % 5 else None))
    out += [(200, None, "en"), (201, "", "de"), (202, "12 34 -- !!", "fr"), (203, "der", "de"), (None, "the and of", "en"), out[0], out[0],
            (204, "日本語 の テキスト", None), (205, "İSTANBUL ǅ ﬁ", "en"), (206, "the " * 20000, None), (207, "und the", "zz")]
    return out


@pytest.mark.parametrize("piece", [None, 40])
def test_language_profiles(spark, lang_docs, monkeypatch, piece):
    from hearth.llm import language_id as M
    if piece:
        monkeypatch.setattr(M, "PIECE_BYTES", piece)
    docs = spark.createDataFrame([(i, t, la, "s", 7, 7, 7, 7, 7, "x", "y") for i, t, la in lang_docs], DOC_SCHEMA).repartition(3)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 3 == 1
    total = collections.defaultdict(collections.Counter)
    for d, t, la in lang_docs:
        if la is not None and not held(d):
            total[la] += brute_grams(t)
    ranks = {la: {g: i for i, g in enumerate(brute_profile(c, M.PROFILE))} for la, c in sorted(total.items()) if c}

    def expected(d, t):
        mine = brute_profile(brute_grams(t), M.PROFILE)
        if not mine:
            return str(d), held(d), "und", 0.0
        near = {la: sum(M.PROFILE - abs(r[g] - i) for i, g in enumerate(mine) if g in r) for la, r in ranks.items()}
        best = max(sorted(near), key=lambda la: near[la])
        return str(d), held(d), best, near[best] / (M.PROFILE * len(mine))
    out = M.identify_languages(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = sorted((str(r.doc_id), r.held_out, r.lang_pred, r.score) for r in out.collect())
    assert got == sorted(expected(d, t) for d, t, _ in lang_docs)


def test_languages_of_held_out_documents(spark):
    from hearth.llm.language_id import identify_languages
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in got)
    assert len(got) > 200 and right / len(got) > 0.97, right / len(got)


def test_nothing_to_learn_from(spark):
    from hearth.llm.language_id import identify_languages
    docs = spark.createDataFrame([(i, "some words", None) for i in range(5)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in identify_languages(docs).collect()} == {("und", 0.0)}


# --- whitening -------------------------------------------------------------------------------

def exact_poly(matrix):
    """Faddeev-LeVerrier in whole numbers."""
    d = len(matrix)
    a = [[Fraction(v) for v in r] for r in matrix]
    m = [[Fraction(0)] * d for _ in range(d)]
    c = [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(sum(a[i][x] * m[x][i] for x in range(d)) for i in range(d)) / k
    return [int(v) for v in c]


def test_characteristic_polynomial(spark):
    from hearth.llm import whitening as M
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7):
        x = rng.integers(-9, 9, (d + 2, d)).astype(object)
        matrix = (x.T @ x).tolist()
        assert M.char_poly(spark, matrix) == exact_poly(matrix)
    blocks = [[2, 0, 0, 0], [0, 0, 0, 0], [0, 0, 5, 0], [0, 0, 0, 2]]  # needs row exchanges, a zero column, a double root
    assert M.char_poly(spark, blocks) == exact_poly(blocks)
    assert [r / 2 ** M.ROOT_BITS for r in M.largest_roots(exact_poly(blocks), 4)] == [5, 2, 2, 0]
    assert M.is_prime(2147483647) and not M.is_prime(2147483649) and [p for p in range(30) if M.is_prime(p)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29]


def test_exact_gram():
    from hearth.llm.whitening import exact_gram
    rng = np.random.default_rng(3)
    for top in (1, 100, 1 << 15, 1 << 16, 1 << 40, (1 << 62) - 1):
        x = rng.integers(-top, top, (40, 5))
        x[0] = [top, -top, 0, -1, 1]
        o = x.astype(object)
        assert exact_gram(x) == (o.T @ o).tolist()


def brute_whitening(vectors):
    x = [tuple(math.floor(256 * c) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=object)
    n, s = len(fit), fit.sum(0)
    centred = (fit * n - s).astype(object)
    v = np.array([[Fraction(int(e), n ** 3) for e in row] for row in centred.T @ centred])
    values, axes = np.linalg.eigh(v.astype(float))
    return x, n, s, values[::-1], axes[:, ::-1].T


def test_whitening(spark):
    from hearth.llm import whitening as M
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((6, 6))
    good = [list(map(float, v)) for v in rng.standard_normal((200, 6)) @ mix + np.array([1e4, 0, -3, 0, 0, 7])]
    good += [good[0], good[1], good[1]]
    bad = [None, [float("nan")] * 6, [None, 1.0, 1.0, 1.0, 1.0, 1.0], [float("inf")] + [0.0] * 5, [1e300] + [0.0] * 5]
    table = [(i, v, 1, 7, 7, "x") for i, v in enumerate(good + bad)]
    table += [(None, good[2], 1, 7, 7, "x")]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, component int, n long, x long, id string").repartition(3)
    out = M.whitened(frame)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    x, n, s, values, axes = brute_whitening(good)
    assert len(got) == 4 * (len(good) + 1) and {r.n for r in got} == {n} and n == 200
    assert got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1
    sign = {}
    for r in got:
        row = x[2 if r.vec_id is None else r.vec_id]
        assert r.deviation == sum((n * a - b) ** 2 for a, b in zip(row, s))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        centred = np.array([float(Fraction(int(n * a - b), n)) for a, b in zip(row, s)])
        y = centred @ axes[r.component - 1] / math.sqrt(values[r.component - 1])
        assert abs(r.whitened) == pytest.approx(abs(y), abs=1e-7)
        if abs(y) > 1e-3:
            assert sign.setdefault(r.component, r.whitened * y > 0) == (r.whitened * y > 0)


def test_equal_eigenvalues_and_few_directions(spark):
    from hearth.llm.whitening import whitened
    schema = "vec_id long, embedding array<float>"
    cross = [[1.0, 0, 0, 0, 0], [-1.0, 0, 0, 0, 0], [0, 1.0, 0, 0, 0], [0, -1.0, 0, 0, 0], [0, 0, 1.0, 0, 0], [0, 0, -1.0, 0, 0]]
    got = whitened(spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(cross)], schema)).collect()
    assert {r.component for r in got} == {1, 2, 3} and all(r.explained == pytest.approx(1 / 3) for r in got)
    assert max(r.identity_error for r in got) < 1e-12
    short = whitened(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [])], schema)).collect()
    assert {r.component for r in short} == {1, 2} and len(short) == 6
    for lonely in ([(0, [1.0, 2.0]), (1, [1.0, 2.0])], [(0, [])], [(0, None)], []):
        assert whitened(spark.createDataFrame(lonely, schema)).count() == 0


def test_large_and_close_entries(spark):
    """Entries far from 0 that differ in their last places: doubles alone would cancel."""
    from hearth.llm.whitening import whitened
    base = float(1 << 40)
    vectors = [[base + a, base + b / 4] for a in range(5) for b in range(3)]
    got = whitened(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert got[0].identity_error < 1e-9 and all(r.deviation is not None for r in got)
    x, n, s, values, _ = brute_whitening(vectors)
    assert {r.deviation for r in got} == {sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x}


def test_empty_tables_of_the_new_operators(spark):
    from hearth.llm import language_id, periodic_runs
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert language_id.identify_languages(docs).count() == 0
    assert periodic_runs.digest(periodic_runs.periodic_runs(docs)).count() == 0
