"""The training-data operators on small tables, against brute force.

Every fixture has nulls, empty and long texts, repeated rows, ties, and extra
columns whose names clash with those the operators use inside.
"""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

CLASH = "n long, root long, id long, size long, shard int, label string, words string"
DOC_SCHEMA = f"doc_id long, text string, lang string, source string, {CLASH}"


def rows(texts, sources=("a", "b", None)):
    return [(i, t, "en", sources[k % len(sources)], 7, 7, 7, 7, 7, "x", "y") for k, (i, t) in enumerate(texts)]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base, passage = prose(rng, 160).split(), prose(rng, 60)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "Only three words"), (4, "only THREE words")]
    for i in range(5, 25):  # near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        out.append((i, " ".join(w)))
    out += [(i, prose(rng, rng.randint(1, 120))) for i in range(25, 40)]
    out += [(i, prose(rng, 20) + " " + passage + " " + prose(rng, 20)) for i in range(40, 44)]
    out += [(44, "the " * 120), (45, prose(rng, 30000)), (46, out[30][1]), (46, out[30][1]), (None, out[30][1]), (-3, "É ẞ Ünïcode " + passage)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows(texts), DOC_SCHEMA).repartition(3)


def words(t, lower=True):
    b = (t or "").encode()
    return (b.lower() if lower else b).split()


def brute_components(texts):
    sets = []
    for d, t in texts:
        w = words(t)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                up[root(i)] = root(j)
    least = collections.defaultdict(lambda: None)
    for i, (d, _) in enumerate(texts):
        if d is not None:
            r = root(i)
            least[r] = d if least[r] is None else min(least[r], d)
    return sorted((str(d), len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(texts))


def test_ngram_jaccard(docs, texts):
    from hearth.llm.ngram_jaccard import near_duplicates
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in near_duplicates(docs).collect())
    assert got == brute_components(texts)


def test_one_of_each_group(docs, texts):
    from hearth.llm.ngram_jaccard import one_of_each_group
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    expected = collections.Counter(d for d, _, c in brute_components(texts) if d == str(c) or d == "None")
    expected = {d: (n if d == "None" else 1) for d, n in expected.items()}
    assert collections.Counter(str(r.doc_id) for r in kept.select("doc_id").collect()) == expected


def test_components(spark):
    from hearth.llm.components import components
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(50)] + [(7, 7)]
    up = list(range(200))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in linked}


def test_embedding_dedup(spark):
    from hearth.llm import embedding_dedup as M
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16))
    vectors = [list(map(float, b + 0.05 * rng.standard_normal(16))) for b in base for _ in range(4)]
    vectors += [vectors[0], [2 * x for x in vectors[0]], None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15,
                [float("inf")] * 16, [1.0, 0.0], [1.0, 0.001], []]
    frame = spark.createDataFrame([(i, v, 1, 7, "x") for i, v in enumerate(vectors)],
                                  "vec_id long, embedding array<double>, label int, links long, root string")
    out = {r.vec_id: r for r in M.near_duplicates(frame).collect()}

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v) / np.linalg.norm(v)
    units = [unit(v) for v in vectors]
    links = {i: {j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95}
             for i, a in enumerate(units)}
    found, wanted = sum(out[i].n_links for i in links), sum(map(len, links.values()))
    assert all(out[i].n_links <= len(links[i]) for i in links) and found >= 0.9 * wanted
    assert out[0].component_id == 0 and out[120].component_id == 0 and not out[120].kept and out[122].kept
    assert all(out[i].kept == (out[i].component_id == i) for i in links)


def test_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    from hearth.llm import embedding_dedup as M
    monkeypatch.setattr(M, "BLOCK", 8)
    frame = spark.createDataFrame([(i, [1.0, 0.001 * i]) for i in range(60)], "vec_id long, embedding array<double>")
    out = M.near_duplicates(frame).collect()
    assert {r.component_id for r in out} == {0} and all(r.n_links == 59 for r in out)


def jump(key, n):
    key, b, j = key % 2 ** 64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (2.0 ** 31 / ((key >> 33) + 1)))
    return b


def test_sharding(docs, texts):
    from hearth.llm.sharding import shard_documents
    assert jump(256, 1024) == 520 and jump(42, 57) == 43  # published values
    out = shard_documents(docs, 24).collect()
    assert len(out) == len(texts)
    text = {d: t for d, t in texts}
    for r in out:
        raw = (text[r.doc_id] or "").encode()
        assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, 24), jump(r.doc_id or 0, 25))
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 24)
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))


def test_decontamination(spark):
    from hearth.llm.decontamination import find_leaks, drop_leaked
    rng = random.Random(5)
    items = [(i, prose(rng, 30)) for i in range(6)] + [(6, None), (7, ""), (8, "two words"), (0, None), (None, "no id at all here")]
    edited = items[1][1].split()
    for k in range(3, 30, 6):
        edited[k] = "zzz"
    partly = items[2][1].split()
    texts = [(0, prose(rng, 50) + " " + items[0][1].upper() + " " + prose(rng, 50)), (1, prose(rng, 10) + " " + " ".join(edited)),
             (2, " ".join(partly[:9]) + " " + prose(rng, 80)), (3, prose(rng, 300)), (4, None), (5, ""),
             (6, items[3][1] + "\n" + items[4][1]), (6, items[3][1] + "\n" + items[4][1]), (7, prose(rng, 20000) + " " + items[5][1])]
    bench = spark.createDataFrame([(*x, 1) for x in items + items[:2]], "item_id long, text string, doc long")
    frame = spark.createDataFrame(rows(texts), DOC_SCHEMA)
    out = find_leaks(frame, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(0, 0), (1, 1), (6, 3), (6, 3), (6, 4), (6, 4), (7, 5)]
    best = {r.doc_id: r for r in out}
    assert (best[0].first_word, best[0].last_word, best[0].score) == (50, 80, 1.0) and 0.5 <= best[1].score < 1
    assert sorted(r.doc_id for r in drop_leaked(frame, bench).collect()) == [2, 3, 4, 5]


def test_edited_copy_beside_an_exact_one(spark):
    """An exact copy makes the n-grams that an edited copy keeps the commoner ones."""
    from hearth.llm.decontamination import find_leaks
    rng = random.Random(8)
    made, expected = [], set()
    for item, (size, every) in enumerate([(30, 6), (40, 5), (30, None)]):
        w = prose(rng, size).split()
        made.append((item, " ".join(w)))
        edited = [x if every is None or k % every != 3 else f"zz{k}" for k, x in enumerate(w)]
        edited = edited[:size * 2 // 3] if every is None else edited
        for doc, copy in ((2 * item, w), (2 * item + 1, edited)):
            expected.add((doc, item))
            made.append((doc, prose(rng, 90) + " " + " ".join(copy) + " " + prose(rng, 90)))
    bench = spark.createDataFrame([x for x in made if len(x[1].split()) <= 40], "item_id long, text string")
    frame = spark.createDataFrame(rows([x for x in made if len(x[1].split()) > 40]), DOC_SCHEMA)
    out = find_leaks(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in out} == expected and len(out) == len(expected)
    assert all((r.score == 1.0) == (r.doc_id % 2 == 0) and 0.5 <= r.score for r in out)


def plain_alignment(item, text):
    """Best local score of two word lists, by the whole table."""
    above, best = [0] * (len(text) + 1), 0
    for x in item:
        now = [0]
        for j, y in enumerate(text, 1):
            now.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, now[j - 1] - 1))
        best, above = max(best, *now), now
    return best


def test_decontamination_equals_plain_alignment(spark):
    """Every pair of a small table: exact, edited and interleaved copies, parts, and common words alone."""
    from hearth.llm.decontamination import find_leaks
    rng = random.Random(12)
    common = "the of and to in".split()
    word = lambda: rng.choice(common) if rng.random() < 0.4 else prose(rng, 1)
    items = [[word() for _ in range(n)] for n in (3, 4, 5, 7, 12, 20, 30, 30, 31, 50)] + [["the"] * 8, ["the", "of"] * 6]
    texts = [" ".join(word() for _ in range(rng.randint(0, 150))) for _ in range(15)]
    for w in items:
        copies = [list(w), w[:len(w) // 2], w[len(w) // 2 - 1:], w[::-1],
                  [x for i, x in enumerate(w) for x in ([x, prose(rng, 1)] if i % 2 else [x])],     # a word after every second
                  [x for v in w for x in (v, prose(rng, 1))],                                         # after every word
                  [prose(rng, 1) if i % 3 == 2 else x for i, x in enumerate(w)],                      # every third replaced
                  [x for i, x in enumerate(w) if i % 3], [rng.choice(w) for _ in w]]
        texts += [" ".join([*(word() for _ in range(rng.randint(0, 30))), *c, *(word() for _ in range(rng.randint(0, 30)))]).upper() for c in copies]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame([(100 + i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in find_leaks(docs, bench).collect()}
    expected = {}
    for d, t in enumerate(texts):
        for i, w in enumerate(items):
            score = plain_alignment([x.lower() for x in w], t.lower().split())
            if score >= max(len(w), 2 * min(len(w), 5)):
                expected[d, 100 + i] = score / (2 * len(w))
    assert got == pytest.approx(expected) and len(expected) > 60


def test_rows_are_judged_by_key_and_text(spark):
    from hearth.llm.decontamination import drop_leaked
    from hearth.llm.ngram_jaccard import one_of_each_group
    rng = random.Random(2)
    item, clean, copy = prose(rng, 30), prose(rng, 40), prose(rng, 50)
    table = [(1, None), (1, "x y z"), (2, clean), (2, f"a b {item} c"), (3, copy), (4, copy), (4, "another text of its own"), (5, ""), (5, None),
             (6, clean), (6, clean), (None, copy), (None, item), (None, "loose")]
    docs = spark.createDataFrame([(i, t, "s", 1, 2, "k") for i, t in table], "doc_id long, text string, name string, sum long, key long, doc string").repartition(3)
    rows_of = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    gone = [(4, copy), (6, clean), (6, clean)]
    left = list(table)
    for g in gone:
        left.remove(g)
    assert rows_of(kept) == sorted(left, key=str)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert rows_of(drop_leaked(docs, bench)) == sorted(((i, t) for i, t in table if not t or item not in t), key=str)
    assert one_of_each_group(docs.limit(0)).count() == 0 and drop_leaked(docs.limit(0), bench).count() == 0
    assert drop_leaked(docs, bench.limit(0)).count() == len(table)


def test_sharding_carries_columns(docs, texts):
    from hearth.llm.sharding import shard_documents
    plain = {(str(r.doc_id), r.text_crc32, r.shard, r.slot, r.grown_shard) for r in shard_documents(docs, 24).collect()}
    carried = shard_documents(docs, 24, carry=("text", "lang", "source")).collect()
    assert {(str(r.doc_id), r.text_crc32, r.shard, r.slot, r.grown_shard) for r in carried} == plain and len(carried) == len(texts)
    assert all(zlib.crc32((r.text or "").encode()) == r.text_crc32 and r.lang == "en" for r in carried)


def test_language_model(docs, texts):
    from hearth.llm.suffix_tree_lm import score_documents
    out = score_documents(docs).collect()
    assert len(out) == len(texts)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    tokens = lambda t: [*words(t), None]
    counts = collections.Counter(w for d, t in texts if not held(d) for w in tokens(t))
    n = sum(counts.values())
    text = {d: t for d, t in texts}
    for r in out:
        t = tokens(text[r.doc_id])
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (len(counts) + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and math.isfinite(r.score) and r.score < 0


def test_suffix_tree_is_a_distribution():
    from hearth.llm import suffix_tree_lm as L
    rng = np.random.default_rng(0)
    symbols = np.concatenate([np.zeros(L.DEPTH, np.uint8), rng.choice([1, 3, 4, 5], 20000, p=[.1, .4, .3, .2]).astype(np.uint8)])
    code = L.contexts(symbols) << L.BITS | symbols[L.DEPTH:]
    import pyarrow as pa
    from hearth.llm import textops as T
    codes, counts = np.unique(code, return_counts=True)
    part = pa.table({"codes": [T.pack(codes)], "counts": [T.pack(counts)]})

    def built(cache_share):
        got = L._tree_rows(len(code), cache_share)([pa.scalar(0)], part)
        pick = lambda kind, *names: [got.filter(pa.compute.equal(got["kind"], kind)).column(c).to_numpy() for c in names]
        return L.SuffixTree(*pick(L.GRAM, "depth", "context", "symbol", "count", "kept"),
                            pick(L.BEYOND, "depth", "context", "symbol")), pick(L.SUBTREE, "depth", "grams", "counts")
    tree, (depths, grams, times) = built(0)
    assert np.allclose((10.0 ** tree.log.reshape(-1, L.SYMBOLS)).sum(1), 1, atol=1e-4)
    entropy = -sum(p * math.log10(p) for p in (.1, .4, .3, .2))
    fresh = np.concatenate([symbols[:L.DEPTH], rng.choice([1, 3, 4, 5], 20000, p=[.1, .4, .3, .2]).astype(np.uint8)])
    assert -tree.log10(fresh).mean() == pytest.approx(entropy, abs=0.03)
    # A cache of a few contexts and the parts of the tree beyond it give what the whole tree gives.
    whole, outside = tree.score(fresh)
    assert not len(outside)
    deep = L.deep_probability(tree.first, {int(d): (np.frombuffer(g, np.int64), np.frombuffer(n, np.int64))
                                           for d, g, n in zip(depths, grams, times)})
    code = L.contexts(fresh) << L.BITS | fresh[L.DEPTH:]
    assert np.allclose(np.log10(deep(code)), whole, atol=1e-5)
    small, outside = built(0.05)[0].score(fresh)
    assert 0 < len(outside) and len(built(0.05)[0].log) < len(tree.log)
    small[outside] = np.log10(deep(code[outside]))
    assert np.allclose(small, whole, atol=1e-5)
    assert np.array_equal(L.from_planes(L.planes(code), np.int64), code)


def test_ngram_counts_leave_in_small_batches():
    """A partition's counts are complete, and no batch holds them all."""
    from hearth.llm import suffix_tree_lm as L
    rng = random.Random(3)
    made = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(40)]
    symbol, _ = L.alphabet(np.bincount(np.frombuffer("".join(made).encode(), np.uint8), minlength=256))
    batch = pa.RecordBatch.from_arrays([pa.array(made)], ["text"])
    got, largest = collections.Counter(), 0
    for b in L._ngram_counts(symbol, 64, block=5000)([batch]):
        size = 0
        for codes, counts in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            got.update(dict(zip(np.frombuffer(codes, np.int64).tolist(), np.frombuffer(counts, np.int64).tolist())))
            size += len(codes) // 8
        largest = max(largest, size)
    want = collections.Counter()
    for t in made:
        text = [L.END] * L.DEPTH + [int(symbol[ord(c)]) for w in t.split() for c in w + " "] + [L.END]
        text = [L.BLANK if v == symbol[ord(" ")] else v for v in text]
        for i in range(L.DEPTH, len(text)):
            code = 0
            for v in text[i - L.DEPTH:i + 1]:
                code = code << L.BITS | v
            want[code] += 1
    assert got == want and largest < 10_000 < len(want)


def test_suffix_tree_cache_changes_no_score(spark, docs):
    """The score is the same with nothing, little or everything cached, and by a plain walk of the whole
    tree; a context that stands a fixed number of times is there whatever the size of the corpus."""
    from hearth.llm import suffix_tree_lm as L
    from hearth.llm.suffix_tree_lm import score_documents
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdeét"), rng.integers(1, 8))) for _ in range(60)]
    many = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary, rng.integers(0, 80)))) for i in range(400)]
                                 + [(None, "A b"), (7, None), (7, "")], "doc_id long, text string").repartition(3, "doc_id")
    found = {}
    for cut in (0.0, 0.002, 2.0):
        rows = score_documents(many, cache_share=cut, word_share=cut * 10).collect()
        assert len(rows) == 403
        found[cut] = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.score, r.base_score) for r in rows)
    for cut in (0.002, 2.0):
        assert [x[:4] for x in found[cut]] == [x[:4] for x in found[0.0]]
        assert np.allclose([x[4:] for x in found[cut]], [x[4:] for x in found[0.0]], rtol=1e-5)
    # A rare passage's contexts are retained in a corpus of any size: here 12 times among 12 and 3000 texts.
    for others in (0, 3000):
        rare = [(i, "qzzqxq") for i in range(12)]
        plain = [(100 + i, " ".join(rng.choice(vocabulary, 40))) for i in range(others)]
        model = L.learn(spark.createDataFrame(rare + plain, "doc_id long, text string"))
        q = model.symbol[ord("q")]
        held = [np.frombuffer(r.grams, np.int64) >> L.BITS for r in model.sub_trees.collect() if r.depth == 2]
        names = np.unique(np.concatenate(held))
        assert {int(x) for x in names[(names >> L.BITS == q) | (names & 63 == q)]} >= {
            int(model.symbol[ord(far)]) << L.BITS | int(model.symbol[ord(near)]) for far, near in ("qz", "zq", "qx", "xq")}


def test_license_scan(spark):
    from hearth.llm.license_scan import rules, scan_licenses
    assert len(rules()) > 200
    texts = [(0, None), (1, ""), (2, "MIT-License and the mit license; Apache\nLicense, GENERAL public LICENSE"),
             (3, "Licensed under the Apache License, Version 2.0."), (4, "É public license mit É license"),
             (5, "x " * 20000 + "Released under the MIT License."), (6, "licensed under CC BY-NC 4.0"), (6, "licensed under CC BY-NC 4.0"),
             (None, "the mit license")]
    out = scan_licenses(spark.createDataFrame(rows(texts), DOC_SCHEMA)).collect()
    assert len(out) == len(texts)
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    got = {r.doc_id: r for r in out}
    for d, t in texts:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hits = [(k, label) for label, p in phrases.items() for k in range(len(w)) if w[k:k + len(p)] == p]
        r = got[d]
        assert (r.n_words, r.n_base) == (len(w), len(hits))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and 0 <= r.score <= 1
        assert {x for _, x in hits} <= set(r.labels.split(","))
    assert "apache-2.0" in got[3].labels.split(",") and got[6].labels == "cc-by-nc" and got[1].labels == ""


def test_license_scan_beside_unicode_line_ends(spark):
    """U+0085, U+2028 and U+2029 are parts of words, not ends of lines."""
    from hearth.llm.license_scan import scan_licenses
    text = "one two\u2028half three\u0085 four mit license five\u2029 mit license"
    r = scan_licenses(spark.createDataFrame(rows([(1, text)]), DOC_SCHEMA)).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (9, 2, 4, 7, "mit")


@pytest.mark.parametrize("hot", [20000, 2])
def test_substring_dedup(docs, texts, monkeypatch, hot):
    from hearth.llm import fm_dedup as M
    monkeypatch.setattr(M, "HOT", hot)
    monkeypatch.setattr(M, "PER_SHARD", 3000)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.md5(r.kept.encode()).hexdigest()) for r in M.remove_repeated(docs).collect())
    seen = collections.Counter(tuple(w[i:i + 35]) for _, t in texts for w in [words(t, False)] for i in range(len(w) - 34))
    expected = []
    for d, t in texts:
        w = words(t, False)
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        expected.append((str(d), len(w), len(gone), hashlib.md5(left).hexdigest()))
    assert got == sorted(expected)


def test_line_dedup(spark):
    from hearth.llm.line_dedup import drop_site_boilerplate
    page = "<html><body><nav>Home</nav><p>Text {0}<b>bold</b></p><p>Home</p><script>var x</script></body></html>"
    pages = [(i, "https://u@A.example.org:80/p?q", page.format(i), "x") for i in range(12)]
    pages += [(20, None, None, "x"), (21, "bad", "", "x"), (22, "http://b.example.org/", "<p>Home</p>", "x"), (22, "http://b.example.org/", "<p>Home</p>", "x")]
    out = drop_site_boilerplate(spark.createDataFrame(pages, "page_id long, url string, html string, host string")).collect()
    got = collections.Counter((r.page_id, r.host, r.n_lines, r.n_dropped, r.text) for r in out)
    assert got == collections.Counter([(i, "a.example.org", 3, 2, f"Text {i}bold") for i in range(12)] + [
        (20, "", 0, 0, ""), (21, "", 0, 0, "")] + [(22, "b.example.org", 1, 0, "Home")] * 2)


def test_line_dedup_of_small_hosts_and_long_pages(spark, monkeypatch):
    import time

    from hearth.llm import line_dedup as M
    pages = [(i, "http://small.example/%d" % i, f"<p>text {i}</p><p>shared by two</p><div>footer</div>" if i < 2 else f"<p>text {i}</p><div>footer</div>", "x", "y")
             for i in range(9)]
    pages += [(20, "http://one.example/", "<p>footer</p>", "x", "y"), (21, "http://two.example/a", "<p>same</p>", "x", "y"),
              (22, "http://two.example/b", "<p>same</p>", "x", "y"), (23, "http://bad.example/", "a < b <p>open <!-- never closed <p>gone", "x", "y"),
              (24, "http://bad.example/2", "x <b>bold</b> <script src=q>if (a < b) {}</script> end <style>unclosed", "x", "y")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, lines string, common string")
    expected = {i: f"text {i}" + ("\nshared by two" if i < 2 else "") for i in range(9)}
    expected |= {20: "footer", 21: "same", 22: "same", 23: "a < b\nopen", 24: "x bold\nend"}
    assert {r.page_id: r.text for r in M.drop_site_boilerplate(frame).collect()} == expected
    monkeypatch.setattr(M, "BROADCAST_BYTES", -1)
    assert {r.page_id: r.text for r in M.drop_site_boilerplate(frame).collect()} == expected
    million = 1 << 20
    long = [(i, "u", part * (million // len(part)), "x", "y") for i, part in enumerate(["<", "<!--", "<script", "<div ", "<!-- -->", "</", "x\n", "<script>"])]
    began = time.time()
    out = M.drop_site_boilerplate(spark.createDataFrame(long, frame.schema)).collect()
    assert len(out) == len(long) and time.time() - began < 20


def test_toxicity(spark):
    from hearth.llm import toxicity as M
    rng = random.Random(2)
    made, labels = [(0, None), (1, "")], [(0, 0), (1, None)]
    for i in range(2, 240):
        w = prose(rng, rng.randint(20, 150)).split()
        if i % 3 == 0:
            for _ in range(4):
                w[rng.randrange(len(w))] = "zork" + rng.choice(["", "ed", "ing"])
        made.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0)))
    made += [(500, prose(rng, 3000) + " zorked zork zorking"), (501, prose(rng, 3000)), (501, prose(rng, 10))]
    frame = spark.createDataFrame(rows(made), DOC_SCHEMA)
    lab = spark.createDataFrame([(d, 1, t, "x") for d, t in labels + [(None, 1)]], "doc_id long, quality int, toxic int, text string")
    out = {}
    for r in M.score_toxicity(frame, lab).collect():
        out.setdefault(r.doc_id, r)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    judged = [(out[d].predicted, t) for d, t in labels if out[d].held_out and d > 1]
    assert sum(p == t for p, t in judged) >= 0.9 * len(judged)
    assert out[0].predicted == out[1].predicted == 0
    none = M.score_toxicity(frame, lab.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}


def test_toxicity_of_long_texts(spark, monkeypatch):
    """Windows beside the evenly spaced ones count, in training and for the threshold."""
    from hearth.llm import toxicity as M
    monkeypatch.setattr(M, "SAMPLE_WINDOWS", 6)
    rng = random.Random(4)
    made, labels = [], []
    for i in range(240):
        w = prose(rng, 1300).split()
        if i % 2:
            at = rng.randrange(1290)
            w[at:at + 4] = ["zork", "zorked", "zorking", "zorks"]
        made.append((i, " ".join(w)))
        labels.append((i, i % 2))
    frame = spark.createDataFrame(rows(made), DOC_SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = M.train(frame, lab)
    score = np.array([model.score(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] for _, t in made])
    taught = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in made])
    toxic = np.array([t == 1 for _, t in labels])
    assert ((score > 0) != toxic)[~taught].mean() <= 0.1
    # No other threshold errs less on the texts learned from.
    assert ((score > 0) != toxic)[taught].sum() == ((score > M.Toxicity._cut(score[taught], toxic[taught])) != toxic)[taught].sum()


def test_toxicity_learns_from_all_labelled_texts(spark, monkeypatch):
    """Counts, training and the threshold take every labelled document that is not held out."""
    from hearth.llm import toxicity as M
    rng = random.Random(6)
    made = [(i, prose(rng, 7) + (" zork" if i % 2 else "") + (f" rare{i // 4}" if i % 50 < 4 else "")) for i in range(6000)]
    taught = {i: t for i, t in made if zlib.crc32(str(i).encode()) % 5 != 0}
    staged, stage = {}, M.stage

    def spy(frame, name):
        staged[name] = stage(frame, name)
        return staged[name]
    monkeypatch.setattr(M, "stage", spy)
    model = M.train(spark.createDataFrame(rows(made), DOC_SCHEMA), spark.createDataFrame([(i, i % 2) for i, _ in made], "doc_id long, toxic int"))
    assert [f.count() for f in staged.values() if "text" in f.columns] == [len(taught)]
    held = {}
    for i, t in taught.items():
        for w in set(t.split()):
            n, p = held.get(w, (0, 0))
            held[w] = n + 1, p + i % 2
    words = sorted(held)
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = M.T.hash_spans(data, ends - [len(w) for w in words], ends).view(np.int64).tolist()
    counted = {r["hash"]: (r["held"], r["positive"]) for r in staged["toxicity_counts"].where(F.col("kind") == M.WORD).collect()}
    assert counted == {h: held[w] for h, w in zip(hashes, words)}
    logit = np.array([r["logit"] for r in staged["toxicity_logits"].select("logit").collect()])
    assert len(logit) == len(taught)
    score = np.array([model.score(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] for t in taught.values()])
    assert ((score > 0) != np.array([i % 2 == 1 for i in taught])).sum() == 0


@pytest.mark.parametrize("digits", [1, 6])
def test_toxicity_threshold_equals_all_thresholds(spark, digits):
    from hearth.llm import toxicity as M
    r = np.random.default_rng(digits)
    toxic = r.random(400) < 0.3
    logit = np.round(r.standard_normal(400) + 2 * toxic, digits)
    cut = M._threshold(spark.createDataFrame([(int(t), float(v)) for t, v in zip(toxic, logit)], "toxic int, logit double"))
    values = np.unique(logit)
    edges = [values[0] - 1, *(values[1:] + values[:-1]) / 2, values[-1] + 1]
    width = [1, *np.diff(values), 1]
    errors = [((logit > e) != toxic).sum() for e in edges]
    best = min(range(len(edges)), key=lambda k: (errors[k], -width[k], edges[k]))
    assert cut == pytest.approx(edges[best]) and ((logit > cut) != toxic).sum() == errors[best]
    if digits == 6:
        assert cut == pytest.approx(M.Toxicity._cut(logit, toxic))


def test_fast_logits_equal_the_forward_pass():
    from hearth.llm import toxicity as M
    net, r = M.Net(2), np.random.default_rng(1)
    xw = net.project(r.standard_normal((50, 2 * M.EMBED)).astype(np.float32))
    index = r.integers(0, 50, (30, M.WINDOW))
    index[::3, 20:] = 50
    assert np.allclose(net.logits(net.gates(xw), index), net.forward(xw, index), atol=1e-5)


def test_recurrent_gradients():
    from hearth.llm import toxicity as M
    net, r = M.Net(1), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, index = r.standard_normal((6, 2 * M.EMBED)), r.integers(0, 7, (5, 9))
    index[0, 5:] = 6
    y, w = np.array([0, 1, 1, 0, 1.0]), np.ones(5)

    def loss():
        s = M.sigmoid(net.forward(net.project(x), index))
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()
    _, g, _ = net.gradients(x, index, y, w)
    for k in ("wx", "bx", "uzr", "un", "wa", "va", "wo", "bo"):
        at = tuple(r.integers(0, s) for s in net.p[k].shape)
        keep = net.p[k][at]
        net.p[k][at] = keep + 1e-2
        up = loss()
        net.p[k][at] = keep - 1e-2
        down = loss()
        net.p[k][at] = keep
        assert (up - down) / 2e-2 == pytest.approx(g[k][at], rel=0.02, abs=1e-5)


def test_mixing(docs, texts):
    from hearth.llm.mixing import mix_sources, mixed
    frame = rows(texts)
    size = collections.Counter()
    for r in frame:
        size[r[3]] += len(words(r[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = sum(size.values()), {}, set(order)
    while True:  # clamp and reshare until none is above its cap
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * size[s]
            free.remove(s)
    out = mix_sources(docs).collect()
    taken, largest = collections.Counter(), max(len(words(t)) for _, t in texts)
    for r in out:
        n = r["__size"]
        assert r["__target"] == pytest.approx(target[r.source]) and r["__source_size"] == size[r.source]
        assert 0 <= r["__times"] <= 3 and n == len(words({d: t for d, t in texts}[r.doc_id]))
        taken[r.source] += n * r["__times"]
    assert all(abs(taken[s] - target[s]) <= largest for s in order)
    copies = mixed(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["__times"] for r in out)


def test_mixing_splits_copies_and_keeps_any_column(spark):
    from hearth.llm.mixing import mix_sources, mixed
    text = "one two three four"
    table = [(None, text, "a", 1, 2, 3, 4, 5)] * 500 + [(7, text, "a", 1, 2, 3, 4, 5)] * 500 + [(i, text, "b", 1, 2, 3, 4, 5) for i in range(2000)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string, cutoff long, whole long, size long, doc long, place long").repartition(4)
    out = mix_sources(docs).collect()
    for source in "ab":
        mine = [r for r in out if r.source == source]
        taken = sum(r["__size"] * r["__times"] for r in mine)
        assert abs(taken - mine[0]["__target"]) <= 4 and all(0 <= r["__times"] <= 3 for r in mine)
    count = lambda: collections.Counter((r.doc_id, r.source) for r in mixed(docs).collect())
    assert count() == count() and mixed(docs).columns == docs.columns


def test_empty_tables(spark):
    from hearth.llm import (decontamination, embedding_dedup, fm_dedup, license_scan, line_dedup, mixing, ngram_jaccard,
                            sharding, suffix_tree_lm, toxicity)
    docs = spark.createDataFrame([], DOC_SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(rows([(1, "a few words of text")]), DOC_SCHEMA)
    for out in (ngram_jaccard.near_duplicates(docs), fm_dedup.remove_repeated(docs), sharding.shard_documents(docs),
                decontamination.find_leaks(docs, bench), decontamination.find_leaks(some, bench), suffix_tree_lm.score_documents(docs),
                license_scan.scan_licenses(docs), toxicity.score_toxicity(docs, labels), mixing.mix_sources(docs), mixing.mixed(docs),
                line_dedup.drop_site_boilerplate(spark.createDataFrame([], "page_id long, url string, html string")),
                embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert out.count() == 0


def test_pipeline(spark):
    """The stages against their operators' rows and brute force, on the smallest tables."""
    import corpus_pipeline
    from tests.conftest import SMALL_SF
    from hearth.llm.decontamination import find_leaks
    from hearth.llm.mixing import mix_sources
    from hearth.llm.toxicity import score_toxicity
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    table = lambda n: spark.read.parquet(f"{SMALL_SF}/{n}.parquet")
    docs = table("documents")
    clean = {r.doc_id for r in score_toxicity(docs, table("labels")).where("predicted = 0").collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in clean]
    kept = [d for d, _, c in brute_components(texts) if d == str(c)]
    kept = docs.where(docs.doc_id.isin([int(d) for d in kept]))
    leaked = {r.doc_id for r in find_leaks(kept, table("benchmark")).collect()}
    kept = kept.where(~kept.doc_id.isin(list(leaked))) if leaked else kept
    times = collections.Counter({r.doc_id: r["__times"] for r in mix_sources(kept).collect()})
    out = corpus_pipeline.run(spark, SMALL_SF).collect()
    assert collections.Counter(r.doc_id for r in out) == +times
    assert all(r.shard == jump(r.doc_id, 24) for r in out)


def test_functions_for_workers_take_no_computed_tables_along():
    """Hashing in the driver must not swell what is sent to workers afterwards."""
    from pyspark import cloudpickle

    from hearth.llm import ngram_jaccard
    from hearth.llm import textops as T
    words, _ = T.hash_words(np.frombuffer(b"some words hashed here", np.uint8), np.array([0, 22]))
    sent = cloudpickle.dumps(ngram_jaccard._signatures(5))
    assert len(sent) < 100_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words hashed here"])], ["doc_id", "text"])
    assert len(words) == 4
    assert next(cloudpickle.loads(sent)([batch])).equals(next(ngram_jaccard._signatures(5)([batch])))
