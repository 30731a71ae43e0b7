"""License rules against a plain search: every rule at every keyword, suppression over all pairs of detections."""

import random
import re

from hearth.llm.license_scan import rules, scan_licenses

PHRASES = ["licensed under the", "released under the terms of the", "license", "licence", "spdx license identifier", "version 2 0",
           "mit", "expat", "mit no attribution", "apache", "apache software", "gnu", "gpl v3", "gpl", "lesser general public",
           "general public", "affero general public", "bsd 3 clause", "bsd", "mozilla public", "cc by sa 4 0", "creative commons",
           "public domain", "all rights reserved", "see the license file", "copyright c 2020", "proprietary", "zlib", "and", "x"]


def _brute(text):
    words = text.split(" ")
    found = set()
    for at, word in enumerate(words):
        marked = " " + " ".join(words[:at] + ["@" + word] + words[at + 1:]) + " "
        for rule, priority, weight, keyword, label, pattern, base in rules():
            m = re.search(f" ({pattern}) ", marked) if keyword == word else None
            if m:
                start = marked[:m.start(1)].count(" ") - 1
                found.add((start, start + m.group(1).count(" "), priority, rule, weight, label, base))

    def held(d):
        for e in found:
            inside = e[0] <= d[0] and d[1] <= e[1]
            same = e[:2] == d[:2]
            if inside and (e[2] < d[2] or (e[2] == d[2] and (not same or e[3] < d[3]))):
                return True
        return False
    kept = [d for d in found if d[6] or not held(d)]
    base = {(d[5], d[0]) for d in found if d[6]}
    return (len(words), len(base), ",".join(sorted({x for x, _ in base})), ",".join(sorted({d[5] for d in kept})),
            max([d[4] for d in kept], default=0.0))


def test_rules_equal_a_plain_search(spark):
    draw = random.Random(5)
    texts = [" ".join(draw.choice(PHRASES) for _ in range(draw.randint(1, 12))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_base, r.base_labels, r.labels, r.score) for r in scan_licenses(docs).collect()}
    want = {i: _brute(t) for i, t in enumerate(texts)}
    assert got == want
    assert len({v[3] for v in want.values()}) > 40
