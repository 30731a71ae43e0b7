"""Language identification by rank-order profiles of character n-grams.

A profile is a ranked list of the most frequent n-grams. Each language's is counted over
all its training documents; a document's own is compared with each of them by how far
every n-gram is out of place, and the nearest language wins.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm import textops as T

PROFILE = 400          # n-grams of a profile; one that a profile lacks is this far out of place
LONGEST = 3            # letters of an n-gram: 1 to 3 code points of 21 bits pack into one integer
PIECE_BYTES = 1 << 20  # text counted at once
BITS = 21
UNKNOWN = "und"


class _Letters:
    """Which code points are letters, looked up once for each that occurs."""

    def __init__(self):
        self.known = np.zeros(0x110000, np.uint8)  # 0 not looked up, 1 other, 2 letter

    def __call__(self, points: np.ndarray) -> np.ndarray:
        kind = self.known[points]
        if not kind.all():
            for p in np.unique(points[kind == 0]).tolist():
                self.known[p] = 2 if unicodedata.category(chr(p))[0] == "L" else 1
            kind = self.known[points]
        return kind == 2

    def __reduce__(self):
        return type(self), ()


def _pieces(text: str):
    """Lower-cased parts of a text, cut where no word stands, as code points."""
    at = 0
    while at < len(text):
        end = min(at + PIECE_BYTES, len(text))
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        yield np.frombuffer(text[at:end].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        at = end


def _grams(points: np.ndarray, letters: _Letters) -> np.ndarray:
    """All n-grams of the words, each word between two blanks, packed; blanks alone count nothing."""
    letter = letters(points)
    if not letter.any():
        return np.zeros(0, np.int64)
    # Runs of other characters become one blank (0), which parts two words.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    line = np.where(letter, points, 0)[keep].astype(np.int64)
    line = np.concatenate([[0], line, [0]] if line[-1] else [[0], line])
    out = [line[line > 0]]
    two = line[:-1] << BITS | line[1:]
    out.append(two[(line[:-1] > 0) | (line[1:] > 0)] | 1 << 2 * BITS + 20)
    if len(line) > 2:
        three = line[:-2] << 2 * BITS | line[1:-1] << BITS | line[2:]
        out.append(three[line[1:-1] > 0])
    return np.concatenate(out)


def count_grams(text: str | None, letters: _Letters) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams ascending, counts) of a whole text."""
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for points in _pieces(text or ""):
        g, c = np.unique(_grams(points, letters), return_counts=True)
        if len(grams):
            g, at = np.unique(np.concatenate([grams, g]), return_inverse=True)
            c = np.bincount(at, np.concatenate([counts, c])).astype(np.int64)
        grams, counts = g, c
    return grams, counts


def most_frequent(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The profile: n-grams by falling count, equal counts by n-gram."""
    if len(grams) > size:  # only those that may be among the first
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= floor], counts[counts >= floor]
    return grams[np.lexsort((grams, -counts))][:size]


class Profiles:
    """The languages' profiles: for each n-gram the languages that rank it, and where."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, rank: np.ndarray):
        order = np.lexsort((lang, gram))
        self.langs, self.lang, self.rank = langs, lang[order], rank[order]
        self.grams, self.at = np.unique(gram[order], return_index=True)
        self.at = np.append(self.at, len(gram))

    def nearest(self, profile: np.ndarray) -> tuple[int, float]:
        """(language, share of the greatest distance that it is nearer): least distance, ties by name."""
        spot = np.minimum(np.searchsorted(self.grams, profile), len(self.grams) - 1)
        mine = np.flatnonzero(self.grams[spot] == profile)
        a, n = self.at[spot[mine]], np.diff(self.at)[spot[mine]]
        entry = np.repeat(a - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        saved = PROFILE - np.abs(self.rank[entry] - np.repeat(mine, n))
        near = np.bincount(self.lang[entry], saved, len(self.langs))
        best = int(near.argmax())
        return best, float(near[best]) / (PROFILE * len(profile))


def held_out(key: str):
    """Rows never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 3 == 1


def _counted(letters):
    """(lang, gram, n): one partial count for each language of a task."""
    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = held.setdefault(lang, [0])
                g, c = count_grams(text, letters)
                mine.append((g, c))
                mine[0] += len(g)
                if mine[0] > 1 << 20:
                    mine[:] = _merged(mine[1:])
        for lang, mine in held.items():
            for g, c in _merged(mine[1:])[1:]:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(c)],
                                                 ["lang", "gram", "n"])
    return run


def _merged(counted: list) -> list:
    """[0, (grams, counts)]: several counts in one."""
    g, at = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
    return [0, (g, np.bincount(at, np.concatenate([c for _, c in counted])).astype(np.int64))]


def learn_profiles(labelled: DataFrame) -> Profiles | None:
    """Profiles of (lang, text) rows: all of them are counted; None where nothing can be learned.

    Counts are summed for each task before the shuffle, and each task keeps its best
    ``PROFILE`` n-grams of a language before they are ranked, so a language that holds
    most rows meets no single task. The driver takes ``PROFILE`` rows for each language."""
    counts = labelled.select("lang", "text").mapInArrow(_counted(_Letters()), "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (counts.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= PROFILE)
           .select("lang", "gram", (F.col("rank") - 1).alias("rank")).toArrow())
    if not top.num_rows:
        return None
    names = np.array(top.column("lang").to_pylist(), object)
    langs = sorted(set(names))  # by code points
    at = {x: i for i, x in enumerate(langs)}
    return Profiles(langs, np.array([at[x] for x in names]), top.column("gram").to_numpy(), top.column("rank").to_numpy().astype(np.int64))


def _identified(profiles, letters):
    def run(batches):
        for batch in batches:
            found, score = [], []
            for text in batch.column(1).to_pylist():
                grams, counts = count_grams(text, letters)
                if not len(grams) or profiles is None:
                    found.append(UNKNOWN)
                    score.append(0.0)
                    continue
                lang, near = profiles.nearest(most_frequent(grams, counts))
                found.append(profiles.langs[lang])
                score.append(near)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(score, pa.float64())],
                                             ["id", "lang_pred", "score"])
    return run


def identify_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: key, held_out, lang_pred, score.

    A profile holds the ``PROFILE`` most frequent 1 to 3-grams of the lower-cased words
    (letters of any script, each word between blanks) of the whole text. The distance to
    a language sums how many places each of the document's n-grams is out of place there
    (``PROFILE`` where it is missing). The score is 1 - distance / greatest distance;
    among equally near languages the first by code points wins. Learned from all rows with
    a language that are not held out; a null id is not. A text that is null or has no
    letter is 'und' with score 0, and so is every text where nothing could be learned.
    Repeated rows are rows of their own and count as often as they occur; an empty table
    gives an empty result; columns but the three named ones are not read."""
    known = docs.where(F.col(lang).isNotNull() & ~held_out(key))
    profiles = learn_profiles(known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(_identified(profiles, _Letters()), f"id {kind}, lang_pred string, score double")
    return out.select(F.col("id").alias(key), held_out("id").alias("held_out"), "lang_pred", "score")
