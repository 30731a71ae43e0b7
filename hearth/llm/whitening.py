"""Embedding whitening by the exact characteristic polynomial.

Vectors become integers, so their scatter matrix is exact. Its characteristic polynomial is
found modulo many primes (each by a Hessenberg reduction, one Spark task row for each prime)
and put together by Chinese remaindering. All its roots are real, so the number of roots
above any point is exactly the number of sign changes of the shifted polynomial; halving
intervals isolates the largest roots to many more digits than a double holds. The
components are null vectors of scatter - root, by inverse iteration in long decimals.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import stage

SCALE = 256
COMPONENTS = 4
LIMB = 15              # bits of a factor: products of two, summed over BLOCK rows, are exact in a double
BLOCK = 1 << 20
PRIME_BITS = 31        # products of two residues fit a signed long
ROOT_BITS = 128        # binary places of an isolated root behind the point
SUM_LIMB = 40          # bits of the parts that exact sums are shuffled in


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or an entry whose integer is not a finite long."""
    bound = float(1 << 63) / SCALE
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(bound), F.lit(False)))
    # NaN counts as larger than any number; the coalesce settles null entries.
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def as_integers(vector: Column) -> Column:
    """floor(256 c) of each entry, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))


# --- exact moments -----------------------------------------------------------------------

def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; a shorter vector counts as 0 in the dimensions it lacks."""
    at = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy()
    sizes = np.diff(at)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(at[0], at[-1]) - np.repeat(at[:-1], sizes)] = flat[at[0]:at[-1]]
    return out


def exact_gram(x: np.ndarray) -> list[list[int]]:
    """x' x of an integer matrix, exact: factors are cut into limbs whose products a double holds."""
    width = x.shape[1]
    total = [[0] * width for _ in range(width)]
    for lo in range(0, len(x), BLOCK):
        rest, limbs = x[lo:lo + BLOCK], []
        while rest.any():
            low = rest & ((1 << LIMB) - 1)
            # A negative number's limbs end in an endless row of -1: taken as one.
            if not ((rest >> LIMB) + (rest < 0)).any():
                low, rest = rest, np.zeros_like(rest)
            else:
                rest = rest >> LIMB
            limbs.append(low.astype(np.float64))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                part = (a.T @ b).astype(np.int64).tolist()
                for r in range(width):
                    total[r] = [t + (v << LIMB * (i + j)) for t, v in zip(total[r], part[r])]
    return total


def _parts(value: int) -> list[int]:
    """Signed limbs of an integer, lowest first."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << SUM_LIMB) - 1)))
        value >>= SUM_LIMB
    return out


def _moments(width):
    """(cell, limb, part): one task's rows, sums and upper gram, in limbs."""
    def run(batches):
        n, sums, gram = 0, [0] * width, [[0] * width for _ in range(width)]
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            wide = int(np.abs(x).max(initial=0)) * len(x) >= 1 << 62
            sums = [a + int(b) for a, b in zip(sums, (x.astype(object) if wide else x).sum(0))]
            gram = [[a + b for a, b in zip(r, s)] for r, s in zip(gram, exact_gram(x))]
        cells = [n, *sums, *(gram[i][j] for i in range(width) for j in range(i, width))]
        rows = [(c, k, p) for c, v in enumerate(cells) for k, p in enumerate(_parts(v))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["cell", "limb", "part"])
    return run


def exact_moments(fit: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sum of outer products) of the integer vectors in column x, exact.

    The driver takes one row for each cell of the matrix, however many vectors there are."""
    parts = fit.select("x").mapInArrow(_moments(width), "cell long, limb long, part long")
    got = parts.groupBy("cell", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    cells = [0] * (1 + width + width * (width + 1) // 2)
    for r in got:
        cells[r["cell"]] += int(r["part"]) << SUM_LIMB * r["limb"]
    gram = [[0] * width for _ in range(width)]
    at = iter(cells[1 + width:])
    for i in range(width):
        for j in range(i, width):
            gram[i][j] = gram[j][i] = next(at)
    return cells[0], cells[1:1 + width], gram


def scatter_of(n: int, sums: list[int], gram: list[list[int]]) -> list[list[int]]:
    """n * gram - sums sums': n squared times the covariance, the exact centred scatter."""
    return [[n * g - a * b for g, b in zip(row, sums)] for row, a in zip(gram, sums)]


# --- characteristic polynomial -------------------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3 * 10**9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_below(bits: int, product_bits: int) -> list[int]:
    """The largest primes of so many bits whose product has more than ``product_bits`` bits."""
    out, p, have = [], (1 << bits) - 1, 0.0
    while have <= product_bits:
        if is_prime(p):
            out.append(p)
            have += math.log2(p)
        p -= 2
    return out


def char_poly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """det(t - matrix) modulo p, constant first: Hessenberg reduction, then the recurrence
    of the leading blocks' polynomials."""
    h = matrix % p
    d = len(h)
    for c in range(d - 2):
        pivot = np.flatnonzero(h[c + 1:, c])
        if not len(pivot):
            continue
        r = c + 1 + int(pivot[0])
        if r != c + 1:
            h[[r, c + 1]] = h[[c + 1, r]]
            h[:, [r, c + 1]] = h[:, [c + 1, r]]
        factor = h[c + 2:, c] * pow(int(h[c + 1, c]), -1, p) % p
        h[c + 2:] = (h[c + 2:] - factor[:, None] * h[c + 1]) % p
        # The same similarity on columns: column c + 1 takes up the others, each product reduced.
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2:] * factor % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - h[k - 1, k - 1] * polys[k - 1]) % p
        chain = 1
        for i in range(1, k):
            chain = chain * int(h[k - i, k - i - 1]) % p
            if not chain:
                break
            polys[k] = (polys[k] - chain * int(h[k - i - 1, k - 1]) % p * polys[k - i - 1]) % p
    return polys[d].tolist()


def _residues(matrix):
    def run(batches):
        for batch in batches:
            primes = batch.column(0).to_pylist()
            polys = [char_poly_mod(np.array([[v % p for v in row] for row in matrix], np.int64), p) for p in primes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(polys, pa.list_(pa.int64()))], ["prime", "poly"])
    return run


def char_poly(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """det(t - matrix) of a symmetric integer matrix without negative roots, constant first, exact.

    The coefficients are elementary symmetric functions of the roots, so they are at most
    those of d roots of trace / d each (Maclaurin). Primes whose product is more than
    twice that are dealt out to tasks; d + 1 residues come back for each."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # binom(d, k) (trace / d)**k, rounded up in logarithms
    bound = max(math.log2(math.comb(d, k)) + k * max(0.0, math.log2(trace) - math.log2(d)) for k in range(d + 1)) if trace else 1.0
    primes = primes_below(PRIME_BITS, math.ceil(bound) + 4)
    tasks = max(1, min(len(primes), int(spark.sparkContext.defaultParallelism) * 2))
    rows = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    got = rows.mapInArrow(_residues(matrix), "prime long, poly array<long>").collect()
    product = math.prod(primes)
    total = [0] * (d + 1)
    for r in got:
        p = r["prime"]
        others = product // p
        weight = others * pow(others, -1, p)
        total = [t + weight * c for t, c in zip(total, r["poly"])]
    total = [t % product for t in total]
    return [t - product if t > product // 2 else t for t in total]


# --- roots -----------------------------------------------------------------------------------

def roots_above(poly: list[int], point: int) -> int:
    """How many roots exceed ``point``, with multiplicity: exact, as all roots are real
    (the sign changes of the polynomial shifted there)."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int, bits: int = ROOT_BITS) -> list[int]:
    """The ``count`` largest roots with multiplicity, falling, as integers scaled by 2**bits:
    each lies in (value - 1, value] of that scale. Roots closer than that come out equal.

    Halving starts from bounds in whole numbers and isolates all of them together: an interval
    without a wanted root is dropped, one with several is halved for all at once."""
    d = len(poly) - 1
    # t -> t / 2**bits, in whole numbers: roots scale by 2**bits
    scaled = [c << bits * (d - i) for i, c in enumerate(poly)]
    high = 1
    while roots_above(poly, high):
        high <<= 1
    found: list[int] = []
    # (low, high, roots above low, roots above high): wanted are the first ``count`` from above
    work = [(-1 << bits, high << bits, d, 0)]
    while work:
        lo, hi, over_lo, over_hi = work.pop()
        if over_hi >= count or over_lo == over_hi:
            continue
        if hi - lo == 1:
            found += [hi] * (over_lo - over_hi)
            continue
        mid = (lo + hi) // 2
        over = roots_above(scaled, mid)
        work += [(lo, mid, over_lo, over), (mid, hi, over, over_hi)]  # the upper half first
    return found[:count]


# --- components ------------------------------------------------------------------------------

def null_vectors(matrix: list[list[int]], root: Decimal, many: int, digits: int) -> list[list[Decimal]]:
    """``many`` orthonormal vectors that matrix - root sends (nearly) to 0: two rounds of
    inverse iteration from fixed starts, by one elimination with row exchange."""
    d = len(matrix)
    with decimal.localcontext(decimal.Context(prec=digits, Emax=10**9, Emin=-10**9)):
        a = [[Decimal(v) for v in row] for row in matrix]
        size = max(max(abs(v) for v in row) for row in a)
        tiny = size.scaleb(-digits)
        for i in range(d):
            a[i][i] -= root
        swaps, factors = [], []
        for c in range(d):
            r = max(range(c, d), key=lambda i: abs(a[i][c]))
            a[c], a[r] = a[r], a[c]
            swaps.append(r)
            if abs(a[c][c]) < tiny:
                a[c][c] = tiny
            column = [a[i][c] / a[c][c] for i in range(c + 1, d)]
            for i, f in enumerate(column, c + 1):
                if f:
                    a[i] = [None] * (c + 1) + [v - f * u for v, u in zip(a[i][c + 1:], a[c][c + 1:])]
                else:
                    a[i] = [None] * (c + 1) + a[i][c + 1:]
            factors.append(column)

        def solve(b):
            b = list(b)
            for c in range(d):
                b[c], b[swaps[c]] = b[swaps[c]], b[c]
                for i, f in enumerate(factors[c], c + 1):
                    b[i] -= f * b[c]
            for c in reversed(range(d)):
                b[c] = (b[c] - sum((u * v for u, v in zip(a[c][c + 1:], b[c + 1:])), Decimal(0))) / a[c][c]
            return b

        def orthonormal(vectors):
            out = []
            for v in vectors:
                for _ in range(2):
                    for u in out:
                        dot = sum((x * y for x, y in zip(u, v)), Decimal(0))
                        v = [y - dot * x for x, y in zip(u, v)]
                    norm = sum((x * x for x in v), Decimal(0)).sqrt()
                    v = [x / norm for x in v]
                out.append(v)
            return out
        # Fixed starts without a pattern that a component could be orthogonal to.
        vectors = [[Decimal((i * 7919 + k * 104729 + 12345) * 2654435761 % 1000003 - 500001) for i in range(d)] for k in range(many)]
        for _ in range(2):
            vectors = orthonormal([solve(v) for v in vectors])
        return vectors


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: the fit list's size and sums, components as rows (largest
    entry positive), their eigenvalues and the shares of the variance they explain."""
    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fit_whitening(spark: SparkSession, n: int, sums: list[int], gram: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Components of the covariance gram / n - sums sums' / n**2, largest eigenvalue first;
    directions without variance are no components."""
    scatter = scatter_of(n, sums, gram)
    poly = char_poly(spark, scatter) if sums else [1]
    roots = [r for r in largest_roots(poly, components) if r > 0]
    trace = sum(scatter[i][i] for i in range(len(sums)))
    axes, values, shares = [], [], []
    digits = 60 + len(str(trace)) + ROOT_BITS // 3
    with decimal.localcontext(decimal.Context(prec=digits + 20)):
        at = 0
        while at < len(roots):
            same = roots.count(roots[at])
            root = (Decimal(roots[at]) - Decimal("0.5")) / (1 << ROOT_BITS)
            for v in null_vectors(scatter, root, same, digits):
                v = [float(x) for x in v]
                top = max(range(len(v)), key=lambda i: abs(v[i]))
                axes.append([x if v[top] > 0 else -x for x in v])
            values += [float(root / n / n)] * same
            shares += [float(root / trace)] * same
            at += same
    return Whitening(n, tuple(sums), np.array(axes).reshape(len(axes), len(sums)), np.array(values), np.array(shares))


def _centred(w: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x - sums / n in doubles, n * x - sums exact: longs, or Python integers where longs are too short)."""
    reach = w.n * (int(np.abs(x).max(initial=0)) + 1) + max((abs(s) for s in w.sums), default=0)
    whole = x.astype(np.int64 if reach < 1 << 62 else object) * w.n - np.array(w.sums, np.int64 if reach < 1 << 62 else object)
    return (whole / w.n).astype(np.float64), whole


def whiten(w: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whitened rows, centred exact rows) of integer vectors."""
    centred, whole = _centred(w, x)
    return centred @ w.axes.T / np.sqrt(w.values), whole


def _products(w):
    """One task's sums of the whitened entries and of their products."""
    def run(batches):
        k = len(w.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y, _ = whiten(w, _matrix(batch.column(0), len(w.sums)))
            first += y.sum(0)
            second += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int32()), pa.array(np.concatenate([first, second.ravel()]))],
                                         ["cell", "part"])
    return run


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(w.values)
    if not k:
        return 0.0
    got = fit.select("x").mapInArrow(_products(w), "cell int, part double").groupBy("cell").agg(F.sum("part").alias("s")).collect()
    cells = np.zeros(k + k * k)
    for r in got:
        cells[r["cell"]] = r["s"]
    mean = cells[:k] / w.n  # of centred entries: rounding only
    return float(np.abs(cells[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


def _rows(w, error):
    limit = 1 << 63

    def run(batches):
        k = len(w.values)
        for batch in batches:
            y, whole = whiten(w, _matrix(batch.column(1), len(w.sums)))
            small = whole.dtype != object and int(np.abs(whole).max(initial=0)) ** 2 * max(whole.shape[1], 1) < limit
            if small:
                deviation = pa.array((whole * whole).sum(1))
            else:
                sums = [sum(int(v) ** 2 for v in row) for row in whole]
                deviation = pa.array([v if v < limit else None for v in sums], pa.int64())
            row = np.repeat(np.arange(batch.num_rows), k)
            nth = np.tile(np.arange(k), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(nth + 1, pa.int32()), pa.array(np.full(len(row), w.n)),
                 deviation.take(pa.array(row)), pa.array(y.ravel()), pa.array(w.explained[nth]), pa.array(np.full(len(row), error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: key, component (from 1), n, deviation, whitened,
    explained, identity_error.

    A vector is usable unless it is null, holds a null or non-finite entry, or one too large
    for a long after scaling. Entries become floor(256 c); a shorter vector counts as 0 in the
    dimensions that it lacks. The fit list is each distinct integer vector once: n vectors
    with sums S. ``deviation`` is the sum of (n x - S)**2, exact (null beyond a long),
    ``whitened`` the entry x - S / n along the component over the root of its eigenvalue.
    Directions without variance are no components, so one distinct vector, or none, gives no
    rows. Repeated rows and equal or null ids stay rows of their own; other columns are not read.

    The fit list is distinct by one shuffle and staged; its moments are summed per task and
    cell. What the driver holds depends on the dimensions alone."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v"))).select(
        "id", as_integers(F.col("v")).alias("x"))
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    padded = F.when(F.size("x") < width, F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))).otherwise(F.col("x"))
    fit = stage(rows.select(padded.alias("x")).distinct(), "whitening_fit")
    n, sums, gram = exact_moments(fit, width)
    w = fit_whitening(vectors.sparkSession, n, sums, gram, components)
    out = rows.mapInArrow(_rows(w, identity_error(fit, w)), f"id {dict(rows.dtypes)['id']}, component int, n long, deviation long, "
                          "whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", key)
