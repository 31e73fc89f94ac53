"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Entries become integers x; the fit list holds every distinct x vector once.  With n vectors and sums S, the
matrix M = n * sum(x x') - S S' is n^2 times the covariance, in integers.  Tasks add up blocks of products (exact in
doubles below 2^53, in whole numbers beyond), a shuffle adds the d rows of the tasks' matrices, and
only the d x d matrix reaches the driver.  Its characteristic polynomial is computed modulo as many
31-bit primes as its largest coefficient needs (M has no negative eigenvalue, so the k-th is at most binomial(d, k)
(trace / d)^k): one task per prime reduces M to Hessenberg form, and Chinese remainders join the results.  All roots are real, so the
sign changes of the polynomial shifted to t count the roots above t exactly; bisection in rationals
isolates the largest ones to 2^-`BITS` of their size, one task each.  Components are the null spaces of M less a root,
by inverse iteration with `DIGITS` decimal digits, one task for each group of roots that coincide so far.

Whitened values are ((n x - S) . v) / sqrt(root of M) in doubles, so means and scale factors are never rounded first.
identity_error is measured on the whitened fit list: covariance centred by its own means, against the identity.

Edge cases: rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are rows whose
dimension is not the commonest one (ties: the largest); x saturates at +-2^62; components of zero variance are not returned, so
one distinct vector, or no row, gives no rows; a deviation beyond a long is null; repeated and null ids stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrec.session import materialize

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
BITS, DIGITS, ROUNDS = 90, 70, 60
LIMIT = float(1 << 62)
EXACT = 1 << 53


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    usable = table.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    sizes = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()

    def entry(c: Column) -> Column:
        return F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c * SCALE))).cast("bigint") + OFFSET
    return usable.where(F.size("v") == (sizes["d"] if sizes else 0)).select("vec_id", F.transform("v", entry).alias("x"))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def _products(y: np.ndarray) -> np.ndarray:
    """y' y exactly, as Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top < EXACT and top * top * len(y) < EXACT:
        y = y.astype(float)
        return (y.T @ y).astype(np.int64).astype(object)
    if len(y) > 1 and top * top < EXACT:
        return _products(y[:len(y) // 2]) + _products(y[len(y) // 2:])
    y = y.astype(object)
    return y.T.dot(y)


def _partial_scatter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per dimension i and task: rows, the sum of y_i, and the sums of y_i y_j, as text."""
    n, sums, products = 0, None, None
    for pdf in batches:
        if len(pdf):
            y = _stack(pdf["x"]) - OFFSET                  # the scatter does not change with the offset
            s, p = y.astype(object).sum(axis=0), _products(y)
            n, sums, products = n + len(y), s if sums is None else sums + s, p if products is None else products + p
    if n:
        yield pd.DataFrame({"i": range(len(sums)), "n": n, "s": [str(v) for v in sums],
                            "p": [" ".join(map(str, row)) for row in products]})


def _add_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    p = [np.array([int(v) for v in row.split()], dtype=object) for row in pdf["p"]]
    return pd.DataFrame({"i": pdf["i"].iloc[:1], "n": [int(pdf["n"].sum())], "s": [str(sum(map(int, pdf["s"])))],
                         "p": [" ".join(map(str, sum(p[1:], p[0])))]})


class Scatter:
    """n, the sums S of x, and M = n * sum(x x') - S S', all exact."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]]):
        self.n, self.sums = n, [s + n * OFFSET for s in sums]
        self.matrix = [[n * p - a * b for p, b in zip(row, sums)] for row, a in zip(products, sums)]

    @property
    def trace(self) -> int:
        return sum(self.matrix[i][i] for i in range(len(self.matrix)))


def scatter(fit: DataFrame) -> Scatter | None:
    schema = "i int, n long, s string, p string"
    parts = fit.select("x").mapInPandas(_partial_scatter, schema)
    some = parts.groupBy("i", (F.xxhash64("s", "p") % 32).alias("part")).applyInPandas(_add_rows, schema)
    rows = some.groupBy("i").applyInPandas(_add_rows, schema).orderBy("i").collect()
    if not rows:
        return None
    return Scatter(rows[0]["n"], [int(r["s"]) for r in rows], [[int(v) for v in r["p"].split()] for r in rows])


def primes_below(limit: int, count: int) -> list[int]:
    """The `count` largest primes below `limit` (under 3.2e9: three bases decide)."""
    def is_prime(p: int) -> bool:
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for base in (2, 3, 5, 7):
            x = pow(base, d, p)
            if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(s - 1)):
                return False
        return True
    out, p = [], limit - 1 | 1
    while len(out) < count:
        p -= 2
        if is_prime(p):
            out.append(p)
    return out


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients, constant first, of det(t I - matrix) modulo the prime p < 2^31."""
    h = (np.array(matrix, dtype=object) % p).astype(np.int64)
    d = len(h)
    for m in range(1, d - 1):                               # column m - 1 gets zeros below row m
        below = np.nonzero(h[m:, m - 1])[0]
        if not len(below):
            continue
        k = m + int(below[0])
        if k != m:
            h[[m, k]] = h[[k, m]]
            h[:, [m, k]] = h[:, [k, m]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)             # of the leading blocks
    polys[0, 0] = 1
    for m in range(1, d + 1):
        factors, below = np.zeros(m, np.int64), 1
        for i in range(m - 1, -1, -1):                      # h[i, m-1] times the subdiagonal from i on
            factors[i] = int(h[i, m - 1]) * below % p
            if i:
                below = below * int(h[i, i - 1]) % p
        new = -((polys[:m] * factors[:, None] % p).sum(axis=0)) % p
        new[1:] = (new[1:] + polys[m - 1, :-1]) % p
        polys[m] = new
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(t I - matrix) for a symmetric matrix without negative eigenvalues."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * bound + 1).bit_length() // 30 + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"p": pdf["p"], "c": [polynomial_mod(matrix, int(p)) for p in pdf["p"]]})
    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    rows = (spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
            .mapInPandas(run, "p long, c array<long>").collect())
    whole = math.prod(primes)
    weights = [whole // r["p"] * pow(whole // r["p"], -1, r["p"]) for r in rows]
    out = []
    for k in range(d + 1):
        c = sum(w * r["c"][k] for w, r in zip(weights, rows)) % whole
        out.append(c - whole if 2 * c > whole else c)
    return out


def roots_above(poly: list[int], t: Fraction) -> int:
    """How many roots, all of them real, exceed t: sign changes of the polynomial in (y + t) * denominator."""
    d, den = len(poly) - 1, t.denominator
    c, scale = list(poly), 1
    for i in range(d, -1, -1):
        c[i] *= scale
        scale *= den
    a = t.numerator
    for low in range(d):                                    # Taylor shift by a
        for i in range(d - 1, low - 1, -1):
            c[i] += a * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def isolate(poly: list[int], k: int, top: int) -> tuple[Fraction, Fraction]:
    """[low, high) around the k-th largest root, all roots positive from the k-th on up, to 2^-BITS of its size."""
    low, high = Fraction(0), Fraction(top + 1)
    while high - low > low / (1 << BITS):
        mid = (low + high) / 2
        low, high = (mid, high) if roots_above(poly, mid) >= k else (low, mid)
    return low, high


def null_space(matrix: list[list[int]], root: Fraction, size: int) -> list[list[float]]:
    """`size` orthonormal vectors that matrix - root turns to (nearly) zero, by inverse iteration."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS + len(str(sum(matrix[i][i] for i in range(d))))
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], dtype=object)
        a[np.arange(d), np.arange(d)] -= shift
        tiny = abs(shift) * Decimal(10) ** -DIGITS
        order = np.arange(d)
        for k in range(d):                                  # LU with row exchanges
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - np.multiply.outer(a[k + 1:, k], a[k, k + 1:])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(1, d):
                x[k] -= a[k, :k].dot(x[:k])
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] - (a[k, k + 1:].dot(x[k + 1:]) if k + 1 < d else 0)) / a[k, k]
            return x

        def unit(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
            for _ in range(2):
                for o in others:
                    v = v - o * v.dot(o)
                v = v / v.dot(v).sqrt()
            return v
        found: list[np.ndarray] = []
        draws = np.random.default_rng(d)
        for _ in range(size):
            v = unit(np.array([Decimal(int(x)) for x in draws.integers(1, 1 << 40, d)], dtype=object), found)
            for _ in range(ROUNDS):
                new = unit(solve(v), found)
                new = new if new.dot(v) > 0 else -new
                still = max(abs(x) for x in new - v)
                v = new
                if still < Decimal(10) ** -30:
                    break
            found.append(v if max(v, key=abs) > 0 else -v)
        return [[float(x) for x in v] for v in found]


class Whitening:
    """The fitted transform: n, S, and for each component its root of M, share of the trace and unit vector."""

    def __init__(self, n: int, sums: list[int], roots: list[float], explained: list[float], vectors: list[list[float]]):
        self.n, self.sums, self.roots, self.explained, self.vectors = n, sums, roots, explained, vectors

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit integers where they suffice, else Python's."""
        small = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums)) < 1 << 62
        kind = np.int64 if small else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(float) @ np.array(self.vectors).T / np.sqrt(self.roots)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a fit list (column x, distinct); None without variance."""
    spark = fit.sparkSession
    total = scatter(fit)
    if total is None or total.trace == 0:
        return None
    poly = characteristic_polynomial(spark, total.matrix)
    zeros = next(i for i, c in enumerate(poly) if c)        # the root 0 as often as the lowest coefficients vanish
    poly = poly[zeros:]
    k = min(components, len(poly) - 1)
    matrix, trace = total.matrix, total.trace

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [isolate(poly, int(i), trace) for i in pdf["id"]]
            yield pd.DataFrame({"id": pdf["id"], "low": [str(a) for a, _ in found], "high": [str(b) for _, b in found]})
    rows = spark.range(1, k + 1, 1, k).mapInPandas(roots, "id long, low string, high string").orderBy("id").collect()
    spans = [(Fraction(r["low"]), Fraction(r["high"])) for r in rows]
    groups: list[list[int]] = []                            # roots that the bisection did not tell apart
    for i, (_, high) in enumerate(spans):
        if groups and high > spans[groups[-1][-1]][0]:
            groups[-1].append(i)
        else:
            groups.append([i])
    middles = [sum(spans[g[0]]) / 2 for g in groups]

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in pdf["id"]:
                yield pd.DataFrame({"id": int(i), "v": null_space(matrix, middles[int(i)], len(groups[int(i)]))})
    found: list[list[list[float]]] = [[] for _ in groups]
    for r in spark.range(0, len(groups), 1, len(groups)).mapInPandas(vectors, "id long, v array<double>").collect():
        found[r["id"]].append(list(r["v"]))
    middle = [sum(s) / 2 for s in spans]
    return Whitening(total.n, total.sums, [float(m) for m in middle], [float(m / trace) for m in middle],
                     [v for group in found for v in group])


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance, less the identity."""
    k = len(w.vectors)

    def sums(mean: np.ndarray | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros(k if mean is None else (k, k))
            for pdf in batches:
                if len(pdf):
                    z = w.project(w.centred(_stack(pdf["x"])))
                    out += z.sum(axis=0) if mean is None else (z - mean).T @ (z - mean)
            yield pd.DataFrame({"i": range(out.size), "v": out.ravel()})
        return run

    def total(mean: np.ndarray | None) -> np.ndarray:
        rows = fit.select("x").mapInPandas(sums(mean), "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        return np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])]) / w.n
    return float(np.abs(total(total(None)).reshape(k, k) - np.eye(k)).max())


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, deviation, whitened, n, explained, identity_error), one row for each row that takes part; whitened
    and explained are arrays over the components, by falling variance."""
    spark = table.sparkSession
    schema = "vec_id long, deviation long, whitened array<double>, n long, explained array<double>, identity_error double"
    x = integer_vectors(table)
    fit = materialize(x.select("x").distinct(), "fit_list")
    w = fit_whitening(fit, components)
    if w is None:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, w)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                c = w.centred(_stack(pdf["x"]))
                small = c.dtype != object and int(np.abs(c).max()) ** 2 * c.shape[1] < 1 << 62
                squares = ((c if small else c.astype(object)) ** 2).sum(axis=1)
                deviation = pd.array([int(v) if v < 1 << 63 else None for v in squares], dtype="Int64")
                yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "deviation": deviation, "whitened": list(w.project(c))})
    rows = x.select(F.col("vec_id").cast("bigint"), "x").mapInPandas(run, "vec_id long, deviation long, whitened array<double>")
    return rows.select("*", F.lit(w.n).cast("bigint").alias("n"), F.array(*map(F.lit, w.explained)).alias("explained"),
                       F.lit(error).alias("identity_error"))


def whitened_components(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The registered query's rows: one for each row that takes part and each component, numbered from 1."""
    return whiten(table, components).select(
        "vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error")
