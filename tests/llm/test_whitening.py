from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as E
from linkrec.llm import whitening as wh
from tests.conftest import SF001


def integer_polynomial(matrix):
    """det(t I - matrix), constant first, by Faddeev-LeVerrier in whole numbers."""
    a = np.array(matrix, dtype=object)
    d, m, c = len(a), np.zeros((len(a), len(a)), dtype=object), [1]
    for k in range(1, d + 1):
        m = a.dot(m) + c[-1] * np.eye(d, dtype=int).astype(object)
        c.append(-sum(a.dot(m)[i, i] for i in range(d)) // k)
    return c[::-1]


@pytest.mark.parametrize("rows, d, top", [(40, 7, 9), (5, 8, 3), (60, 12, 10**9), (9, 1, 5), (30, 5, 0)])
def test_polynomial_is_exact(spark, rows, d, top):
    x = np.random.default_rng(d).integers(-top, top + 1, (rows, d)).astype(object)
    matrix = (rows * x.T.dot(x) - np.outer(x.sum(axis=0), x.sum(axis=0))).tolist()
    assert wh.characteristic_polynomial(spark, matrix) == integer_polynomial(matrix)


def test_roots_are_counted_and_isolated():
    poly = [1]
    for r in (0, 0, 3, 7, 7, 1000):                         # (t - r)
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [wh.roots_above(poly, Fraction(t)) for t in (-1, 0, 2, 3, 6, 7, 999, 1000)] == [6, 4, 4, 3, 3, 1, 1, 0]
    for k, r in ((1, 1000), (2, 7), (3, 7), (4, 3)):
        low, high = wh.isolate(poly[2:], k, 1017)
        assert low <= r < high and high - low <= low / 2**80


def test_null_space_of_a_double_root():
    matrix = np.diag([5, 9, 9, 2]).tolist()
    v = np.array(wh.null_space(matrix, Fraction(9), 2))
    assert np.allclose(v @ v.T, np.eye(2), atol=1e-15) and np.allclose(np.abs(v)[:, [0, 3]], 0, atol=1e-15)


def reference(vectors, k=16):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, centre = len(fit), fit.mean(axis=0)
    e, q = np.linalg.eigh((fit - centre).T @ (fit - centre) / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, int((e > 1e-9 * max(e[0], 1e-300)).sum()))
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, fit.sum(axis=0))) for row in x]
    return n, deviation, (x - centre) @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_query_against_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = E.queries()["op13_whitening"](spark, SF001).toPandas().sort_values(["vec_id", "component"])
    rows = sorted(rows, key=lambda r: r.vec_id)
    n, deviation, whitened, explained = reference([r.embedding for r in rows])
    mine = got.whitened.to_numpy().reshape(len(rows), -1)
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine - whitened * signs).max() < 1e-8
    assert np.abs(got.explained.to_numpy()[:16] / explained - 1).max() < 1e-9
    assert got.deviation.to_numpy()[::16].tolist() == deviation
    assert set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_rows(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(5)
    good = [[float(v) for v in rng.normal(size=3)] + [1.0] for _ in range(30)]       # the fourth has no variance
    bad = [None, [], [1.0, None, 2.0, 3.0], [nan, 0.0, 0.0, 0.0], [inf, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate([*good, *bad])] + [(None, good[0]), (3, good[3]), (99, good[4])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as n", "1 as component", "2 as x")
    got = wh.whitened_components(df).collect()
    assert {r.n for r in got} == {30} and {r.component for r in got} == {1, 2, 3} and len(got) == 3 * 33
    assert got[0].identity_error < 1e-9 and sum({r.component: r.explained for r in got}.values()) == pytest.approx(1)
    _, deviation, whitened, _ = reference(good)
    for r in got:
        if r.vec_id is not None and r.vec_id < 30:
            assert abs(abs(r.whitened) - abs(whitened[r.vec_id, r.component - 1])) < 1e-9 and r.deviation == deviation[r.vec_id]


def test_huge_entries_and_tables_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1e17]), (3, [-1e300, 2.0])], schema)
    got = wh.whitened_components(df).collect()
    assert len(got) == 6 and all(r.deviation is None and np.isfinite(r.whitened) for r in got) and got[0].identity_error < 1e-6
    assert wh.whitened_components(df.limit(0)).count() == 0
    assert wh.whitened_components(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
