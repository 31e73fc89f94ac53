"""Blocked scorer and distributed SVD against brute force on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrec.operators import blocked as B
from linkrec.operators import factorize as FZ
from linkrec.operators.hybrid import alpha_sweep, content_topk, hybrid_recs
from linkrec.operators.metrics import ranking_metrics

RNG = np.random.default_rng(7)
N, D, R = 23, 6, 4


def _brute(c, s, follows, alpha, k):
    """Hybrid recommendation per user, straight from the definition."""
    out = {}
    for u in range(N):
        cs = {v: c[u, v] for v in range(N) if v != u}
        lo, hi = min(cs.values()), max(cs.values())
        cs = {v: (x - lo) / (hi - lo + 1e-9) for v, x in cs.items()}
        lo2, hi2 = s[u].min(), s[u].max()
        ss = {v: (s[u, v] - lo2) / (hi2 - lo2 + 1e-9) for v in range(N)}
        comb = {v: alpha * cs[v] + (1 - alpha) * ss[v] for v in cs if v not in follows.get(u, set())}
        out[u] = [v for v, _ in sorted(comb.items(), key=lambda t: (-t[1], t[0]))[:k]]
    return out


@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
@pytest.mark.parametrize("block", [5, 64])
def test_hybrid_matches_brute_force(spark, alpha, block):
    X = RNG.random((N, D)) * (RNG.random((N, D)) < 0.6)
    X[3] = 0.0                                           # a zero feature row
    Xn = X / np.maximum(np.linalg.norm(X, axis=1, keepdims=True), 1e-300)
    Lf, Rf = RNG.normal(size=(N, R)), RNG.normal(size=(N, R))
    c, s = Xn @ Xn.T, Lf @ Rf.T
    follows = {u: set(RNG.choice(N, 3, replace=False).tolist()) for u in range(0, N, 2)}
    content = spark.createDataFrame([(i, list(range(D)), Xn[i].tolist()) for i in range(N)],
                                    "id long, c_idx array<int>, c_val array<double>")
    fl = spark.createDataFrame([(i, list(range(R)), Lf[i].tolist()) for i in range(N)],
                               "id long, f_idx array<int>, f_val array<double>")
    fr = spark.createDataFrame([(i, list(range(R)), Rf[i].tolist()) for i in range(N)], fl.schema)
    ex = spark.createDataFrame([(u, v) for u, vs in follows.items() for v in vs], "src long, dst long")
    got = hybrid_recs(content, D, fl, fr, R, alphas=(alpha,), k=5, exclude=ex, block_size=block).collect()
    res = {}
    for r in sorted(got, key=lambda r: (r.user_id, r["rank"])):
        res.setdefault(r.user_id, []).append(r.recommended_user)
    assert res == _brute(c, s, follows, alpha, 5)


def test_content_topk_matches_brute_force(spark):
    X = RNG.random((N, D))
    Xn = X / np.linalg.norm(X, axis=1, keepdims=True)
    c = Xn @ Xn.T
    content = spark.createDataFrame([(i, list(range(D)), Xn[i].tolist()) for i in range(N)],
                                    "id long, c_idx array<int>, c_val array<double>")
    got = content_topk(content, D, k=3, block_size=4).collect()
    for u in range(N):
        exp = sorted([v for v in range(N) if v != u], key=lambda v: (-c[u, v], v))[:3]
        mine = [r.recommended_user for r in sorted([r for r in got if r.user_id == u], key=lambda r: r["rank"])]
        assert mine == exp


def _sparse(m):
    return [np.flatnonzero(r).tolist() or None for r in m], [r[np.flatnonzero(r)].tolist() or None for r in m]


@pytest.mark.parametrize("at_once", [7, 4_000_000])
@pytest.mark.parametrize("density", [0.0, 0.01, 0.3, 1.0])
def test_sparse_product_matches_dense(monkeypatch, density, at_once):
    """Light columns, heavy ones (two that every row has) and rows without entries."""
    monkeypatch.setattr(B, "PAIRS_AT_ONCE", at_once)
    rng = np.random.default_rng(int(100 * density))
    left, right = (rng.normal(size=(n, 60)) * (rng.random((n, 60)) < density) for n in (31, 17))
    if density:
        left[:, [3, 50]], right[:, [3, 50]] = 2.0, rng.normal(size=(17, 2))
    left[5], right[2] = 0.0, 0.0
    got = B.sparse_product(B._entries(*_sparse(left)), B._entries(*_sparse(right)), (31, 17))
    assert np.allclose(got, left @ right.T, atol=1e-12)


def test_factor_blocks_are_ordered_and_filled_by_counting():
    """Columns below and above 16 bits, repeated entries, dense and light columns."""
    rng = np.random.default_rng(8)
    for high in (5, 300, 70_000):
        row, col, val = rng.integers(0, 30, 400), rng.integers(0, high, 400), rng.normal(size=400)
        order = B._order(col)
        assert (order == np.argsort(col, kind="stable")).all()
        side = row[order], col[order], val[order]
        m = np.zeros((30, high))
        np.add.at(m, (row, col), val)
        assert np.allclose(B.sparse_product(side, side, (30, 30)), m @ m.T, atol=1e-12)
    assert len(B._order(np.zeros(0, np.int64))) == 0


def test_best_columns_takes_the_first_of_equal_ones():
    rng = np.random.default_rng(4)
    scores = rng.integers(0, 4, (40, 23)).astype(float)
    scores[rng.random(scores.shape) < 0.2] = -np.inf
    scores[0], scores[1] = -np.inf, 1.0
    for k in (1, 5, 22, 23, 50):
        exact = np.zeros(scores.shape, dtype=bool)
        for r, row in enumerate(scores):
            exact[r, sorted(range(23), key=lambda c: (-row[c], c))[:k]] = True
        assert (B.best_columns(scores, k) == exact).all()


def test_alpha_sweep_judges_every_test_user_as_single_runs_do(spark):
    X = RNG.random((N, D))
    Xn = X / np.linalg.norm(X, axis=1, keepdims=True)
    content = spark.createDataFrame([(i, list(range(D)), Xn[i].tolist()) for i in range(N)],
                                    "id long, c_idx array<int>, c_val array<double>")
    factor = spark.createDataFrame([(i, list(range(R)), RNG.normal(size=R).tolist()) for i in range(N)],
                                   "id long, f_idx array<int>, f_val array<double>")
    test = spark.createDataFrame([(u, int(v)) for u in range(0, N, 2) for v in RNG.choice(N, 3, replace=False)]
                                 + [(999, 1)], "user_id long, item long")       # 999 is no candidate: scores 0
    train = spark.createDataFrame([(1, 2), (4, 6)], "src long, dst long")
    got = {r.alpha: r for r in alpha_sweep(content, D, factor, factor, R, test, train, (0.0, 0.4, 1.0), k=4,
                                           block_size=6).collect()}
    assert sorted(got) == [0.0, 0.4, 1.0]
    for a, r in got.items():
        recs = hybrid_recs(content, D, factor, factor, R, (a,), 4, train, block_size=64)
        exp = ranking_metrics(recs, test, test.select("user_id").distinct(), 4).first()
        assert r.users_evaluated == exp.users_evaluated == (N + 1) // 2 + 1
        assert np.allclose(r[1:5], exp[:4])


def test_randomized_svd_low_rank(spark):
    n, rank = 30, 4
    M = (RNG.random((n, rank)) @ RNG.random((rank, n)))
    M[RNG.random((n, n)) < 0.0] = 0
    A = spark.createDataFrame([(i, j, float(M[i, j])) for i in range(n) for j in range(n)],
                              "i long, j long, a double")
    U, s, V = FZ.randomized_svd(A, k=rank, oversample=4)
    sv = np.linalg.svd(M, compute_uv=False)[:rank]
    assert np.allclose(s, sv, rtol=1e-8)
    Ud = {r.id: np.array(r.vec) for r in U.collect()}
    Vd = {r.id: np.array(r.vec) for r in V.collect()}
    rec = np.array([[Ud[i] @ np.diag(s) @ Vd[j] for j in range(n)] for i in range(n)])
    assert np.allclose(rec, M, atol=1e-8)


def test_randomized_svd_truncation_close_to_optimal(spark):
    n, k = 40, 5
    M = (RNG.random((n, n)) < 0.15).astype(float)
    A = spark.createDataFrame([(i, j, 1.0) for i in range(n) for j in range(n) if M[i, j]], "i long, j long, a double")
    U, s, V = FZ.randomized_svd(A, k=k, oversample=10)
    assert np.allclose(s, np.linalg.svd(M, compute_uv=False)[:k], rtol=1e-9)


def test_svd_of_flat_spectrum_matches_exact(spark):
    """The follow graph's spectrum is flat: pair dots must still be those of the exact truncation."""
    n, k = 300, 12
    M = (RNG.random((n, n)) < 0.02).astype(float)
    M[0, :], M[:, 0] = 0, 0                      # a user without edges has no rows
    A = spark.createDataFrame([(i, j, 1.0) for i in range(n) for j in range(n) if M[i, j]], "i long, j long, a double")
    U, s, V = FZ.randomized_svd(A, k=k)
    u, sv, vt = np.linalg.svd(M)
    assert np.allclose(s, sv[:k], rtol=1e-8)
    got = np.zeros((n, k))
    for r in U.collect():
        got[r.id] = np.array(r.vec) * s
    exact = (u[:, :k] * sv[:k]) @ (u[:, :k] * sv[:k]).T
    assert np.linalg.norm(got @ got.T - exact) <= 1e-4 * np.linalg.norm(exact)


def test_restarted_basis_stays_narrow_and_converges(spark):
    """A flat spectrum, a basis of three blocks: residuals and pair dots as without a cut."""
    rng = np.random.default_rng(9)
    edges = sorted({(int(a), int(b)) for a, b in rng.integers(0, 90, (900, 2))})
    A = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "i long, j long, a double")
    dense = np.zeros((90, 90))
    dense[tuple(np.array(edges).T)] = 1.0
    U, s, V = FZ.randomized_svd(A, k=6, oversample=4, max_width=30)
    assert np.allclose(s, np.linalg.svd(dense)[1][:6], rtol=1e-8)
    u, v = np.zeros((90, 6)), np.zeros((90, 6))
    for m, df in ((u, U), (v, V)):
        for row in df.collect():
            m[row["id"]] = row["vec"]
    assert (np.linalg.norm(dense @ v - u * s, axis=0) <= 1.1e-5 * s).all()
    assert np.allclose(u.T @ u, np.eye(6), atol=1e-6)
    best = np.linalg.svd(dense)
    exact = best[0][:, :6] * best[1][:6]
    assert np.abs((u * s) @ (u * s).T - exact @ exact.T).max() < 1e-3


def test_svd_in_one_task_and_spread_give_the_same_factors(spark, monkeypatch):
    """A hub, users without edges, weights, a restarted basis and the filter: by jobs on written blocks and in one task.
    The jobs write each block once and keep none but the factors."""
    import os

    from linkrec.session import checkpoint_dir

    rng = np.random.default_rng(12)
    pairs = {(int(x), int(y)) for x, y in rng.integers(0, 120, (600, 2))} | {(7, y) for y in range(0, 120, 2)}
    A = spark.createDataFrame([(x + 5000, 3 * y, float(1 + (x + y) % 3)) for x, y in sorted(pairs)], "i long, j long, a double")
    dense = np.zeros((120, 120))
    for x, y in pairs:
        dense[x, y] = 1 + (x + y) % 3
    got = {}
    for cells in (FZ.ONE_TASK_CELLS, 0):
        monkeypatch.setattr(FZ, "ONE_TASK_CELLS", cells)
        U, s, V = FZ.randomized_svd(A, k=2, oversample=2, max_width=20)
        assert np.allclose(s, np.linalg.svd(dense)[1][:2], rtol=1e-8)
        got[cells] = {(x, r.id): np.array(r.vec) for x, df in (("u", U), ("v", V)) for r in df.collect()}
    one, spread = got.values()
    assert one.keys() == spread.keys() and len(one) > 200
    a, b = (np.array([g[x] for x in sorted(one)]) for g in (one, spread))
    sign = np.sign((a * b).sum(0))                          # is free
    assert np.allclose(a, b * sign, atol=1e-6)
    root = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "linkrec-tables")
    left = [x for x in os.listdir(root) if x.startswith(("svd-k", "svd-y"))]
    assert not left


def test_packed_blocks_are_shuffled_once(spark):
    """Rows are not copied to every block of the other side: the pairs of blocks come from a nested loop join."""
    content = spark.createDataFrame([(i, [0, 1], [0.6, 0.8]) for i in range(40)],
                                    "id long, c_idx array<int>, c_val array<double>")
    rows, _ = B.score_rows(content, None, None)
    blocks = B.packed_blocks(rows, 4)
    assert blocks.agg(F.sum("n")).first()[0] == 40 and blocks.agg(F.max("n")).first()[0] == 4
    r = B.blocked_topk(rows, blocks, 2, 3, [1.0], block_size=4, mode="content")
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "shuffle_replicate_nl" in plan and "CoGroup" not in plan
    # all scores are equal: the smallest ids win, whatever the order of the blocks
    got = {}
    for x in r.collect():
        got.setdefault(x.user_id, {})[x["rank"]] = x.recommended_user
    assert got == {u: dict(enumerate([v for v in range(5) if v != u][:3], 1)) for u in range(40)}


def test_repeated_and_null_ids_are_scored(spark):
    rows = [(None, [0], [1.0]), (1, [0], [1.0]), (1, [0], [1.0]), (2, [1], [1.0]), (3, [0], [0.5])]
    content = spark.createDataFrame(rows, "id long, c_idx array<int>, c_val array<double>")
    follows = spark.createDataFrame([(1, 3), (3, 1), (None, 2)], "src long, dst long")
    for size in (2, 100):
        got = [(r.user_id, r.recommended_user, r.score) for r in content_topk(content, 2, 2, follows, size).collect()]
        assert sorted(got, key=str) == sorted([(None, None, 1.0), (None, 1, 1.0), (1, None, 1.0), (1, None, 1.0),
                                               (2, None, 0.0), (2, 1, 0.0), (3, None, 0.5), (3, 1, 0.5)], key=str)


def test_sparse_products_by_packed_blocks(spark, monkeypatch):
    """A Z and A'Z against numpy, over several blocks, entry pieces and a full column; Z meets A packed."""
    monkeypatch.setattr(FZ, "ENTRIES", 50)
    rng = np.random.default_rng(4)
    n, r = FZ.BLOCK + 300, 3
    cells = {(int(i), int(j)): float(x) for i, j, x in zip(rng.integers(0, n, 400), rng.integers(0, n, 400), rng.random(400), strict=True)}
    cells |= {(i, 7): 1.0 for i in range(0, n, 10)}
    A = spark.createDataFrame([(i, j, a) for (i, j), a in cells.items()], "i long, j long, a double")
    Z = rng.random((n, r))
    rows = spark.createDataFrame([(i, [float(x) for x in Z[i]]) for i in range(n)], "id long, vec array<double>")
    for product, pos in ((FZ.a_times, 0), (FZ.at_times, 1)):
        exp = np.zeros((n, r))
        for cell, a in cells.items():
            exp[cell[pos]] += a * Z[cell[1 - pos]]
        got = {x.id: x.vec for x in product(A, rows).collect()}
        assert set(got) == {c[pos] for c in cells}
        assert all(np.allclose(got[i], exp[i]) for i in got)
    pieces = FZ.entries(A, "i", "j")
    assert FZ.times(pieces, FZ.packed(rows)).count() == 2 and pieces.count() > 4


def test_filtered_products_and_the_filter_switch(spark, monkeypatch):
    """The product steps equal numpy over two blocks of rows, and an SVD that goes on by the filter the exact one."""
    n, r = FZ.BLOCK + 300, 3
    rng = np.random.default_rng(3)
    i, j = rng.integers(0, n, 3000), rng.integers(0, n, 3000)
    dense = np.zeros((n, n))
    np.add.at(dense, (i, j), 1.0)
    at = np.argwhere(dense)
    A = spark.createDataFrame([(int(x), int(y), float(dense[x, y])) for x, y in at], "i long, j long, a double")
    z = rng.normal(size=(n, r))
    Z = FZ.packed(spark.createDataFrame([(x, z[x].tolist()) for x in range(n)], "id long, vec array<double>"))
    got = FZ.filtered(FZ.entries(A, "j", "i"), FZ.entries(A, "i", "j"), Z, np.array([2.0, 5.0]), 4.0)
    want = dense @ (dense.T @ z) - 2.0 * z
    want = (dense @ (dense.T @ want) - 5.0 * want) / 16
    out = np.zeros((n, r))
    for row in FZ.unpacked(got).collect():
        out[row.id] = row.vec
    assert np.allclose(out, want)

    m = rng.normal(size=(120, 120))
    B = spark.createDataFrame([(x, y, float(m[x, y])) for x in range(120) for y in range(120)], "i long, j long, a double")
    degrees = []
    shifts = FZ.filter_shifts
    monkeypatch.setattr(FZ, "PLAIN_BLOCKS", 2)
    monkeypatch.setattr(FZ, "filter_shifts", lambda *x: degrees.append(len(shifts(*x)[0])) or shifts(*x))
    U, s, V = FZ.randomized_svd(B, k=4, oversample=3)
    u, exact, vt = np.linalg.svd(m)
    assert degrees and degrees[0] > 1 and np.allclose(s, exact[:4], rtol=1e-8)
    left, right = (np.array([row.vec for row in X.orderBy("id").collect()]) for X in (U, V))
    assert np.abs(left * s @ right.T - u[:, :4] * exact[:4] @ vt[:4]).max() < 1e-3


def test_filter_shifts_bound_the_top():
    """The polynomial is at most 2 up to the cut, and no degree lets the largest value drown the others."""
    for top, cut in ((1.05, 1.0), (3.0, 1.0), (50.0, 1.0), (1e9, 1.0)):
        shifts, scale = FZ.filter_shifts(top, cut)
        at = lambda x: np.prod([(x - t) / scale for t in shifts])
        assert max(abs(at(x)) for x in np.linspace(0, cut, 101)) <= 2 + 1e-9 and (len(shifts) == 1 or at(top) <= 2e6 + 1)


def _packed(ids, c, f, follows=None, minmax=None):
    row = {"block": int(ids[0]), "n": len(ids), "ids": np.asarray(ids, np.int64).tobytes(),
           "known": np.ones(len(ids), bool).tobytes()}
    entries = [np.flatnonzero(x) for x in f]
    for name, values, dtype in (("c_idx", [np.arange(c.shape[1])] * len(ids), np.int32), ("c_val", list(c), np.float64),
                                ("f_idx", entries, np.int32), ("f_val", [x[e] for x, e in zip(f, entries, strict=True)], np.float64),
                                ("excl", [follows.get(u, []) for u in ids] if follows else [[] for _ in ids], np.int64)):
        row[name + "_len"], row[name] = B._flat(values, dtype)
    return row | {k: v.to_numpy(float).tobytes() for k, v in (minmax or {}).items()}


def test_few_cells_are_the_sparse_product():
    rng = np.random.default_rng(1)
    L, M = ((rng.random((60, 500)) < 0.01) * rng.normal(size=(60, 500)) for _ in range(2))
    left, right = (B._entries([np.flatnonzero(x) for x in m], [x[np.flatnonzero(x)] for x in m]) for m in (L, M))
    at, value = B.few_cells(left, right, (60, 60))
    assert (np.diff(at) > 0).all() and len(at) < 3600 // 4
    out = np.zeros(3600)
    out[at] = value
    assert (out.reshape(60, 60) == B.sparse_product(left, right, (60, 60))).all()
    dense = B._entries([np.arange(9)] * 60, list(rng.random((60, 9))))
    assert B.few_cells(dense, dense, (60, 60)) is None


def test_alphas_score_only_candidates_that_can_be_among_the_best(spark, monkeypatch):
    """With seldom shared factor entries, no alpha's scores are filled for a whole block pair: before, they were for every
    alpha.  Recommendations equal the definition's."""
    rng = np.random.default_rng(3)
    n, k, alphas = 300, 4, (0.0, 0.3, 1.0)
    c = rng.integers(0, 3, (n, 6)).astype(float)                # equal rows: ties go to the smaller id
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1)
    f = (rng.random((n, 400)) < 0.004).astype(float)
    follows = {u: rng.choice(n, 5, replace=False).tolist() for u in range(0, n, 3)}
    content = spark.createDataFrame([(i, list(range(6)), c[i].tolist()) for i in range(n)],
                                    "id long, c_idx array<int>, c_val array<double>")
    factor = spark.createDataFrame([(i, np.flatnonzero(f[i]).tolist(), [1.0] * int(f[i].sum())) for i in range(n)],
                                   "id long, f_idx array<int>, f_val array<double>")
    ex = spark.createDataFrame([(u, v) for u, vs in follows.items() for v in vs], "src long, dst long")
    got = {}
    for r in sorted(hybrid_recs(content, 6, factor, factor, 400, alphas, k, ex, block_size=64).collect(), key=lambda r: r["rank"]):
        got.setdefault((r.alpha, r.user_id), []).append(r.score)
    whole, s = c @ c.T, f @ f.T
    for u in range(n):
        other = np.arange(n) != u
        cn = (whole[u] - whole[u, other].min()) / (whole[u, other].max() - whole[u, other].min() + B.EPS)
        sn = (s[u] - s[u].min()) / (s[u].max() - s[u].min() + B.EPS)
        free = [v for v in range(n) if v != u and v not in follows.get(u, [])]
        for a in alphas:
            assert np.allclose(got[a, u], np.sort((a * cn + (1 - a) * sn)[free])[::-1][:k], atol=1e-9)

    def no_whole(*args):
        raise AssertionError("whole score matrices")
    monkeypatch.setattr(B, "_scores", no_whole)
    blocks = [_packed(np.arange(x, x + 50), c[x:x + 50], f[x:x + 50]) for x in range(0, n, 50)]
    monkeypatch.setattr(B, "block_pairs", lambda left, right: _Walked(left, right))
    mm = B.user_minmax([_packed(np.arange(500, 550), c[:50], f[:50])], blocks, 6).rows
    assert np.allclose(mm["smax"], s[:50].max(axis=1)) and np.allclose(mm["cmin"], whole[:50].min(axis=1))


class _Walked:
    """Block pairs of one task, in this process."""

    def __init__(self, left, right):
        self.pairs = [{**{"l_" + k: v for k, v in x.items()}, **{"r_" + k: v for k, v in y.items()}} for x in left for y in right]

    def mapInPandas(self, walk, schema):
        import pandas as pd
        self.rows = pd.concat(walk(iter([pd.DataFrame([p]) for p in self.pairs])))
        return self

    def groupBy(self, *keys):
        return self

    def agg(self, *columns):
        return self
