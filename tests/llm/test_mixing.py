import random

import pytest
from pyspark.sql import functions as F

from linkrec.llm.mixing import _close_gap, mix, mixed_documents, take

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shares(sizes, weights=(3.0, 1.0, 2.0)):
    """Reshare the excess by weight until no target is above twice its size."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left, wsum = total - sum(fixed.values()), sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / wsum > 2 * sizes[s]]
        if not over:
            return fixed | {s: left * w[s] / wsum for s in open_}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = []
    for source, n, top in (("a", 90, 60), ("b", 40, 400), ("é", 15, 30), (None, 30, 80), ("z", 1, 5)):
        rows += [(len(rows) + i, "w " * rng.randrange(1, top), "en", source, 0) for i in range(n)]
    rows += [(500, None, "en", "a", 0), (501, "", "en", "b", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit(9))
    got = mixed_documents(df).collect()
    size = {r.doc_id: r.size for r in got}
    assert all(size[i] == len((t or "").split()) for i, t, *_ in rows) and len(got) == len(rows)
    of = {r[0]: r[3] for r in rows}
    sizes, taken = {}, {}
    for r in got:
        sizes[of[r.doc_id]] = sizes.get(of[r.doc_id], 0) + r.size
        taken[of[r.doc_id]] = taken.get(of[r.doc_id], 0) + r.taken
        assert r.taken <= 2 * r.size
    want = shares(sizes)
    for r in got:
        assert r.source_size == sizes[of[r.doc_id]] and r.target == pytest.approx(want[of[r.doc_id]], rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(8, 0.02 * want[s]), s
    again = {(r.doc_id, r.taken) for r in mixed_documents(df).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    copies = {r.doc_id: r.copies for r in mix(df).collect()}
    out = take(df)
    assert out.columns == df.columns
    n = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert n == {i: c for i, c in copies.items() if c}
    assert mixed_documents(df.limit(0)).count() == 0


def test_few_long_documents_among_short_ones(spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randrange(20, 401), "en", "a", 0) for i in range(2000)] + [(5000, "w " * 300_000, "en", "a", 0)]
    rows += [(10_000 + i, "w " * 10, "en", "b", 0) for i in range(10_000)] + [(30_000, "w " * 100_000, "en", "b", 0)]
    rows += [(40_000 + i, "w " * 50, "en", "c", 0) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    of, target, taken, least = {r[0]: r[3] for r in rows}, {}, {}, {"a": 20, "b": 10, "c": 50}
    for r in mixed_documents(df).collect():
        s = of[r.doc_id]
        target[s], taken[s] = r.target, taken.get(s, 0) + r.taken
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= least[s] / 2 + 1e-6 for s in target), (taken, target)


def test_gap_is_closed_from_any_start():
    rng = random.Random(11)
    for _ in range(400):
        sizes = sorted(rng.sample(range(1, 60), rng.randrange(1, 8)) + rng.choices([1000, 7000], k=rng.randrange(2)), reverse=True)
        n = [rng.randrange(1, 40) for _ in sizes]
        copies = [rng.randrange(2 * k + 1) for k in n]
        gap = rng.choice([rng.uniform(-3000, 3000), 0.0, float(rng.randrange(-500, 500))])
        got = _close_gap(sizes, copies, [2 * k for k in n], gap)
        rest = gap - sum((b - a) * s for a, b, s in zip(copies, got, sizes))
        assert all(0 <= c <= 2 * k for c, k in zip(got, n)) and abs(rest) <= abs(gap)
        free = [s for s, c, k in zip(sizes, got, n) if (c < 2 * k if rest > 0 else c > 0)]
        assert not rest or not free or abs(rest) <= min(free) / 2 + 1e-9
    spread = _close_gap([10, 9, 8, 7], [100] * 4, [200] * 4, 340.0)
    assert all(105 <= c <= 115 for c in spread)
