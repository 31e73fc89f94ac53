
import duckdb
import pytest
from pyspark.sql import functions as F

from linkrec.functions.exprs import hash_order
from linkrec.operators import sampling as SM
from linkrec.sources.tables import Tables
from tests.conftest import SF001


def test_hash_order_matches_duckdb(spark):
    v = spark.range(1).select(hash_order(F.lit(1), F.lit(2))).first()[0]
    assert v == 2992201373
    assert duckdb.sql("select ('0x' || substr(md5('1|2'), 1, 8))::BIGINT").fetchall()[0][0] == v


def test_edge_split_properties(spark):
    # per-source edge counts 1, 2, 5, 6, 10 -> test counts 0, 1, 1, 2, 2 (FIXTURES.md §3)
    edges = [(s, 100 * s + i) for s, n in zip(range(5), (1, 2, 5, 6, 10)) for i in range(n)]
    df = spark.createDataFrame(edges, "src long, dst long")
    for hot in (1, 2, 1 << 16):                      # bucketed and plain ranks agree
        sp = SM.edge_split(df, hot=hot).collect()
        tests = {}
        for r in sp:
            tests[r.src] = tests.get(r.src, 0) + int(r.is_test)
        assert tests == {0: 0, 1: 1, 2: 1, 3: 2, 4: 2}
        assert sorted((r.src, r.dst) for r in sp) == sorted(edges)


def test_split_same_under_bucketing(spark):
    f = Tables(spark, SF001).follows()
    a = SM.edge_split(f).groupBy("src").agg(F.sum(F.col("is_test").cast("int")).alias("t"))
    b = SM.edge_split(f, hot=3).groupBy("src").agg(F.sum(F.col("is_test").cast("int")).alias("t"))
    assert a.exceptAll(b).count() == 0


def test_negative_samples_are_not_edges(spark):
    t = Tables(spark, SF001)
    neg = SM.negative_samples(spark, t.users(), t.follows(), n=500)
    assert neg.count() == 500
    assert neg.where(F.col("src") == F.col("dst")).count() == 0
    assert neg.join(t.follows(), ["src", "dst"], "left_semi").count() == 0


def test_stratified_split_keeps_ratio(spark):
    df = spark.createDataFrame([(i, i + 1, int(i % 4 == 0)) for i in range(400)], "u long, v long, label int")
    sp = SM.stratified_split(df, "label", ["u", "v"])
    c = {(r.label, r.is_test): r["count"] for r in sp.groupBy("label", "is_test").count().collect()}
    assert c[(1, True)] == 20 and c[(0, True)] == 60


def test_candidates_exact_for_small_user_sets(spark):
    for n in (1, 2, 3, 20, 150, 204):
        users = spark.createDataFrame([(i * 7,) for i in range(n)], "new_id long")
        per = SM.candidates(users).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("candidate").alias("d"))
        assert {(r.n, r.d) for r in per.collect()} == {(min(n, 200), min(n, 200))} and per.count() == n


def test_negative_samples_on_dense_graphs(spark):
    users = spark.createDataFrame([(i,) for i in range(40)], "new_id long")
    full = [(a, b) for a in range(40) for b in range(40) if a != b]
    edges = spark.createDataFrame(full[:-3], "src long, dst long")
    neg = SM.negative_samples(spark, users, edges, n=50).collect()
    assert len(neg) == 50 and {(r.src, r.dst) for r in neg} <= set(full[-3:])
    assert SM.negative_samples(spark, users, spark.createDataFrame(full, "src long, dst long"), n=5).count() == 0


def test_candidates_distinct_and_bounded(spark):
    users = Tables(spark, SF001).users()
    c = SM.candidates(users, pool=20)
    per = c.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("candidate").alias("d"))
    assert per.where("n != d or n != 20").count() == 0


def _bernoulli_by_hand(total, p, seed, length):
    """Geometric gaps in plain Python, block by block, without rounds."""
    import hashlib
    import math
    out = []
    for block in range(-(-total // length)):
        at, k = -1, 0
        while True:
            h = int(hashlib.md5(f"{block}|{k}|{seed}".encode()).hexdigest()[:15], 16)
            at += 1 + math.floor(math.log((h + 0.5) / 2 ** 60) / math.log1p(-p))
            k += 1
            if at >= length:
                break
            if block * length + at < total:
                out.append(block * length + at)
    return out


@pytest.mark.parametrize("total,p,draws", [(5000, 0.05, 16), (300, 0.5, 1024), (7, 0.9, 2), (0, 0.1, 8)])
def test_bernoulli_indices_equal_the_gaps(spark, total, p, draws):
    got = SM.bernoulli_indices(spark, total, p, block_draws=draws).collect()
    want = _bernoulli_by_hand(total, p, SM.SEED, SM.block_length(p, draws))
    assert sorted(r.idx for r in got) == want


def test_bernoulli_rate_and_independence_of_neighbours(spark):
    total, p = 400_000, 0.02
    x = {r.idx for r in SM.bernoulli_indices(spark, total, p, block_draws=64).collect()}
    assert abs(len(x) - total * p) < 5 * (total * p * (1 - p)) ** 0.5
    both = sum(1 for i in x if i + 1 in x)
    assert abs(both - total * p * p) < 5 * (total * p * p) ** 0.5


def test_bernoulli_goes_on_where_a_round_is_short(spark, monkeypatch):
    # rounds of a few draws: blocks stay open and are taken up again
    monkeypatch.setattr(SM.math, "sqrt", lambda x: -x / 13)
    got = SM.bernoulli_indices(spark, 4000, 0.2, block_draws=400).collect()
    monkeypatch.undo()
    assert sorted(r.idx for r in got) == _bernoulli_by_hand(4000, 0.2, SM.SEED, SM.block_length(0.2, 400))


def test_bernoulli_pairs_first_n_and_edge_cases(spark):
    users = spark.createDataFrame([(i,) for i in range(100, 160)] + [(100,), (None,)], "new_id long")
    every = sorted(map(tuple, SM.bernoulli_pairs(spark, users, 0.05).collect()))
    want = [i for i in _bernoulli_by_hand(3600, 0.05, SM.SEED, SM.block_length(0.05)) if i // 60 != i % 60]
    assert every == [(i, 100 + i // 60, 100 + i % 60) for i in want]
    some = sorted(map(tuple, SM.bernoulli_pairs(spark, users, 0.05, n=25).collect()))
    assert some == every[:25]
    assert SM.bernoulli_pairs(spark, users, 0.05, n=10 ** 6).count() == len(every)
    assert SM.bernoulli_pairs(spark, users.limit(0), 0.05).count() == 0
    assert SM.bernoulli_pairs(spark, users.limit(0), 0.05, n=3).count() == 0
    with pytest.raises(ValueError):
        SM.bernoulli_pairs(spark, users, 0.0)


def test_drawn_candidates_are_not_broadcast(spark):
    """The draws, pool times the users, join the index where it is hashed: before, Spark took them for small and sent them all."""
    users = spark.createDataFrame([(i,) for i in range(3000)], "new_id long")
    c = SM.candidates(users)
    assert c.count() == 600_000
    c.collect()
    plan = c._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin [pos" not in plan
