"""Golden values of FIXTURES.md §3 (six-user follow graph)."""

import pytest
from pyspark.sql import functions as F

from linkrec.operators import communities as C
from linkrec.operators import graph as G
from linkrec.operators import pagerank as PR
from linkrec.operators import pairs as P
from linkrec.operators import similarity as S

EDGES = [(1, 2), (1, 3), (2, 3), (3, 1), (4, 1), (4, 3), (4, 1), (5, 4), (7, 1)]


@pytest.fixture(scope="module")
def g(spark):
    v = spark.createDataFrame([(i,) for i in range(1, 7)], "id long")
    e = spark.createDataFrame(EDGES, "src long, dst long")
    d = G.directed_graph(e, v)
    und = G.undirected(d)
    return v, e, d, und


def _map(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


def test_degrees(g):
    v, e, d, und = g
    deg = G.degrees(d, v).collect()
    assert {r.id: (r.in_degree, r.out_degree) for r in deg} == {
        1: (2, 2), 2: (1, 1), 3: (3, 1), 4: (1, 2), 5: (0, 1), 6: (0, 0)}
    ud = _map(G.undirected_degree(und, v), "id", "degree")
    assert ud == {1: 3, 2: 2, 3: 3, 4: 3, 5: 1, 6: 0}


def test_clustering(g):
    v, e, d, und = g
    cl = _map(G.clustering(und, v), "id", "clustering")
    exp = {1: 0.666667, 2: 1.0, 3: 0.666667, 4: 0.333333, 5: 0.0, 6: 0.0}
    for k, x in exp.items():
        assert cl[k] == pytest.approx(x, abs=1e-6)


def test_pagerank_unnormalised(g):
    v, e, d, und = g
    pr = _map(PR.pagerank_unnormalised(v, d), "id", "pagerank")
    exp = {1: 1.755278, 2: 0.891051, 3: 1.761443, 4: 0.2775, 5: 0.15, 6: 0.15}
    for k, x in exp.items():
        assert pr[k] == pytest.approx(x, abs=1e-6)


def test_pagerank_normalised(g):
    v, e, d, und = g
    pr = _map(PR.pagerank_normalised(v, d), "id", "pagerank")
    exp = {1: 0.353625, 2: 0.179417, 3: 0.354822, 4: 0.053883, 5: 0.029126, 6: 0.029126}
    for k, x in exp.items():
        assert pr[k] == pytest.approx(x, abs=1e-4)
    assert sum(pr.values()) == pytest.approx(1.0, abs=1e-6)


def test_pair_topology(spark, g):
    v, e, d, und = g
    pairs = spark.createDataFrame([(2, 4), (1, 4), (1, 2), (2, 5), (5, 6)], "u long, v long")
    t = {(r.u, r.v): r for r in P.topology(pairs, und, G.undirected_degree(und, v)).collect()}
    assert t[(2, 4)].common_neighbors == 2
    assert t[(2, 4)].jaccard == pytest.approx(0.666667, abs=1e-6)
    assert t[(2, 4)].adamic_adar == pytest.approx(1.820478, abs=1e-6)
    assert t[(1, 4)].jaccard == pytest.approx(0.2)
    assert t[(1, 2)].jaccard == pytest.approx(0.25)
    assert t[(1, 2)].adamic_adar == pytest.approx(0.910239, abs=1e-6)
    assert t[(2, 5)].common_neighbors == 0 and t[(5, 6)].jaccard == 0.0


def test_node_similarity(g):
    v, e, d, und = g
    ns = S.node_similarity(d)
    got = {(r.node1, r.node2): r.similarity for r in ns.collect() if r.node1 < r.node2}
    assert set(got) == {(1, 2), (1, 4), (2, 4), (3, 4)}
    assert got[(1, 2)] == pytest.approx(0.5) and got[(1, 4)] == pytest.approx(1 / 3)
    assert got[(2, 4)] == pytest.approx(0.5) and got[(3, 4)] == pytest.approx(0.5)


def _two_cliques(spark):
    e = []
    for base in (0, 10):
        for i in range(5):
            for j in range(5):
                if i != j:
                    e.append((base + i, base + j))
    e += [(4, 10), (10, 4)]
    v = spark.createDataFrame([(i,) for i in list(range(5)) + list(range(10, 15))], "id long")
    return v, spark.createDataFrame(e, "src long, dst long")


def test_label_propagation_two_cliques(spark):
    v, und = _two_cliques(spark)
    c = _map(C.label_propagation(v, und), "id", "community")
    assert len({c[i] for i in range(5)}) == 1 and len({c[i] for i in range(10, 15)}) == 1
    q = C.modularity(und, C.label_propagation(v, und)).first().modularity
    assert q > 0.4


def test_louvain_beats_single_community(spark):
    v, und = _two_cliques(spark)
    lv = C.louvain(v, und)
    q = C.modularity(und, lv).first().modularity
    one = C.modularity(und, v.withColumn("community", F.lit(0))).first().modularity
    assert q > one
    c = _map(lv, "id", "community")
    assert len(set(c.values())) == 2


def test_pagerank_salted_sources_same(g):
    v, e, d, und = g
    a = _map(PR.pagerank_unnormalised(v, d), "id", "pagerank")
    b = _map(PR.pagerank_unnormalised(v, d, hot=1), "id", "pagerank")   # every source salted
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)
    c = _map(PR.pagerank_normalised(v, d, hot=1), "id", "pagerank")
    assert abs(sum(c.values()) - 1.0) < 1e-6


def test_mean_aggregate_of_a_vertex_without_in_neighbours(spark):
    from linkrec.operators.models import sage_mean_aggregate

    nodes = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0]), (3, [5.0, 8.0])], "id long, z array<double>")
    edges = spark.createDataFrame([(1, 2), (3, 2), (1, 3), (1, 3)], "src long, dst long")
    got = {r.id: r.z for r in sage_mean_aggregate(nodes, edges, hops=1).collect()}
    assert got == {1: [1.0, 2.0, 0.0, 0.0], 2: [3.0, 4.0, 3.0, 5.0], 3: [5.0, 8.0, 1.0, 2.0]}
    assert {len(r.z) for r in sage_mean_aggregate(nodes, edges, hops=2).collect()} == {8}


def _random_graph(spark, n=60, m=240):
    from random import Random

    r = Random(3)
    e = {(r.randrange(n), r.randrange(n)) for _ in range(m)}
    e = spark.createDataFrame(sorted(x for x in e if x[0] != x[1]), "src long, dst long")
    return spark.range(n), G.undirected(e)


def test_louvain_round_reads_the_edges_once(spark):
    """A round scans the cached links once and never shuffles them: only rows summed by (a, cb) move."""
    v, und = _random_graph(spark)
    links, salts = C._links(und.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(1.0).alias("w")), 0, 1 << 15)
    comm = (v.select(F.col("id").alias("node")).join(salts, "node", "left")
            .select("node", F.lit(4.0).alias("k"), F.col("node").alias("c"), C._half("node", 0).alias("_par"),
                    F.coalesce("_s", F.lit(0)).alias("_s")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = C._best_moves(links, comm.localCheckpoint(), 0, 240.0, 1e-12)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        links.unpersist()
    assert plan.count("InMemoryTableScan") == 1


def test_louvain_moves_to_the_community_of_most_gain(spark):
    """One round against a count of every gain, ties to the smallest id."""
    v, und = _random_graph(spark)
    edges = [(r.src, r.dst) for r in und.collect()]
    m2, c = float(len(edges)), {i: i % 7 for i in range(60)}
    k = {i: float(sum(a == i for a, _ in edges)) for i in c}
    links, salts = C._links(und.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(1.0).alias("w")), 0, 3)
    rows = spark.createDataFrame([(i, k[i], c[i]) for i in c], "node long, k double, c long")
    comm = rows.join(salts, "node", "left").withColumn("_par", C._half("node", 0)).withColumn("_s", F.coalesce("_s", F.lit(0)))
    half = {r.node for r in comm.where("_par = 1").collect()}
    exp = {}
    for i in half:
        kin, total = {}, {x: sum(k[j] for j in c if c[j] == x) for x in range(7)}
        for a, b in edges:
            if a == i:
                kin[c[b]] = kin.get(c[b], 0) + 1
        gains = [(kin[x] * m2 - k[i] * total[x] - kin.get(c[i], 0) * m2 + k[i] * (total[c[i]] - k[i]), -x) for x in kin if x != c[i]]
        if gains and max(gains)[0] > 0:
            exp[i] = -max(gains)[1]
    assert len(exp) > 5 and _map(C._best_moves(links, comm, 1, m2, 1e-12), "node", "_to") == exp
    links.unpersist()


def test_louvain_in_one_task_makes_the_same_moves(spark, monkeypatch):
    """The levels inside one task, from the first or a later one on, against a job a round: equal labels, also with
    a vertex without edges, an edge to an unknown user, weights and few rounds."""
    from random import Random

    r = Random(5)
    pairs = {(x, y) for x in range(0, 400, 4) for y in range(0, 400, 4) if x != y and r.random() < (0.3 if x // 40 == y // 40 else 0.01)}
    v = spark.createDataFrame([(x,) for x in [*range(0, 400, 4), 1001]], "id long")
    und = G.undirected(spark.createDataFrame(sorted(pairs | {(8, 2000), (2000, 12)}), "src long, dst long"))
    took = []
    monkeypatch.setattr(C, "_levels_in_one_task", lambda *x, f=C._levels_in_one_task: took.append(x[3]) or f(*x))
    for moves, levels in ((3, 2), (1, 1)):
        monkeypatch.setattr(C, "ONE_TASK_EDGES", 0)
        spread = _map(C.louvain(v, und, levels, moves), "id", "community")
        assert not took and 3 < len(set(spread.values())) < 90
        for edges, first in ((1 << 20, 0), (und.count() // 2, 1))[:levels]:
            monkeypatch.setattr(C, "ONE_TASK_EDGES", edges)
            assert _map(C.louvain(v, und, levels, moves), "id", "community") == spread
            assert took == [first] and not took.clear()
    twice = v.union(v)
    monkeypatch.setattr(C, "ONE_TASK_EDGES", 1 << 20)
    C.louvain(twice, und, 1, 1)
    assert not took                                          # repeated users keep to the jobs, which count them twice


def test_pair_graph_is_written_once(spark):
    """The features read the edges many times: from a file, not through the joins that make them."""
    from linkrec.plans import registry

    class Rows:
        def users(self):
            return spark.createDataFrame([(1,), (2,), (3,)], "new_id long")

        def user_games(self):
            return spark.createDataFrame([(1, 5), (2, 5), (2, 6)], "new_id long, game long")

        def follows(self):
            return spark.createDataFrame([(1, 2), (1, 2), (2, 1), (2, 2), (1, 3)], "src long, dst long")

    v, und, udeg = registry._pair_graph(Rows())
    assert v.inputFiles() and und.inputFiles() and udeg.inputFiles()
    assert {x.id for x in v.collect()} == {1, 2}
    assert sorted(map(tuple, und.collect())) == [(1, 2), (2, 1), (2, 2)]
