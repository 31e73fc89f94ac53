import numpy as np
from pyspark.sql import functions as F

from linkrec.llm.pq_dedup import near_vectors


def test_links_and_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 32))
    for k in range(300):                                  # copies at all angles around the threshold
        noise = rng.normal(size=32)
        x[k] = x[1000 + k // 2] / np.linalg.norm(x[1000 + k // 2]) + noise / np.linalg.norm(noise) * rng.uniform(0.1, 0.6)
    x[300:330] = x[999]                                   # identical ones
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 32), (2003, [float("nan")] * 32), (2004, [None] * 32),
             (2005, [1.0] * 7), (None, [1.0] * 32), (5, [float(v) for v in x[5]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(0))
    got = near_vectors(df, probes=4).collect()
    assert len(got) == len(rows)
    n = {r.vec_id: r.n_links for r in got}
    found, all_ = sum(n[i] for i in range(1500)), link.sum()
    assert found <= all_ and found >= 0.95 * all_
    assert all(n[i] <= link[i].sum() for i in range(1500)) and all(n[i] >= 29 for i in range(300, 330))
    assert all((n[i], r) for i, r in [(2000, 0)]) and all(n[i] == 0 for i in range(2000, 2006))
    comp = {r.vec_id: r.component_id for r in got}
    assert comp[329] == min(comp[i] for i in range(300, 330)) and comp[2003] == 2003 and comp[None] is None
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert near_vectors(df.limit(0)).count() == 0


def test_every_length_and_magnitude_links(spark):
    rng = np.random.default_rng(4)
    big = rng.normal(size=(40, 16))
    rows = [(i, [float(v) for v in big[i]]) for i in range(40)]
    rows += [(100, [1e200, 0.0, 0.0]), (101, [1.0, 0.0, 0.0]), (102, [1e-200, 1e-201, 0.0]), (103, [5e-324, 0.0, 0.0]),
             (104, [0.0, 1.0, 0.0]), (105, [-1e308, 0.0, 0.0]), (106, [0.0, 0.0, 0.0])]
    rows += [(200, [2.0] * 5), (201, [3.0] * 5), (300, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert len(got) == len(rows)
    assert [got[i][:2] for i in (100, 101, 102, 103)] == [(3, 100)] * 4
    assert all(got[i] == (0, i, True) for i in (104, 105, 106, 300))
    assert got[200] == (1, 200, True) and got[201] == (1, 200, False)


def test_cosines_just_beside_the_threshold(spark):
    # the cosine of 1 and 2 is 9 / 10: a link for a threshold just below it, none for one just above
    rows = [(1, [3.0, 1.0, 0.0]), (2, [3.0, 0.0, 1.0]), (3, [0.0, 2.0, -2.0]), (4, [0.0, 2.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    n = {r.vec_id: r.n_links for r in near_vectors(df, threshold=0.9 - 1e-12).collect()}
    assert n == {1: 1, 2: 1, 3: 1, 4: 1}
    n = {r.vec_id: r.n_links for r in near_vectors(df, threshold=0.9 + 1e-12).collect()}
    assert n == {1: 0, 2: 0, 3: 1, 4: 1}


def test_recall_with_hundreds_of_lists(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40_000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    a = np.arange(400)
    noise = rng.normal(size=(400, 24))
    noise -= (noise * x[a]).sum(1)[:, None] * x[a]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = rng.uniform(0.9001, 0.99, 400)[:, None]
    x[20_000:20_400] = cosine * x[a] + np.sqrt(1 - cosine ** 2) * noise
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "vec_id long, embedding array<double>")
    n = {r.vec_id: r.n_links for r in near_vectors(df.repartition(8)).collect()}      # 156 lists, 16 probes
    want = sum(((x[i] @ x.T) >= 0.9).sum() - 1 for i in range(400))
    found = sum(n[i] for i in range(400))
    assert found <= want and found >= 0.95 * want
