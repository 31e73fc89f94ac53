import random

import numpy as np
from pyspark.sql import functions as F

from linkrec.llm.components import connected_components
from linkrec.llm.odd_sketch import (_permutations, min_samples, near_duplicates, odd_sketch, shingle_set,
                                    sketch_bound)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, w, percent):
    """Components over all pairs of plain string shingle sets."""
    sets = {}
    for i, t in rows:
        words = "".join(c.lower() if c.isascii() else c for c in (t or ""))
        for ws in "\t\n\x0b\x0c\r":
            words = words.replace(ws, " ")
        words = [x for x in words.split(" ") if x]
        sets[i] = {tuple(words[k:k + w]) for k in range(max(1, len(words) - w + 1))} if words else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(25):
        base = rng.choices(vocab, k=rng.choice([4, 30, 120, 400]))
        for _ in range(rng.choice([1, 2, 6])):
            words = list(base)
            for _ in range(rng.randrange(0, max(1, len(words) // 25) + 1)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(words)))
    chain = rng.choices(vocab, k=300)                    # each links only with its neighbours
    for step in range(12):
        chain = chain[:]
        for k in range(step * 8, step * 8 + 8, 2):
            chain[k * 3 % 300] = f"c{step}_{k}"
        rows.append((len(rows), " ".join(chain)))
    shared = " ".join(rng.choices(vocab, k=60))          # one passage in many documents
    rows += [(len(rows) + k, shared + " " + " ".join(rng.choices(vocab, k=rng.choice([5, 12, 60, 200]))))
             for k in range(40)]
    n = len(rows)
    rows += [(n, ""), (n + 1, None), (n + 2, " \t\n"), (n + 3, "One"), (n + 4, "one"), (n + 5, "one two"),
             (n + 6, "ONE\x0btwo"), (n + 7, "a b c " * 30000), (n + 8, "A B C " * 20000), (n + 9, "É x y z"),
             (n + 10, "é x y z"), (n + 11, "one two")]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    for w, percent in ((3, 85), (5, 80)):
        want = brute(rows, w, percent)
        df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in
               near_duplicates(df, threshold=percent / 100, w=w).collect()}
        assert got == want


def test_nulls_repeats_empty_extra_columns(spark):
    long = "p q r s t u v " * 9
    rows = [(1, long), (1, long), (2, long), (None, long), (3, None), (4, "alone in the world here")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).withColumn("component", F.lit(1))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (3, 3, True),
                          (4, 4, True)], key=str)
    assert near_duplicates(df.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a, b = _permutations(130)
    x = np.unique(rng.integers(0, 1 << 62, 2000, np.uint64))
    y = x.copy()
    y[:160] = rng.integers(0, 1 << 62, 160, np.uint64)             # Jaccard 0.852
    m = np.stack([min_samples(x, a, b), min_samples(np.unique(y), a, b)])
    differ = int((m[0] != m[1]).sum())
    odd = odd_sketch(m, 1024)
    count = sum(bin(int(v) & (2 ** 64 - 1)).count("1") for v in odd[0] ^ odd[1])
    assert count <= 2 * differ <= sketch_bound(130, 0.85)
    est = -512 * np.log(1 - 2 * count / 1024)
    assert abs(est - 2 * differ) < 12
    assert len(shingle_set("a b c d a b c", 3)) == 4


def test_components_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 300)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.component for r in got if r.node <= 60} == {0} and {r.component for r in got if r.node >= 100} == {100}
    assert len(got) == len({r.node for r in got}) == 61 + 200
