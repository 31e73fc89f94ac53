import hashlib
import random
import re
import time
import zlib

import pytest

import __spark_entry__ as E
from linkrec.llm.runs import collapse, periodic_runs, repeats, run_report, runs_of, seed_length
from tests.conftest import SF001


def brute(words, least=24, times=3):
    """Every period from 1 on, every longest stretch that keeps it."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def random_words(rng, k):
    n = rng.randrange(0, 120)
    words = [rng.choice("ab" if k % 3 else "abcdefgh") for _ in range(n)]
    for _ in range(rng.randrange(0, 4) if n else 0):
        a, p = rng.randrange(n), rng.randrange(1, 9)
        for i in range(a, min(n, a + rng.randrange(5, 60))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least, times", [(24, 3), (6, 3), (3, 3), (4, 2), (2, 2), (9, 4)])
def test_pairs_are_the_runs(least, times):
    rng = random.Random(least * 10 + times)
    for k in range(400):
        words = random_words(rng, k)
        want = brute(words, least, times)
        assert runs_of(words, least, times) == want, words
        if want:
            assert repeats(words, seed_length(least, times))


def test_long_texts_stay_near_linear():
    start = time.time()
    assert runs_of(["a"] * 100_000) == [(0, 100_000, 1)]
    assert runs_of(["a", "b", "c"] * 30_000 + ["x"] + ["a", "b"] * 10_000) == [(0, 90_000, 3), (90_001, 20_000, 2)]
    line = [str(i) for i in range(40)]
    assert runs_of([w for i in range(2000) for w in [*line, f"u{i}"]]) == []     # one passage, 2,000 left words
    assert time.time() - start < 60


def test_collapse():
    words = list("xyabababababababababababababz")
    assert collapse(words, runs_of(words)) == "x y a b z"
    assert collapse([], []) == "" and collapse(["a"], []) == "a"
    two = ["a"] * 30 + ["b"] * 30
    assert collapse(two, runs_of(two)) == "a b"


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 12_000]
    extra = [(10**6 + i, " ".join(random_words(random.Random(i), i))) for i in range(300)]
    extra += [(None, "a " * 50), (None, None), (-7, ""), (-8, " \n\t "), (-9, "one"), (5, "w " * 3000), (5, "w " * 3000)]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string").selectExpr("*", "'x' as runs", "1 as h", "2 as best")
    got = sorted(map(str, map(tuple, run_report(df).collect())))
    assert got == sorted(str(expected(*r)) for r in rows + extra)
    assert run_report(df.limit(0)).count() == 0
    assert E.queries()["op12_periodic_runs"](spark, SF001).count() == docs.count()


def test_rows_of_the_operator(spark):
    df = spark.createDataFrame([(1, "go " * 40), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(df).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 40, 1)] and got[1].collapsed == "go" and got[1].n_words == 40
    assert got[2].runs == [] and got[2].collapsed == ""
