"""The corpus pipeline, every stage on its own input, against brute force in plain Python."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from linkrec.llm import toxicity
from tests.llm.test_mixing import shares
from tests.llm.test_odd_sketch import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = " ".join(f"question{i}" for i in range(20))


class AllTerms:
    """Distance to every term of the lexicon by the full table."""

    def __init__(self, terms, not_terms):
        self.terms, self.not_terms = terms, set(not_terms)

    def match(self, word):
        if word in self.terms:
            return word, 0
        for t in self.terms if word not in self.not_terms else ():
            if len(t) >= 5 and word[:1] == t[0] and self.distance(word, t) == 1:
                return t, 1
        return None

    @staticmethod
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[:], i
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]


def corpus():
    rng = random.Random(11)
    vocab = [f"{a}{b}" for a in ("lo", "mi", "ner", "ta", "vel", "quo") for b in ("ran", "sim", "dor", "fex", "pul", "gat", "zen")]
    prose = lambda n: " ".join(rng.choices(vocab, k=n))
    texts = [prose(rng.randrange(20, 90)) for _ in range(150)]
    toxic = [f"{prose(12)} you {w} {prose(12)}" for w in ["idiot", "moron"] * 30]
    fresh = [f"{prose(12)} you {w} {prose(12)}" for w in ("idiot", "idjot", "1d10t")]
    copies = [t for t in texts[:12]] + [t + " " + prose(2) for t in texts[12:24]] + [texts[0]] * 20
    leaks = [f"{prose(15)} {ITEM} {prose(9)}", ITEM, " ".join(ITEM.split()[:19])]
    rest = [None, "", "  ", prose(3), prose(4000), " ".join(ITEM.split()[:9]) + " " + prose(9)]
    all_ = texts + toxic + fresh + copies + leaks + rest
    sources = ["web"] * 6 + ["books", "code", None]
    rows = [(i, t, "en", rng.choice(sources), len(t or "")) for i, t in enumerate(all_)]
    rng.shuffle(rows)
    labels = [(i, 1, int(len(texts) <= i)) for i in range(len(texts) + len(toxic))]
    at = {"fresh": len(texts) + len(toxic), "leaks": len(all_) - len(rest) - len(leaks)}
    return rows, labels, at


def grams(text, w=5):
    words = (text or "").lower().split()
    return {tuple(words[i:i + w]) for i in range(len(words) - w + 1)}


def shard_of(key, n):
    def score(s):
        h = int(hashlib.md5(f"{key}|{s}".encode()).hexdigest()[:13], 16)
        return -math.log((h + 0.5) / 2.0 ** 52)
    return min(range(n), key=score)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("pipeline")
    rows, labels, _ = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
    return str(d)


def test_every_stage_matches_brute_force(spark, folder):
    rows, _, at = corpus()
    stage = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "minhash_near_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    def step(name, df):
        out = cp.materialize(stage[name](spark, df, folder), name)
        return out, [tuple(r) for r in out.collect()]

    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert model["terms"] == ["idiot", "moron"]
    known = toxicity.Tokens(AllTerms(model["terms"], model["not_terms"]))
    w = np.array(model["weights"])
    calm = [r for r in rows if w[0] + toxicity.features(r[1], known) @ w[1:] < 0]
    docs, got = step("toxicity", docs)
    assert Counter(got) == Counter(calm)
    assert {r[0] for r in rows} - {r[0] for r in got} == set(range(150, at["fresh"] + 3))

    component = brute([(r[0], r[1]) for r in got], 5, 80)
    want = [r for r in got if component[r[0]][1] == r[0]]
    docs, got = step("minhash_near_dedup", docs)
    assert Counter(got) == Counter(want) and len(want) < len(calm) - 30

    item = grams(ITEM)
    want = [r for r in got if len(grams(r[1]) & item) < 0.8 * len(item)]
    gone = {r[0] for r in got} - {r[0] for r in want}
    docs, got = step("decontamination", docs)
    assert Counter(got) == Counter(want) and gone and gone <= set(range(at["leaks"], at["leaks"] + 3))

    size = lambda r: len((r[1] or "").split())
    sizes = Counter()
    for r in got:
        sizes[r[3]] += size(r)
    goal, before = shares(sizes), Counter(got)
    docs, got = step("mixing", docs)
    taken = Counter()
    for r in got:
        taken[r[3]] += size(r)
    assert set(got) <= set(before) and max(Counter(got).values()) <= 2
    largest = {s: max(size(r) for r in before if r[3] == s) for s in sizes}
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1 for s in goal)

    out = stage["sharding"](spark, docs, folder)
    assert out.columns[:5] == docs.columns
    want = Counter((*r, shard_of(r[0], 8), shard_of(r[0], 9)) for r in got)
    last = Counter(tuple(r) for r in out.select(*docs.columns, "shard", "grown_shard").collect())
    assert last == want
    whole = cp.run(spark, folder).select(*docs.columns, "shard", "grown_shard").collect()
    assert Counter(tuple(r) for r in whole) == want


def test_stages_keep_clashing_columns_and_empty_tables(spark, folder):
    rows, _, _ = corpus()
    extra = (spark.createDataFrame([*rows[:40], (None, "a row of no key", "en", "web", 0)], SCHEMA)
             .selectExpr("*", "'x' as shard", "1 as copies", "2 as score", "3 as row", "4 as item_id", "5 as toxic"))
    for name, fn in cp.STAGES:
        out = fn(spark, extra, folder)
        assert set(extra.columns) <= set(out.columns), name
        assert out.where("doc_id is null").count() >= (name != "mixing"), name
        assert fn(spark, extra.limit(0), folder).count() == 0, name
