"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

1. Each text becomes its set of 64-bit shingle hashes (`w` words), that set's
   fingerprint, `bands * rows` MinHash samples, one key per band, and an odd
   sketch: the samples folded into a bitmap of parities.
2. Documents of the same set are one node (its smallest doc_id).
3. Round 1 pairs each band bucket's leader (its smallest node) with the
   bucket's other members: linear in the members, whatever the bucket's size.
4. A pair stays if its set sizes allow the threshold and the population count
   of its sketches' XOR is possible for it; then its full sets are compared.
5. Round 2 takes the buckets that still span several components and joins the
   members outside the bucket's largest component with those of its other
   components.  The join's condition holds the sizes and the odd sketch of the
   whole sets, whose XOR count is never above the sets' difference, so only
   pairs that are linked, or nearly so, leave the join; step 4 follows.

After round 2 every two members of a bucket are in one component or were
compared, so nothing depends on caps and no group is expanded into its pairs.
Documents at the threshold share no bucket with probability
(1 - t**rows)**bands, 2.4e-7 for t = 0.85, rows = 5, bands = 26.  The XOR count
is at most twice the number of differing samples; the bound is the count that
a pair at the threshold exceeds with probability under 1e-9.

Edge cases: null, empty and word-less texts have no shingles and link with
nothing; texts of fewer than `w` words are one shingle; rows that repeat a
doc_id are one document; rows without a doc_id link with nothing and are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrec.llm.common import small_batches
from linkrec.llm.components import connected_components
from linkrec.session import materialize

BANDS, ROWS, BITS = 26, 5, 1024
WORDS = [f"p{i}" for i in range(BITS // 64)]
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL[0]
    x = (x ^ (x >> np.uint64(29))) * _MUL[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, w: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's w-word shingles (A-Z lower-cased,
    words parted by ASCII white space; bytes.split and bytes.lower do just that)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < w:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(h) - w + 1
    s = h[:n].copy()
    for i in range(1, w):
        s = _mix(s) + h[i:n + i]
    return np.unique(_mix(s))


def _permutations(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    return rng.integers(0, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, k, np.uint64)


def min_samples(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 512):
        np.minimum(out, (np.multiply.outer(a, s[i:i + 512]) + b[:, None]).min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray, bits: int, salted: bool = True) -> np.ndarray:
    """(documents, k) samples -> (documents, bits / 64) words of parities.
    salted: a value counts as another one in each of the k places."""
    n, k = samples.shape
    at = _mix(samples + _MUL[2] * np.arange(1, k + 1, dtype=np.uint64)) if salted else _mix(samples)
    at = at % np.uint64(bits)
    at = at.astype(np.int64) + bits * np.arange(n)[:, None]
    odd = (np.bincount(at.ravel(), minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1).view(np.int64)


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    m = samples[:, :bands * rows].reshape(-1, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), m.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key) + m[:, :, i]
    return _mix(key).view(np.int64)


def sketch_bound(k: int, threshold: float, miss: float = 1e-9) -> int:
    """Twice the number of differing samples that a pair at the threshold exceeds
    with a probability below `miss`."""
    tail, p = 0.0, 1 - threshold
    for m in range(k, -1, -1):
        tail += comb(k, m) * p ** m * threshold ** (k - m)
        if tail > miss:
            return 2 * m
    return 0


def _signatures(w: int, bands: int, rows: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _permutations(bands * rows)
        for pdf in batches:
            sets = [shingle_set(t, w) for t in pdf["text"]]
            full = [i for i, s in enumerate(sets) if len(s)]
            out = pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": [len(s) for s in sets]})
            fp, keys, odd, parity = ([None] * len(sets) for _ in range(4))
            if full:
                m = np.stack([min_samples(sets[i], a, b) for i in full])
                for i, kk, oo in zip(full, band_keys(m, bands, rows), odd_sketch(m, bits)):
                    fp[i], keys[i], odd[i] = hashlib.md5(sets[i].tobytes()).digest(), kk, oo
                    parity[i] = odd_sketch(sets[i][None, :], bits, salted=False)[0]
            yield out.assign(fp=fp, bands=keys, odd=odd, parity=parity)
    return run


def _sets(w: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["doc_id"], "shingles": [shingle_set(t, w).view(np.int64)
                                                                    for t in pdf["text"]]})
    return run


def near_duplicates(docs: DataFrame, threshold: float = 0.8, w: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs` (doc_id, text, ...)."""
    spark = docs.sparkSession
    small_batches(spark)
    percent = round(threshold * 100)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sig = materialize(texts.mapInPandas(
        _signatures(w, bands, rows, BITS),
        "doc_id long, n_shingles long, fp binary, bands array<long>, odd array<long>, parity array<long>"), "signatures")
    known = sig.where("fp is not null and doc_id is not null")
    nodes = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
                                                F.first("bands").alias("bands"), F.first("odd").alias("odd"),
                                                F.first("parity").alias("parity")),
                        "nodes")
    member = materialize(_buckets(nodes), "members")
    sketches = nodes.select("node", "odd")
    bound = sketch_bound(bands * rows, threshold)

    first = member.where("node <> leader").select(
        F.col("leader").alias("a"), F.col("leader_n").alias("a_n"), F.col("node").alias("b"), F.col("n").alias("b_n"))
    edges = _confirm(_sized(first, percent), sketches, texts, bound, w, percent)
    # documents that share an id over different sets are one node of several sets
    same = known.join(nodes.select("fp", "node"), "fp").where("doc_id <> node").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b")).distinct()
    comp = materialize(connected_components(edges), "found")

    placed = member.join(comp, "node", "left").select(
        "bucket", "leader", "node", "n", F.coalesce("component", "node").alias("component"))
    by_bucket = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ = materialize(placed.join(by_bucket.where("lo <> hi").select("bucket"), "bucket", "left_semi")
                        .join(nodes.select("node", *_words("parity")), "node"), "open")
    main = (open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("bucket").agg(F.max_by("component", F.struct("c", "component")).alias("main")))
    open_ = open_.where("node <> leader")
    left = open_.join(main, "bucket").where("component <> main").select(
        "bucket", "main", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "component", *WORDS)])
    right = open_.select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "component", *WORDS)])
    second = left.join(right, (left["bucket"] == right["bucket"]) & F.expr(
        "a_component <> b_component and (b_component = main or a_node < b_node)"
        f" and 100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)"
        # (1 - t) / (1 + t) of both sizes: the most that two linked sets differ in
        f" and (100 + {percent}) * ({_odd_count()}) <= (100 - {percent}) * (a_n + b_n)"))
    pairs = second.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
    more = _confirm(pairs, sketches, texts, bound, w, percent)
    comp = connected_components(edges.union(more).union(same))

    of_set = nodes.select("fp", F.col("node").alias("_node")).join(
        comp.withColumnRenamed("node", "_node"), "_node", "left").select(
        "fp", F.coalesce("component", "_node").alias("_component"))
    return (sig.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("fp")).alias("fp"))
            .join(of_set, "fp", "left")
            .select("doc_id", "n_shingles", F.coalesce("_component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _words(name: str) -> list:
    return [F.get(name, i).alias(c) for i, c in enumerate(WORDS)]


def _odd_count() -> str:
    return " + ".join(f"bit_count(a_{c} ^ b_{c})" for c in WORDS)


def _buckets(nodes: DataFrame) -> DataFrame:
    """Members of the band buckets that hold at least two nodes, with each bucket's leader."""
    rows = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    lead = (rows.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("lead"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("bucket", F.col("lead.node").alias("leader"), F.col("lead.n").alias("leader_n")))
    return rows.join(lead, "bucket")


def _sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose set sizes allow the threshold."""
    return (pairs.where(f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())


def _confirm(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, bound: int, w: int, percent: int) -> DataFrame:
    """Pairs whose sketches may belong to, and whose full sets do reach, the threshold."""
    near = (pairs.join(sketches.select(F.col("node").alias("a"), F.col("odd").alias("a_odd")), "a")
            .join(sketches.select(F.col("node").alias("b"), F.col("odd").alias("b_odd")), "b"))
    differ = F.aggregate(F.zip_with("a_odd", "b_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda s, x: s + x)
    near = materialize(near.where(differ <= bound).select("a", "b"), "candidates")
    ids = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
    return _compare(near, _full_sets(texts, ids, w), percent)


def _full_sets(texts: DataFrame, ids: DataFrame, w: int) -> DataFrame:
    """(node, shingles) of the documents in `ids`; the ids are hashed and the texts stream past them, unsorted."""
    wanted = ids.withColumnRenamed("node", "doc_id").hint("shuffle_hash")
    return materialize(texts.join(wanted, "doc_id", "left_semi").mapInPandas(
        _sets(w), "node long, shingles array<long>"), "sets")


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    return materialize(both.withColumn("_i", F.size(F.array_intersect("sa", "sb")))
                       .where(100 * F.col("_i") >= percent * (F.size("sa") + F.size("sb") - F.col("_i")))
                       .select("a", "b"), "links")
