"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, exact rerank.

Vectors are scaled to length 1 and assigned to the nearest of `n_lists` coarse
centroids; the residual is coded in `subspaces` parts of 256 codewords each.
Every vector queries its `probes` nearest lists.  In a list, distances are added up from
tables of the query's residual against all codewords (asymmetric); a member stays if that
distance, less the member's own quantisation error, could be within the
threshold, which never loses a link; the exact cosine in double precision
decides.  Only the probes approximate: a pair is missed if neither vector probes
the other's list.  Tests measure the recall against brute force.

Centroids and codewords are fitted to a bounded sample (`SAMPLE` rows, first in hash order); every
row is indexed.  Identical vectors are one node with its count.  Lists are cut
into blocks of members and of queries, so no task holds a whole list, and a
block pair returns counts and the edges of a spanning forest, never all pairs.

Edge cases: vectors that are null, empty, zero, hold null or non-finite components
link with nothing and are their own component; vectors of each length are indexed apart and link with none of
another length; huge and tiny vectors are scaled first, so their squares stay in the range of doubles; rows that repeat a vec_id with the same vector are one vector; rows without a vec_id keep a null component.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrec.llm.common import hash52, small_batches
from linkrec.llm.components import connected_components
from linkrec.session import materialize

SAMPLE = 16_384
SUBSPACES, CODES, PROBES, BLOCK = 8, 256, 16, 2048
LIST_ROWS, MAX_LISTS = 256, 2048


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c, 1)[:, 0]
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k nearest rows of c, nearest first."""
    d = (c * c).sum(1)[None, :] - 2 * x @ c.T
    k = min(k, len(c))
    part = np.argpartition(d, k - 1, axis=1)[:, :k]
    return np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, 1), axis=1), 1)


def fit_index(sample: np.ndarray, n_lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> dict:
    coarse = kmeans(sample, n_lists)
    residual = sample - coarse[nearest(sample, coarse, 1)[:, 0]]
    edges = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
    books = [kmeans(residual[:, a:b], codes, 6) for a, b in zip(edges, edges[1:])]
    return {"coarse": coarse, "edges": edges, "books": books}


def encode(x: np.ndarray, lists: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the residuals and the length of what they leave."""
    residual = x - index["coarse"][lists]
    left, codes = residual.copy(), np.empty((len(x), len(index["books"])), np.uint8)
    for j, (a, b, book) in enumerate(zip(index["edges"], index["edges"][1:], index["books"])):
        codes[:, j] = nearest(residual[:, a:b], book, 1)[:, 0]
        left[:, a:b] -= book[codes[:, j]]
    return codes, np.sqrt((left ** 2).sum(1))


def asymmetric(x: np.ndarray, codes: np.ndarray, centre: np.ndarray, index: dict) -> np.ndarray:
    """Squared distances of queries to coded members of one list, by table look-up."""
    out = np.zeros((len(x), len(codes)))
    for j, (a, b, book) in enumerate(zip(index["edges"], index["edges"][1:], index["books"])):
        q = x[:, a:b] - centre[a:b]
        lut = (q * q).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * q @ book.T
        out += lut[:, codes[:, j]]
    return out


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges of a spanning forest of the graph with edges (a, b)."""
    root: dict = {}

    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v
    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            keep.append(i)
    return np.array(keep, int)


def _assign(index: dict, probes: int):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["unit"].to_numpy())
                near = nearest(x, index["coarse"], probes)
                codes, err = encode(x, near[:, 0], index)
                yield pd.DataFrame({"node": pdf["node"], "copies": pdf["copies"], "unit": list(x),
                                    "list": near[:, 0], "probes": list(near), "codes": list(codes.astype(np.int16)),
                                    "error": err})
    return run


def _search(index: dict, threshold: float):
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def run(key, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": [], "links": [], "other": []}).astype("int64")
        if not len(queries) or not len(members):
            return empty
        q, m = np.stack(queries["unit"].to_numpy()), np.stack(members["unit"].to_numpy())
        codes = np.stack(members["codes"].to_numpy())
        d = np.sqrt(np.maximum(asymmetric(q, codes, index["coarse"][key[0]], index), 0))
        qid, mid = queries["node"].to_numpy(), members["node"].to_numpy()
        i, j = np.nonzero((d - members["error"].to_numpy()[None, :] <= reach) & (qid[:, None] != mid[None, :]))
        exact = np.concatenate([np.einsum("ij,ij->i", q[i[s:s + 65536]], m[j[s:s + 65536]])
                                for s in range(0, len(i), 65536)] or [np.empty(0)])
        i, j = i[exact >= threshold], j[exact >= threshold]
        if not len(i):
            return empty
        # a member that does not probe the query's list does not find this link by itself
        home = queries["list"].to_numpy()
        probes = np.stack(members["probes"].to_numpy())
        blind = ~(probes[j] == home[i][:, None]).any(1)
        node = np.concatenate([qid[i], mid[j[blind]]])
        links = np.concatenate([members["copies"].to_numpy()[j], queries["copies"].to_numpy()[i[blind]]])
        ids, where = np.unique(node, return_inverse=True)
        counts = pd.DataFrame({"node": ids, "links": np.bincount(where, links).astype("int64"), "other": -1})
        keep = forest(qid[i], mid[j])
        return pd.concat([counts, pd.DataFrame({"node": qid[i][keep], "links": 0, "other": mid[j][keep]})])
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.9, probes: int = PROBES, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding, ...)."""
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    raw = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                         F.col("embedding").cast("array<double>").alias("v"))
    out = raw.select("vec_id").withColumns({"n_links": F.lit(0).cast("bigint"), "component_id": F.col("vec_id")})
    fine = (F.col("vec_id").isNotNull()
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # squares of huge or tiny components leave the range of doubles: such a vector is divided by its largest one first
    plain = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    high = F.array_max(F.transform("v", lambda x: F.abs(x)))
    scale = F.when((plain > 1e-140) & (plain < float("inf")), F.lit(1.0)).otherwise(F.col("high"))
    scaled = (raw.where(fine).withColumn("high", high).where("high > 0").withColumn("scale", scale)
              .withColumn("v", F.transform("v", lambda x: x / F.col("scale"))))
    unit = (scaled.withColumn("l", plain)
            .select("vec_id", F.size("v").alias("d"), F.transform("v", lambda x: x / F.col("l")).alias("unit")).distinct())
    every = materialize(unit, "units")
    # vectors of different length have no cosine: each length has its own index
    lengths = [r["d"] for r in every.select("d").distinct().orderBy("d").collect()]
    if not lengths:
        return out.withColumn("kept", F.lit(True))
    per = reduce(DataFrame.unionByName,
                 [_linked(every.where(F.col("d") == d).drop("d"), threshold, probes, sample) for d in lengths])
    # an id with several vectors has the links of all, and the smallest component
    per = per.groupBy(F.col("vec_id").alias("_id")).agg(
        F.sum("_links").alias("_links"), F.min("_component").alias("_component"))
    return (out.join(per, F.col("vec_id") == F.col("_id"), "left")
            .select("vec_id", F.coalesce("_links", "n_links").alias("n_links"),
                    F.coalesce("_component", "component_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def _linked(unit: DataFrame, threshold: float, probes: int, sample: int) -> DataFrame:
    """(vec_id, _links, _component) of unit vectors (vec_id, unit) of one length, at least one row."""
    ids = materialize(unit.withColumn("same", F.md5(F.to_json("unit"))), "vectors")
    nodes = materialize(ids.groupBy("same").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"),
                                                F.first("unit").alias("unit")), "vector_nodes")
    n = nodes.count()
    rows = nodes.orderBy(hash52("node"), "node").limit(sample).select("unit").collect()
    fitted = fit_index(np.array([r["unit"] for r in rows]), max(1, min(MAX_LISTS, len(rows) // 4, n // LIST_ROWS)))
    coded = materialize(nodes.mapInPandas(_assign(fitted, probes), "node long, copies long, unit array<double>, list int, "
                                          "probes array<int>, codes array<short>, error double"), "codes")
    sizes = coded.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    asked = coded.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n_q"))
    blocks = sizes.join(asked, "list").select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_m"),
                                              F.ceil(F.col("n_q") / BLOCK).cast("int").alias("n_q"))
    cut = F.pmod(F.xxhash64("node"), F.col("n_m")).cast("int")
    members = (coded.join(blocks, "list").withColumn("mb", cut)
               .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1))).drop("n_m", "n_q"))
    queries = (coded.select("node", "copies", "unit", F.col("list").alias("home"), F.explode("probes").alias("list"))
               .join(blocks, "list").withColumn("qb", F.pmod(F.xxhash64("node", "list"), F.col("n_q")).cast("int"))
               .withColumn("mb", F.explode(F.sequence(F.lit(0), F.col("n_m") - 1))).drop("n_m", "n_q")
               .select(F.col("list").alias("at"), "mb", "qb", "node", "copies", "unit", F.col("home").alias("list")))
    found = materialize(queries.groupBy("at", "mb", "qb").cogroup(members.toDF(*members.columns).groupBy("list", "mb", "qb"))
                        .applyInPandas(_search(fitted, threshold), "node long, links long, other long"), "found")
    links = found.where("other = -1").groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("other <> -1").select(F.col("node").alias("a"), F.col("other").alias("b")))
    per = (nodes.select("same", F.col("node").alias("_n"), "copies")
           .join(links.withColumnRenamed("node", "_n"), "_n", "left")
           .join(comp.withColumnRenamed("node", "_n"), "_n", "left")
           .select("same", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
                   F.coalesce("component", "_n").alias("_component")))
    return ids.join(per, "same").select("vec_id", "_links", "_component")
