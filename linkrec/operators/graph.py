"""Graph basics on edge DataFrames.

No graph type: a graph is a vertex DataFrame (``id``) plus an edge DataFrame
(``src, dst``).  Everything is joins and aggregates, so the work is
partitioned by vertex id and never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def graph_project(follows: DataFrame) -> DataFrame:
    """Directed projection of FOLLOWS: distinct (src, dst)."""
    return follows.select("src", "dst").distinct()


def known_edges(edges: DataFrame, vertices: DataFrame, vid: str = "id") -> DataFrame:
    """C4: keep edges whose two endpoints are known vertices (duplicates kept)."""
    v = vertices.select(F.col(vid).alias("_v"))
    return (edges.join(v, edges.src == v._v, "left_semi")
            .join(v, edges.dst == v._v, "left_semi"))


def directed_graph(edges: DataFrame, vertices: DataFrame, vid: str = "id") -> DataFrame:
    """G1: deduplicated directed edges between known vertices."""
    return known_edges(edges, vertices, vid).select("src", "dst").distinct()


def undirected(edges: DataFrame) -> DataFrame:
    """Direction dropped, reciprocal edges merged; a self-loop stays once."""
    e = edges.select("src", "dst")
    return e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def degrees(directed: DataFrame, vertices: DataFrame, vid: str = "id") -> DataFrame:
    """In- and out-degree of every vertex, 0 for isolated ones."""
    ind = directed.groupBy(F.col("dst").alias(vid)).agg(F.count(F.lit(1)).alias("in_degree"))
    outd = directed.groupBy(F.col("src").alias(vid)).agg(F.count(F.lit(1)).alias("out_degree"))
    return (vertices.select(vid).join(ind, vid, "left").join(outd, vid, "left")
            .select(vid, F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
                    F.coalesce("out_degree", F.lit(0)).alias("out_degree")))


def undirected_degree(und: DataFrame, vertices: DataFrame, vid: str = "id") -> DataFrame:
    """Neighbour count, and degree in which a self-loop counts twice."""
    d = und.groupBy(F.col("src").alias(vid)).agg(
        F.count(F.lit(1)).alias("n_nbrs"),
        F.sum((F.col("src") == F.col("dst")).cast("int")).alias("_loops"))
    return (vertices.select(vid).join(d, vid, "left")
            .select(vid, F.coalesce("n_nbrs", F.lit(0)).alias("n_nbrs"),
                    (F.coalesce("n_nbrs", F.lit(0)) + F.coalesce("_loops", F.lit(0))).alias("degree")))


def triangles(und: DataFrame) -> DataFrame:
    """Triangles through each vertex of the simple undirected graph.

    Edges are oriented from the lower to the higher (degree, id), which bounds
    every vertex's out-list by sqrt(2m).  Paths a->b->c are an equi-join on
    ``b`` (a hot ``b`` is split by AQE's skew join: its in-list is large, its
    out-list small), closed by a semi-join on the pair (a, c).  Each triangle
    is found once and credited to its three corners.
    """
    s = und.where(F.col("src") != F.col("dst")).select("src", "dst")
    d = s.groupBy("src").agg(F.count(F.lit(1)).alias("_d"))
    r = s.join(d.select(F.col("src"), F.col("_d").alias("_ds")), "src") \
         .join(d.select(F.col("src").alias("dst"), F.col("_d").alias("_dd")), "dst")
    up = r.where((F.col("_ds") < F.col("_dd")) |
                 ((F.col("_ds") == F.col("_dd")) & (F.col("src") < F.col("dst")))).select("src", "dst")
    ab = up.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    bc = up.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    ac = up.select(F.col("src").alias("a"), F.col("dst").alias("c"))
    tri = ab.join(bc, "b").join(ac, ["a", "c"], "left_semi")
    corners = tri.select(F.explode(F.array("a", "b", "c")).alias("id"))
    return corners.groupBy("id").agg(F.count(F.lit(1)).alias("triangles"))


def clustering(und: DataFrame, vertices: DataFrame, vid: str = "id") -> DataFrame:
    """Local clustering 2T / (d (d-1)) without self-loops; 0 if d < 2."""
    s = und.where(F.col("src") != F.col("dst"))
    d = s.groupBy(F.col("src").alias(vid)).agg(F.count(F.lit(1)).alias("_d"))
    t = triangles(und).withColumnRenamed("id", vid)
    dd = F.coalesce("_d", F.lit(0))
    return (vertices.select(vid).join(d, vid, "left").join(t, vid, "left")
            .select(vid, F.when(dd >= 2, 2.0 * F.coalesce("triangles", F.lit(0)) / (dd * (dd - 1)))
                    .otherwise(F.lit(0.0)).alias("clustering")))


def adjacency_sizes(edges: DataFrame) -> DataFrame:
    """D3 in aggregate form: length of each source's list and of its set.

    The list itself stays in long form (``edges``); it is never packed into
    one row per source, because a hub's list is unbounded."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("n_list"),
                                    F.countDistinct("dst").alias("n_set"))
