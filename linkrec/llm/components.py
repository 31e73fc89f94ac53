"""Connected components of an undirected edge table, without collecting any group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrec.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of `edges`; component is the smallest
    node reachable.

    Alternates two star steps on a distinct edge list kept as (big, small):
    every node's larger neighbours are moved to its smallest neighbour, then
    its smaller ones are.  Both are a `min` per node (partial aggregation, so a
    hub costs no task more than others) and an equi-join that AQE may split.
    Each round is a written table; the rounds end when no edge changes, after
    about log2 of the longest chain.
    """
    spark = edges.sparkSession
    cur = materialize(_oriented(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))), "components")
    before = None
    while True:
        stamp = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first()
        if stamp == before:
            break
        before = stamp
        both = cur.select(F.col("big").alias("x"), F.col("small").alias("y")).union(
            cur.select(F.col("small").alias("x"), F.col("big").alias("y")))
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = _oriented(large)
        low = large.groupBy("big").agg(F.min("small").alias("m"))
        small = large.join(low, "big").select(F.col("small").alias("x"), F.col("m").alias("y")).union(
            low.select(F.col("big").alias("x"), F.col("m").alias("y")))
        cur = materialize(_oriented(small), "components")
    roots = cur.select(F.col("small").alias("node"), F.col("small").alias("component")).distinct()
    return cur.select(F.col("big").alias("node"), F.col("small").alias("component")).union(roots)


def _oriented(pairs: DataFrame) -> DataFrame:
    return (pairs.where("x <> y").select(F.greatest("x", "y").alias("big"), F.least("x", "y").alias("small"))
            .distinct())
