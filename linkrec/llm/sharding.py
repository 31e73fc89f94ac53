"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a hash u in (0, 1); a record goes to the shard with
the least -ln(u) / weight.  A shard wins a share of the keys in proportion to its weight, and a
new shard only takes over the records it now wins: no record moves between two
old shards.  The law is ``key``: the record key and the shards' numbers and
weights decide, nothing else does.

Edge cases: a null key is hashed as one fixed key; rows that repeat a key land
in one shard; an empty table gives no rows; columns of the input that clash
with added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrec.llm.common import HASH_SPAN, hash52, rank_by_hash


def _score(key: str, shard: int, weight: float) -> Column:
    u = (hash52(F.col(key), F.lit(shard)).cast("double") + F.lit(0.5)) / F.lit(HASH_SPAN)
    return -F.log(u) / F.lit(float(weight))


def _best(key: str, weights: list[float]) -> Column:
    return F.array_min(F.array(*[F.struct(_score(key, i, w).alias("score"), F.lit(i).alias("shard"))
                                 for i, w in enumerate(weights)]))


def assign_shards(df: DataFrame, weights: list[float], key: str = "doc_id", out: str = "shard",
                  grown: tuple[str, float] | None = None) -> DataFrame:
    """Adds `out`, the record's shard 0..len(weights)-1; a projection, no shuffle.

    grown: (column, weight) also adds the shard after one more shard of that
    weight joins.  Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    best = df.withColumn("_best", _best(key, weights)).withColumn(out, F.col("_best.shard"))
    if grown:
        name, weight = grown
        n = len(weights)
        best = best.withColumn(name, F.when(_score(key, n, weight) < F.col("_best.score"), F.lit(n))
                               .otherwise(F.col(out)))
    return best.drop("_best")


def shard_slots(df: DataFrame, key: str = "doc_id", shard: str = "shard", out: str = "slot",
                ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds `out`: the record's place in its shard, gapless from 0, in the order
    of its key's hash.  A shard is ranked in ranges (`rank_by_hash`), so a shard
    of any size is spread over tasks."""
    return (rank_by_hash(df.withColumn("_h", hash52(F.col(key))), [shard], "_h", [key, *ties], out)
            .drop("_h"))


def shard_documents(docs: DataFrame, n_shards: int = 8, weights: list[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.
    Null texts count as empty."""
    weights = weights or [1.0] * n_shards
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign_shards(rows, weights, grown=("grown_shard", 1.0))
    return shard_slots(rows, ties=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
