"""The corpus pipeline: documents -> toxicity -> near-dedup -> decontamination -> mix -> shards.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and, but for
the last, returns the columns of `docs`; `run` writes each stage's rows as
Parquet in the shared folder and rereads them as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrec.llm import decontam, mixing, odd_sketch, sharding, toxicity
from linkrec.llm.common import table
from linkrec.session import materialize

N_SHARDS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the model learns from the labelled rows of `docs`."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "_score").where("_score < 0.5").drop("_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near copies."""
    again = (odd_sketch.near_duplicates(docs).where("not kept").select("doc_id").distinct())
    return docs.join(again.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, and the one they would have with a shard more."""
    return sharding.assign_shards(docs, [1.0] * N_SHARDS, grown=("grown_shard", 1.0))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned scores and sketches are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
