"""Driver tables -> the native tables of the recommender.

The recommender works on five logical tables (users, user_features, follows,
events, embeddings).  On the given TPC-H-like tables they are defined as
declarative DataFrame expressions, so the parquet scans get column pruning
and pushed filters (``l_returnflag = 'R'`` reaches the lineitem scan).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrec.functions.exprs import action_from_event_type

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazily built native tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # users(new_id, ids, views, days, partner, mature)
    def users(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            F.col("c_custkey").alias("new_id"),
            F.col("c_custkey").alias("ids"),
            F.col("c_acctbal").alias("views"),
            F.col("c_nationkey").cast("bigint").alias("days"),
            (F.col("c_mktsegment") == F.lit("BUILDING")).alias("partner"),
            (F.col("c_acctbal") < 0).alias("mature"),
        )

    # user_features in long form: distinct (new_id, game)
    def user_games(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        li = self.raw("lineitem").select("l_orderkey", "l_partkey")
        p = self.raw("part").select("p_partkey", "p_size")
        return (o.join(li, o.o_orderkey == li.l_orderkey)
                .join(p, li.l_partkey == p.p_partkey)
                .select(F.col("o_custkey").alias("new_id"),
                        F.col("p_size").cast("bigint").alias("game"))
                .distinct())

    # user_features(new_id, features ARRAY<BIGINT>), sorted game lists
    def user_features(self) -> DataFrame:
        return (self.user_games().groupBy("new_id")
                .agg(F.sort_array(F.collect_list("game")).alias("features")))

    # follows(src, dst): duplicates and self-loops kept, dst may be unknown
    def follows(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        li = (self.raw("lineitem").filter(F.col("l_returnflag") == "R")
              .select("l_orderkey", "l_partkey"))
        return o.join(li, o.o_orderkey == li.l_orderkey).select(
            F.col("o_custkey").alias("src"), F.col("l_partkey").alias("dst"))

    # events(event_id, user_id, target_user_id, action, ts)
    def events(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            "event_id",
            F.col("user_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("target_user_id"),
            action_from_event_type(F.col("event_type")).alias("action"),
            F.col("ts"),
        )

    def embeddings(self) -> DataFrame:
        return self.raw("embeddings")
