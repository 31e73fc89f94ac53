"""Interaction scores from activity events.

The stream consumer (``linkrec.streaming``) and the daily batch share the same
``weighted_events`` expression, so both compute the same score (L6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrec.functions.exprs import action_weight

PAIR = ["user_id", "target_user_id"]


def weighted_events(events: DataFrame) -> DataFrame:
    """One row per event with the weight of its action."""
    return events.withColumn("weight", action_weight(F.col("action")))


def interaction_scores(events: DataFrame) -> DataFrame:
    """Running score per ordered pair = sum of the action weights.

    Map-side partial sums, one shuffle on the pair key.  Negative scores
    (unfollow) are kept, as in the reference.
    """
    return (weighted_events(events).groupBy(*PAIR)
            .agg(F.sum("weight").alias("interaction_score"),
                 F.max("ts").alias("last_updated")))


def ingest_counts(interactions: DataFrame, exact: bool = True) -> DataFrame:
    """Number of interaction rows and of distinct users.

    ``exact=False`` uses HyperLogLog (``approx_count_distinct``), which needs
    no shuffle of distinct keys at very large scale.
    """
    distinct = (F.countDistinct("user_id") if exact
                else F.approx_count_distinct("user_id", 0.01))
    return interactions.agg(F.count(F.lit(1)).alias("interaction_count"),
                            distinct.alias("unique_users"))


def positive_postings(interactions: DataFrame) -> DataFrame:
    """Long form of D2: distinct (user, target) with score > 0."""
    return (interactions.where(F.col("interaction_score") > 0)
            .select("user_id", "target_user_id").distinct())


def interaction_sets(interactions: DataFrame) -> DataFrame:
    """``array_agg(DISTINCT target) ... WHERE score > 0 GROUP BY user``.

    Array form for display / small outputs; the similarity operators use the
    long form so that no user's set has to fit in one row.
    """
    return (positive_postings(interactions).groupBy("user_id")
            .agg(F.sort_array(F.collect_set("target_user_id")).alias("targets")))


def additive_upsert(current: DataFrame, delta: DataFrame, key=PAIR,
                    value: str = "interaction_score", touched: str = "last_updated") -> DataFrame:
    """Insert, or add to the existing value and touch the time column.

    ``current`` and ``delta`` share the schema ``key + [value, touched]``.
    """
    return (current.select(*key, value, touched).unionByName(delta.select(*key, value, touched))
            .groupBy(*key).agg(F.sum(value).alias(value), F.max(touched).alias(touched)))
