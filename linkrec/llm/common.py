"""Shared column expressions and small Spark helpers of the llm operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: ASCII white space, \x20 and \x09-\x0D, as the members of a character class.
WS = " \\t\\n\\x0B\\f\\r"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hash order keys are 52-bit integers, exact as doubles.
HASH_SPAN = float(1 << 52)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of few rows: texts may be very long, so a batch is kept
    to `rows` documents (and Spark's own byte limit)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def hash52(*cols) -> Column:
    """52-bit hash of the columns' text (null as \\x00), the same in any engine with md5."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                        F.lit("\x00")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint")


def ascii_lower(c: Column) -> Column:
    """A-Z only.  For pure ASCII text that is lower(), which is much faster."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def ascii_trim(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def word_count(c: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; null and empty: 0."""
    t = ascii_trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"[{WS}]+"))).cast("bigint")


def row_key(text: str = "text") -> Column:
    """Second half of a row's identity next to doc_id, so that rows that repeat a
    doc_id with another text stay apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def rank_by_hash(df: DataFrame, groups: list[str], h: str, ties: list[str], out: str,
                 per_task: int = 50_000, equal: bool = False) -> DataFrame:
    """Gapless rank from 0 inside each group in the order (h, ties); equal: rows
    that agree in (h, ties) all get the lowest of their ranks.

    A group is cut into ranges of the evenly spread 52-bit key `h`, one for
    every `per_task` of its rows; rows are ranked inside a range and the counts
    of the lower ranges are added.  No task sorts a whole group, however large.
    Group columns must not be null.
    """
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    parts = (F.floor((F.col("_n") - 1) / F.lit(per_task)) + 1).cast("bigint")
    cut = (df.join(sizes, groups)
           .withColumn("_b", F.floor(F.col(h) / F.lit(HASH_SPAN) * parts).cast("bigint")).drop("_n"))
    counts = (df.select(*groups, h).join(sizes, groups)
              .withColumn("_b", F.floor(F.col(h) / F.lit(HASH_SPAN) * parts).cast("bigint"))
              .groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_c")))
    before = W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    inside = W.partitionBy(*groups, "_b").orderBy(h, *ties)
    return (cut.withColumn("_r", (F.rank() if equal else F.row_number()).over(inside) - 1)
            .join(offsets, [*groups, "_b"])
            .withColumn(out, (F.col("_r") + F.col("_o")).cast("bigint")).drop("_b", "_r", "_o"))
