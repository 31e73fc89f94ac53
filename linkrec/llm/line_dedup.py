"""Line dedup against levelled sorted runs of line hashes, with DataFrame functions only.

Documents come in batches of ascending doc_id.  A run is a table of (key hash, owner), bucketed and
sorted by the hash; the owner is the smallest document that holds the line.  Each
batch looks its keys up in the runs by a merge join in which the runs are not
shuffled again, and adds the keys that the anti-join leaves as a new run.  When a level has
`fanout` runs they are merged into one run of the next level, so a key is
rewritten once per level and a batch meets few runs.

A line loses against an owner with a smaller doc_id.  Rows without a doc_id come
last and count as one document; a row is known by doc_id and text, so rows
that repeat a doc_id stay apart but never drop each other's lines.  Null and
empty texts are one empty line; lines whose key is shorter than `min_chars` stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrec.llm.common import ascii_lower, ascii_trim, row_key
from linkrec.session import materialize, scratch_path

MIN_CHARS, BATCHES, FANOUT = 10, 4, 2
LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return ascii_lower(ascii_trim(line))


class Runs:
    """The levelled runs of one dedup, as bucketed tables in the shared scratch folder."""

    def __init__(self, spark, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def add(self, keys: DataFrame, level: int = 0) -> None:
        """Writes (h1, h2, owner) as a sorted run; full levels are merged upwards."""
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        (keys.select("h1", "h2", "owner").repartition(self.buckets, "h1", "h2")
         .write.format("parquet").option("path", scratch_path(self.spark, name))
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            union = self.spark.table(merged[0])
            for other in merged[1:]:
                union = union.unionByName(self.spark.table(other))
            self.add(union, level + 1)            # runs hold different keys
            self._drop(merged)

    def owners(self, keys: DataFrame) -> DataFrame:
        """`keys` with the column `old`, the owner in the runs, or null."""
        names = [n for level in self.levels for n in level]
        for i, n in enumerate(names):
            keys = keys.join(self.spark.table(n).withColumnRenamed("owner", f"o{i}"), ["h1", "h2"], "left")
        old = F.coalesce(*[F.col(f"o{i}") for i in range(len(names))]) if names else F.lit(None).cast("bigint")
        return keys.withColumn("old", old).drop(*[f"o{i}" for i in range(len(names))])

    def close(self) -> None:
        self._drop([n for level in self.levels for n in level])

    def _drop(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, row, gone): the places, from 0 in ascending order, of the lines that each row of `docs` loses."""
    spark = docs.sparkSession
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    owner = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    batch = sum((F.when(F.col("owner") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    # the row's key in a step of its own: beside the generator it would be hashed anew for every line
    lines = (docs.select(owner.alias("owner"), row_key().alias("row"), F.split("text", "\n").alias("lines"))
             .select("owner", "row", F.posexplode("lines").alias("pos", "line"))
             .select("owner", "row", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select(batch.alias("batch"), "owner", "row", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("line"), "key").alias("h2")))
    path = scratch_path(spark, "line_hashes")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs, gone = Runs(spark, fanout), None
    for i in range(len(cuts) + 1):
        mine = lines.where(F.col("batch") == i)
        keys = mine.groupBy("h1", "h2").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
        known = materialize(runs.owners(keys), "batch_keys")
        hit = known.where("old is not null or first < last").select(
            "h1", "h2", F.coalesce("old", "first").alias("keeper"))
        lost = (mine.join(hit, ["h1", "h2"]).where("keeper < owner")
                .groupBy("owner", "row").agg(F.sort_array(F.collect_set("pos")).alias("gone")))
        lost = materialize(lost, "dropped")
        gone = lost if gone is None else gone.unionByName(lost)
        if i < len(cuts):
            runs.add(known.where("old is null").withColumnRenamed("first", "owner"))
    runs.close()
    return gone.select(F.when(F.col("owner") < LAST, F.col("owner")).alias("doc_id"), "row", "gone")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """`docs` with the added columns n_lines, n_dropped and kept (the remaining lines, joined by \\n)."""
    gone = dropped_lines(docs, min_chars, batches, fanout).select(
        F.coalesce("doc_id", F.lit(LAST)).alias("_o"), F.col("row").alias("_r"), F.col("gone").alias("_gone"))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"_o2": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)), "_r2": row_key()})
    joined = keyed.join(gone.hint("shuffle_hash"), (F.col("_o2") == F.col("_o")) & (F.col("_r2") == F.col("_r")), "left")
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return joined.withColumns({
        "n_lines": n_lines.cast("bigint"),
        "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"),
        "kept": F.when(F.col("_gone").isNull(), text).otherwise(_without(text, F.col("_gone")))}).drop(
            "_o", "_r", "_gone", "_o2", "_r2")


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines at the ascending places `gone`.  A mark of one byte a line tells which are
    lost, so each line costs one look, however many are lost."""
    gaps = F.zip_with(F.concat(F.array(F.lit(-1)), F.slice(gone, F.lit(1), F.size(gone) - 1)), gone,
                      lambda a, b: F.concat(F.repeat(F.lit("0"), b - a - 1), F.lit("1")))
    marks = F.array_join(gaps, "").cast("binary")

    def kept(s: Column) -> Column:
        return F.array_join(F.filter(s["lines"], lambda x, i: F.substring(s["marks"], i + 1, F.lit(1)) != F.lit(b"1")), "\n")
    # the one-element array has the text cut and the marks made once, not once a line
    return F.get(F.transform(F.array(F.struct(F.split(text, "\n").alias("lines"), marks.alias("marks"))), kept), F.lit(0))


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
