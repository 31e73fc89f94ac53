"""File readers of the loaders (A1-A3) with the loaders' parse rules.

Schemas are declared (no inference).  CSV and JSON-lines inputs are split
across tasks by Spark, and so is the single-object JSON feature map: its records
end at the closing bracket of each list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkrec.functions.exprs import bool_false_default, bool_lenient, int_lenient, int_strict

USERS_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                 ("id", "days", "mature", "views", "partner", "new_id")])
EDGES_CSV_SCHEMA = T.StructType([T.StructField("from", T.StringType()), T.StructField("to", T.StringType())])


def read_users_csv(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """A2: ``id,days,mature,views,partner,new_id`` with a header.

    strict (relational loader): integers must parse (B1, error under ANSI),
    booleans are true iff the text is 'true' in any case (B3);
    lenient (graph loader): bad integers -> NULL (B2), booleans true/false/NULL (B4).
    """
    raw = spark.read.schema(USERS_CSV_SCHEMA).option("header", True).csv(path)
    to_int = int_lenient if lenient else int_strict
    to_bool = bool_lenient if lenient else bool_false_default
    return raw.select(to_int(F.col("new_id")).cast("bigint").alias("new_id"),
                      to_int(F.col("id")).cast("bigint").alias("ids"),
                      to_int(F.col("days")).alias("days"),
                      to_bool(F.col("mature")).alias("mature"),
                      to_int(F.col("views")).alias("views"),
                      to_bool(F.col("partner")).alias("partner"))


def read_edges_csv(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """A3: header ``from,to`` -> ``src, dst`` integers (duplicates kept)."""
    raw = spark.read.schema(EDGES_CSV_SCHEMA).option("header", True).csv(path)
    to_int = int_lenient if lenient else int_strict
    return raw.select(to_int(F.col("from")).cast("bigint").alias("src"),
                      to_int(F.col("to")).cast("bigint").alias("dst"))


# One record of the feature map, cut at the closing bracket of its list.
_MAP_RECORD = r'^\s*[{,]\s*"\s*(-?[0-9]+)\s*"\s*:\s*\[([\s0-9,-]*)$'
_MAP_END = r"^\s*(\{\s*)?\}?\s*$"
_INT_LIST = r"^\s*(-?[0-9]+\s*(,\s*-?[0-9]+\s*)*)?$"


def read_feature_map(spark: SparkSession, path: str, check_end: bool = True) -> DataFrame:
    """A1: one JSON object ``{"<user id>": [game, ...], ...}`` -> long form
    ``(new_id, game)``; the key text becomes the integer id.

    The text is split at ``]``, which in this form only ends a list, so Spark
    reads a large object (one file, or part files that make it up in name order)
    in many tasks, whatever its line breaks.  A user with an empty list gives
    one row with a null game; an empty object or file gives no rows.  A record
    of any other form (a list in a list, a text) stops the job with an error.
    A cut-off text can only be told by its missing closing brace: ``check_end``
    looks for it in one more pass over the text and raises ValueError.
    """
    rec = spark.read.option("lineSep", "]").text(path)
    if check_end:
        closed = F.max(F.col("value").rlike(r"\}\s*$"))
        if rec.where(F.trim("value") != "").agg(closed).first()[0] is False:
            raise ValueError(f"{path}: the feature map has no closing brace")
    text = F.regexp_extract("value", _MAP_RECORD, 2)
    good = F.col("value").rlike(_MAP_RECORD) & text.rlike(_INT_LIST)
    bad = F.concat(F.lit("not a feature-map record: "), F.substring("value", 1, 200))
    key = F.when(good, F.regexp_extract("value", _MAP_RECORD, 1).cast("bigint")).otherwise(
        F.raise_error(bad).cast("bigint"))
    games = F.filter(F.split(text, r"\s*,\s*"), lambda x: F.trim(x) != "")
    return (rec.where(~F.col("value").rlike(_MAP_END))
            .select(key.alias("new_id"), F.transform(games, lambda x: F.trim(x).cast("bigint")).alias("games"))
            .select("new_id", F.explode_outer("games").alias("game")))


def write_feature_map(features: DataFrame, path: str) -> None:
    """``(new_id, features)`` as part files that make up one JSON object in name
    order: sorted by id, every part written by its own task.  Rows without an id
    are dropped; a null list becomes an empty one."""
    f = features.where(F.col("new_id").isNotNull()).select(F.col("new_id").cast("bigint").alias("new_id"), "features")
    first = f.agg(F.min("new_id")).first()[0]
    if first is None:
        f.sparkSession.range(1).select(F.lit("{}")).coalesce(1).write.text(path)
        return
    games = F.concat_ws(", ", F.transform(F.coalesce("features", F.array()), lambda x: x.cast("string")))
    body = F.concat(F.when(F.col("new_id") == first, "{").otherwise(","), F.lit('"'), F.col("new_id").cast("string"),
                    F.lit('": ['), games, F.lit("]"))
    rows = f.select("new_id", body.alias("value")).union(
        f.sparkSession.range(1).select(F.lit(None).cast("bigint"), F.lit("}")))
    order = F.col("new_id").asc_nulls_last()
    rows.repartitionByRange(order).sortWithinPartitions(order).select("value").write.text(path)


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """Splittable form of A1: one ``{"new_id": .., "features": [..]}`` per line."""
    schema = "new_id bigint, features array<bigint>"
    return (spark.read.schema(schema).json(path)
            .select("new_id", F.explode_outer("features").alias("game")))


def features_to_json(df: DataFrame) -> DataFrame:
    """``features`` array -> JSON text."""
    return df.select("new_id", F.to_json("features").alias("features_json"))
