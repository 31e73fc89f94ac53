"""User feature engineering.

Feature lists stay in long form ``(new_id, game)`` until the last step; the
vector per user is bounded by the game vocabulary, never by the data size.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def users_with_features(users: DataFrame, user_features: DataFrame) -> DataFrame:
    """Users JOIN user_features ON new_id (AQE picks broadcast or SMJ)."""
    return users.join(user_features, "new_id", "inner")


def minmax(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - min) / (max - min) per column over the whole frame; a constant
    column maps to 0 (MLlib's MinMaxScaler would give 0.5).  Fitted like a
    scaler: one aggregate action returns the single row of min/max."""
    # fit: one aggregate pass (partial min/max per task), one row of parameters
    stats = df.agg(*[F.min(c).alias(f"_mn_{c}") for c in cols],
                   *[F.max(c).alias(f"_mx_{c}") for c in cols]).first()
    out = df
    for c in cols:
        mn, mx = stats[f"_mn_{c}"], stats[f"_mx_{c}"]
        if mn is None or mx is None or mx <= mn:
            out = out.withColumn(c + suffix, F.lit(0.0))
        else:
            out = out.withColumn(c + suffix, (F.col(c) - F.lit(float(mn))) / F.lit(float(mx - mn)))
    return out


def dense_index(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """Distinct values of ``col`` numbered 0..m-1 in ascending order.

    Distributed ``zipWithIndex``: range-partition and sort the distinct values,
    number rows inside each partition, and add the partition's offset (a
    running sum over one row per partition).  No global single-task window.
    """
    vals = (df.select(col).distinct().repartitionByRange(col).sortWithinPartitions(col)
            .withColumn("_pid", F.spark_partition_id()))
    # materialise once (reliable checkpoint in the shared folder), so the
    # partition ids seen by the counts and by the rows are the same
    vals = vals.checkpoint(eager=True)
    ranked = vals.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(col)))
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.withColumn("_off", F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).select(
        "_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count
    return ranked.join(F.broadcast(offs), "_pid").select(
        col, (F.col("_off") + F.col("_rn") - 1).cast("int").alias(out))


def game_vocabulary(user_games: DataFrame) -> DataFrame:
    """Sorted distinct games -> dense index 0..m-1."""
    return dense_index(user_games, "game", "game_idx")


def multi_hot(user_games: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """D7 long form: (new_id, game, game_idx), one row per set bit."""
    vocab = vocab if vocab is not None else game_vocabulary(user_games)
    return user_games.join(vocab, "game")


def game_lists(user_games: DataFrame) -> DataFrame:
    """``(new_id, features)``: the sorted game list of each user."""
    return user_games.groupBy("new_id").agg(F.sort_array(F.collect_list("game")).alias("features"))


def positional(user_features: DataFrame) -> DataFrame:
    """D8 long form: the i-th game id of each user's list as a magnitude,
    padded with 0 up to the longest list."""
    maxlen = user_features.agg(F.max(F.size("features"))).scalar()
    pos = user_features.select("new_id", "features",
                               F.explode(F.sequence(F.lit(0), maxlen - 1)).alias("pos"))
    return pos.select("new_id", F.col("pos").cast("bigint").alias("pos"),
                      F.coalesce(F.try_element_at("features", F.col("pos") + 1),
                                                 F.lit(0)).cast("bigint").alias("value"))


def base_columns(users: DataFrame) -> DataFrame:
    """Scaled base columns: views and days min-max scaled, booleans as 0/1."""
    u = users.select("new_id", F.col("views").cast("double").alias("views"),
                     F.col("days").cast("double").alias("days"),
                     F.col("partner").cast("int").alias("partner"),
                     F.col("mature").cast("int").alias("mature"))
    return minmax(u, ["views", "days"])


def feature_matrix(users: DataFrame, user_games: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """C2 + H3 (multi-hot encoding): one row per user *with features*, base
    columns first (missing user row -> 0), then one slot per game.

    Returns ``new_id, views, days, partner, mature, games ARRAY<INT>`` (the set
    slots) and ``features`` as a sparse ML vector of size 4 + m.
    """
    vocab = vocab if vocab is not None else game_vocabulary(user_games)
    m = vocab.agg(F.count(F.lit(1))).scalar()
    hot = multi_hot(user_games, vocab).groupBy("new_id").agg(
        F.sort_array(F.collect_list("game_idx")).alias("games"))
    # scaler fitted on the users that have features (users JOIN user_features)
    base = base_columns(users.join(hot.select("new_id"), "new_id", "left_semi"))
    fm = hot.join(base, "new_id", "left").select(
        "new_id", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("views", "days", "partner", "mature")],
        "games")
    # sparse row: 4 base slots, then one slot per set game bit
    return (fm.withColumn("slot_idx", F.concat(F.array(*[F.lit(i) for i in range(4)]),
                                               F.transform("games", lambda g: g + 4)))
              .withColumn("slot_val", F.concat(F.array("views", "days", "partner", "mature"),
                                               F.transform("games", lambda _: F.lit(1.0))))
              .withColumn("n_slots", F.lit(m + 4).cast("int")))


def positional_matrix(users: DataFrame, user_features: DataFrame) -> DataFrame:
    """C2 + H3 (positional encoding): base columns first (missing user row -> 0), then the i-th game id
    of the user's list as a magnitude.

    The padding up to the longest list is zeros, so it is never written: a row holds the 4 base
    slots and its own list, a null place or 0 is no entry, an empty or null list leaves the base slots only.
    Columns as ``feature_matrix`` without ``games``."""
    lists = user_features.select("new_id", F.coalesce("features", F.array().cast("array<bigint>")).alias("_l"))
    width = lists.agg(F.coalesce(F.max(F.size("_l")), F.lit(0)) + 4).scalar()
    base = base_columns(users.join(lists.select("new_id"), "new_id", "left_semi"))
    places = F.filter(F.transform("_l", lambda x, i: F.struct((i + 4).alias("at"), x.cast("double").alias("value"))),
                      lambda e: e["value"] != 0)
    names = ("views", "days", "partner", "mature")
    return (lists.join(base, "new_id", "left").withColumn("_p", places)
            .select("new_id", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in names], "_p")
            .select("new_id", *names,
                    F.concat(F.array(*[F.lit(i) for i in range(4)]), F.col("_p.at")).alias("slot_idx"),
                    F.concat(F.array(*names), F.col("_p.value")).alias("slot_val"),
                    width.cast("int").alias("n_slots")))


def l2_normalised(fm: DataFrame) -> DataFrame:
    """Unit-length sparse rows (idx, val) for cosine; zero rows stay zero."""
    norm = F.sqrt(F.aggregate("slot_val", F.lit(0.0), lambda acc, x: acc + x * x))
    return fm.withColumn("_norm", norm).withColumn(
        "slot_val", F.transform("slot_val",
                                lambda x: F.when(F.col("_norm") > 0, x / F.col("_norm")).otherwise(F.lit(0.0)))
    ).drop("_norm")


def as_dense_vector(df: DataFrame, arr: str, out: str = "vec") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr)))
