"""Sampling and splitting (I1-I7) by hash order instead of a seeded RNG.

The order key of every sampler is ``hash_order(...)``: the first 32 bits of an
md5, uniform on [0, 2**32), identical in any partitioning and in DuckDB.
Uniformity is what makes the per-group rank skew-safe (``rank_in_group``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkrec.functions.exprs import hash_order, hash_unit
from linkrec.operators.features import dense_index
from linkrec.session import materialize

SEED = 42
HOT_GROUP = 1 << 16
_H = 1 << 32


def rank_in_group(df: DataFrame, key: str, h: str, tie: str, hot: int = HOT_GROUP) -> DataFrame:
    """Adds ``_rn`` (1-based rank by (h, tie) inside ``key``) and ``_n`` (group size).

    A plain window would sort a hub's whole group in one task.  Here a group
    of n rows is cut into b = 2**ceil(log2(n / hot)) ranges of the uniform
    hash ``h``; rows are ranked inside (key, range) and shifted by the number
    of rows in the lower ranges of the same key (a window over at most b rows
    per key).
    """
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    buckets = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / F.lit(hot))))).cast("long")
    x = df.join(n, key).withColumn("_b", (F.col(h) * buckets / F.lit(_H)).cast("long"))
    ranked = x.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_b").orderBy(h, tie)))
    counts = x.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_c").over(
        Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (ranked.join(offs.select(key, "_b", "_off"), [key, "_b"])
            .withColumn("_rn", F.col("_off") + F.col("_r")).drop("_b", "_r", "_off"))


def edge_split(edges: DataFrame, seed: int = SEED, hot: int = HOT_GROUP) -> DataFrame:
    """Per source, sources with < 2 edges are all train; otherwise the
    first ceil(n / 5) edges in hash order are test.  Adds ``is_test``."""
    e = edges.select("src", "dst").withColumn("_h", hash_order(F.col("src"), F.col("dst"), seed))
    r = rank_in_group(e, "src", "_h", "dst", hot)
    test = (F.col("_n") >= 2) & (F.col("_rn") <= F.floor((F.col("_n") + 4) / 5))
    return r.select("src", "dst", test.alias("is_test"))


def positive_samples(known: DataFrame, n: int = 5000, seed: int = SEED) -> DataFrame:
    """min(n, m) edges with known endpoints, without replacement
    (duplicate edges are separate rows).  Global top-n by hash."""
    h = hash_order(F.col("src"), F.col("dst"), seed)
    return known.select("src", "dst").orderBy(h, "src", "dst").limit(n)


def negative_samples(spark: SparkSession, users: DataFrame, edges: DataFrame, n: int = 5000,
                     seed: int = SEED, tries_per_sample: int = 20, undirected: bool = False) -> DataFrame:
    """Draw (u, v) uniformly from the users, keep u != v and (u, v) not a
    directed edge, in draw order, until n.  Reversed edges and repeats are
    allowed unless ``undirected``.

    Draw i picks positions md5(i|u|seed) mod N and md5(i|v|seed) mod N in
    the dense user index (D9); the draws are a distributed ``range`` of
    ``tries_per_sample * n``, or of four times the draws that the number of free pairs
    lets expect, where the graph is so dense that this is more.  A graph without a free pair has
    no negatives.
    """
    idx = dense_index(users.select("new_id"), "new_id", "pos")
    total = idx.agg(F.count(F.lit(1))).first()[0]
    e = edges.select("src", "dst")
    if undirected:
        e = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = e.where(F.col("src") != F.col("dst")).distinct()
    taken = (e.join(users.select(F.col("new_id").alias("src")).distinct(), "src", "left_semi")
             .join(users.select(F.col("new_id").alias("dst")).distinct(), "dst", "left_semi").count())
    free = total * (total - 1) - taken
    tries = max(tries_per_sample * n, 4 * -(-n * total * total // free) + 64) if free > 0 else 0
    draws = spark.range(tries).select(
        F.col("id").alias("draw"),
        F.pmod(hash_order(F.col("id"), "u", seed), F.lit(max(total, 1))).alias("pu"),
        F.pmod(hash_order(F.col("id"), "v", seed), F.lit(max(total, 1))).alias("pv"))
    pairs = (draws.join(idx.select(F.col("pos").alias("pu"), F.col("new_id").alias("src")), "pu")
             .join(idx.select(F.col("pos").alias("pv"), F.col("new_id").alias("dst")), "pv")
             .where(F.col("src") != F.col("dst")))
    pairs = pairs.join(e, ["src", "dst"], "left_anti")
    return pairs.orderBy("draw").limit(n).select("draw", "src", "dst")


def stratified_split(df: DataFrame, label: str, id_cols: list[str], test_frac: float = 0.2,
                     seed: int = SEED) -> DataFrame:
    """I4: per class, the first ceil(frac * n_class) rows in hash order are
    test (class ratio preserved).  Adds ``is_test``."""
    parts = [F.col(c) for c in id_cols]
    x = df.withColumn("_h", hash_order(*parts, seed)).withColumn("_tie", F.concat_ws("|", *parts))
    r = rank_in_group(x, label, "_h", "_tie")
    return r.withColumn("is_test", F.col("_rn") <= F.ceil(F.col("_n") * F.lit(test_frac))) \
            .drop("_h", "_tie", "_rn", "_n")


def sample_users(users: DataFrame, col: str, n: int | None = None, seed: int = SEED) -> DataFrame:
    """N users without replacement (all if fewer, or without n), by hash order."""
    every = users.select(col).distinct()
    return every if n is None else every.orderBy(hash_order(F.col(col), seed), col).limit(n)


def next_prime(n: int) -> int:
    """The smallest prime >= max(n, 2)."""
    p = max(n, 2)
    while any(p % d == 0 for d in range(2, math.isqrt(p) + 1)):
        p += 1
    return p


def candidates(users: DataFrame, pool: int = 200, seed: int = SEED) -> DataFrame:
    """Per user, exactly min(pool, N) distinct users (may include the
    user itself; the caller filters).  With the prime p >= N, draw j of user u is
    position (start + j * step) mod p, start and step hashed from u: a keyed
    permutation of 0..p-1, so no position repeats and pool + p - N draws hold
    ``pool`` positions below N."""
    idx = dense_index(users.select("new_id"), "new_id", "pos")
    total = idx.count()
    prime = next_prime(total)
    draws = min(prime, pool + prime - total)
    u = users.select(F.col("new_id").alias("user_id")).distinct()
    d = (u.withColumn("_start", F.pmod(hash_order(F.col("user_id"), "start", seed), F.lit(prime)))
         .withColumn("_step", F.pmod(hash_order(F.col("user_id"), "step", seed), F.lit(prime - 1)) + 1)
         .withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(draws - 1).cast("bigint")))))
    d = d.select("user_id", "j", F.pmod(F.col("_start") + F.col("j") * F.col("_step"), F.lit(prime)).alias("pos"))
    ranked = d.where(F.col("pos") < total).withColumn(
        "_r", F.row_number().over(Window.partitionBy("user_id").orderBy("j")))
    picked = ranked.where(F.col("_r") <= pool)
    # The draws are pool times the users: Spark, which does not count what explode adds, would broadcast them.
    return picked.join(idx.hint("shuffle_hash"), "pos").select("user_id", F.col("new_id").alias("candidate"), "j")


def bernoulli_indices(spark: SparkSession, total: int, p: float, seed: int = SEED, *,
                      first_block: int = 0, blocks: int | None = None, block_draws: int = 1024) -> DataFrame:
    """Every index of 0..total-1 independently with probability ``p``, as
    (``block``, ``idx``), at the cost of the rows drawn.

    The indices are cut into blocks of ``block_length(p, block_draws)``.  Inside a
    block, the distance to the next drawn index is geometric,
    1 + floor(ln(u) / ln(1 - p)), and the running sum of the distances gives the
    places; the law has no memory, so blocks start afresh and are independent
    tasks.  A block's draws come in rounds of about twelve standard deviations
    above their mean; a block whose places have not passed its end (next to
    never) goes on with another round, so no index is left out.
    """
    if not 0 < p < 1:
        raise ValueError("p must be in (0, 1)")
    length = block_length(p, block_draws)
    every = -(-total // length)
    last = every if blocks is None else min(every, first_block + blocks)
    mean = length * p
    draws = math.ceil(mean + 12 * math.sqrt(mean) + 32)
    open_blocks = spark.range(first_block, max(last, first_block)).select(
        F.col("id").alias("block"), F.lit(-1).cast("bigint").alias("at"))
    out, start = None, 0
    while True:
        gaps = open_blocks.withColumn("k", F.explode(F.sequence(F.lit(start), F.lit(start + draws - 1))))
        gap = 1 + F.floor(F.log(hash_unit(F.col("block"), F.col("k"), seed)) / F.lit(math.log1p(-p)))
        so_far = Window.partitionBy("block").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        places = gaps.select("block", "k", (F.col("at") + F.sum(gap).over(so_far)).alias("at"))
        places = materialize(places, "bernoulli")
        idx = F.col("block") * F.lit(length) + F.col("at")
        drawn = places.where((F.col("at") < length) & (idx < total)).select("block", idx.alias("idx"))
        out = drawn if out is None else out.unionByName(drawn)
        open_blocks = places.groupBy("block").agg(F.max("at").alias("at")).where(F.col("at") < length)
        if open_blocks.isEmpty():
            return out
        start += draws


def block_length(p: float, block_draws: int = 1024) -> int:
    """Indices in one block of ``bernoulli_indices``, of ``block_draws`` expected draws."""
    return math.ceil(block_draws / p)


def bernoulli_pairs(spark: SparkSession, users: DataFrame, p: float = 0.001, n: int | None = None,
                    seed: int = SEED) -> DataFrame:
    """Each ordered pair of users with probability ``p``, the pairs of a user
    with itself dropped; with ``n``, the first n in row order.  Columns
    ``pair_idx`` (row * N + column in the dense user index), ``src``, ``dst``.
    Followed pairs may be among them, as in the reference.

    Nothing scans the N * N pairs: p N**2 rows are drawn.  With ``n``, only the
    leading blocks are drawn, as many as it takes (each time twice as many).
    Users without an id are dropped, repeated ones count once.
    """
    # written once: a reread must number the users alike
    idx = materialize(dense_index(users.where(F.col("new_id").isNotNull()).select("new_id"), "new_id", "pos"),
                      "users")
    total = idx.count()
    size = total * total
    u = F.expr("idx div %d" % max(total, 1))
    v = F.col("idx") % F.lit(max(total, 1))

    def pairs(indices: DataFrame) -> DataFrame:
        return indices.select(F.col("idx").alias("pair_idx"), u.alias("pu"), v.alias("pv")).where("pu <> pv")

    if n is None:
        drawn = pairs(bernoulli_indices(spark, size, p, seed))
    else:
        every = -(-size // block_length(p))
        done, blocks, drawn, got = 0, max(1, math.ceil(n / 1024)), None, 0
        while drawn is None or (got < n and done < every):
            more = pairs(bernoulli_indices(spark, size, p, seed, first_block=done, blocks=blocks))
            drawn = more if drawn is None else drawn.unionByName(more)
            got, done, blocks = got + more.count(), done + blocks, 2 * blocks
        drawn = drawn.orderBy("pair_idx").limit(n)
    return (drawn.join(idx.select(F.col("pos").cast("bigint").alias("pu"), F.col("new_id").alias("src")), "pu")
            .join(idx.select(F.col("pos").cast("bigint").alias("pv"), F.col("new_id").alias("dst")), "pv")
            .select("pair_idx", "src", "dst"))


def exclude_followed(cands: DataFrame, follows: DataFrame, user: str = "user_id",
                     other: str = "candidate") -> DataFrame:
    """Drop self and the candidates the user already follows (anti join)."""
    f = follows.select(F.col("src").alias(user), F.col("dst").alias(other)).distinct()
    return cands.where(F.col(user) != F.col(other)).join(f, [user, other], "left_anti")


def label_order(*cols) -> Column:
    return hash_order(*cols)
