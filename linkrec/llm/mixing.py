"""Mixing sources to target weights by entropy balancing.

Document rates r solve: least sum of r ln r - r under one token constraint per
source, sum of r * size = target, and 0 <= r <= `cap`.  The convex dual has one
multiplier per source and gives exponentially tilted, clipped rates
r = min(cap, exp(lambda * size / mean size)).  Its gradient and curvature are
sums over the corpus; Newton steps, kept inside a shrinking bracket, run as
Spark aggregations over the lossless (source, size) histogram, for all sources
at once.  A source whose target is `cap` times its size is taken `cap` times whole.

Rates become copies by systematic rounding in order of size, which keeps the
running total within half a document, and what is still missing or too much is
spread over the size classes until it is at most half of the smallest document that can
still be moved.  Inside a class, copies go to documents in
hash order, so reruns agree.

Edge cases: null sources are one source, last in order; null and word-less
texts have size 0 and are taken once or more by the same rates (0 words); empty tables give no
rows; rows of the same doc_id and text get the same number of copies.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkrec.llm.common import hash52, rank_by_hash, row_key, word_count
from linkrec.session import materialize

WEIGHTS, BUDGET, CAP = (3.0, 1.0, 2.0), 1.5, 2


def targets(classes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(sid, source_size, target) from (sid, size, n): the weights, repeated over the sources,
    share `budget` of all sizes; no target is above `cap` times its source's size.

    Sources are capped in the order of size / weight; the level is what is left
    for the others per unit of weight.  One row per source is ranked."""
    per = classes.groupBy("sid").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights)).cast("int"))
    per = per.withColumn("w", weight).withColumn("most", cap * F.col("source_size").cast("double"))
    order = W.orderBy(F.col("most") / F.col("w"), "sid")
    all_ = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    per = (per.withColumn("total", budget * F.sum("source_size").over(all_))
           .withColumn("left_w", F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("left_w"))
           .withColumn("open", F.col("most") > F.col("level") * F.col("w")))
    level = F.first(F.when(F.col("open"), F.col("level")), True).over(all_)
    return per.select("sid", "source_size", F.least("most", F.coalesce(level * F.col("w"), F.col("most"))).alias("target"))


def solve(classes: DataFrame, goal: DataFrame, cap: int = CAP, tolerance: float = 1e-7, rounds: int = 200) -> DataFrame:
    """(sid, source_size, target, scale, lam, full): the dual's multipliers.  Each round is one
    aggregation of gradient and curvature and a written table with a row per source; the Newton step
    is taken on the logarithm of the tokens, which is nearly straight in the multiplier."""
    size, n = F.col("size").cast("double"), F.col("n").cast("double")
    base = (classes.where("size > 0").groupBy("sid").agg(F.sum("n").alias("docs"), F.min("size").alias("least"))
            .join(goal.where("source_size > 0"), "sid")
            .withColumn("scale", F.col("source_size") / F.col("docs"))
            .withColumn("full", F.col("target") >= cap * F.col("source_size") * (1 - 1e-12))
            .withColumn("lam", F.log(F.col("target") / F.col("source_size")))
            .withColumn("hi", F.log(F.lit(float(cap))) * F.col("scale") / F.col("least") + 1)
            .withColumn("lo", -(F.abs("lam") + 1) * F.col("scale") / F.col("least"))
            .withColumn("off", F.lit(1.0)).drop("docs", "least"))
    state = materialize(base, "dual")
    for _ in range(rounds):
        rate = F.least(F.lit(float(cap)), F.exp(F.col("lam") * size / F.col("scale")))
        sums = (classes.where("size > 0").join(state.where("not full"), "sid")
                .groupBy("sid").agg(F.sum(n * size * rate).alias("g"),
                                    F.sum(F.when(rate < cap, n * size * size * rate / F.col("scale"))
                                          .otherwise(0.0)).alias("slope")))
        high = F.col("g") > F.col("target")
        new = (state.join(sums, "sid", "left")
               .withColumn("hi", F.when(high, F.col("lam")).otherwise(F.col("hi")))
               .withColumn("lo", F.when(high, F.col("lo")).otherwise(F.coalesce(F.when(F.col("g").isNotNull(), F.col("lam")), "lo")))
               .withColumn("off", F.coalesce(F.abs(F.col("g") - F.col("target")) / F.col("target"), F.lit(0.0)))
               .withColumn("step", F.col("lam") + F.when(F.col("slope") > 0, F.log(F.col("target") / F.col("g")) * F.col("g") / F.col("slope")))
               .withColumn("lam", F.when(F.col("g").isNull() | (F.col("off") <= tolerance), F.col("lam"))
                           .when((F.col("step") > F.col("lo")) & (F.col("step") < F.col("hi")), F.col("step"))
                           .otherwise((F.col("lo") + F.col("hi")) / 2))
               .drop("g", "slope", "step"))
        state = materialize(new, "dual")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return state.drop("lo", "hi", "off")


def _close_gap(sizes: list[int], copies: list[int], most: list[int], gap: float) -> list[int]:
    """Copies moved so that the gap (target less what is taken) is at most half of the smallest document that
    can still be moved its way.  The classes come in falling order of their sizes, all above 0.  The gap is
    first spread evenly over the room of the classes that fit into it; of the rest, every class takes
    whole copies, the longest first; last, single copies are moved as long as that leaves less."""
    copies, n = list(copies), len(sizes)

    def room(i: int) -> int:
        return most[i] - copies[i] if gap > 0 else copies[i]

    def move(i: int, m: int) -> None:
        nonlocal gap
        m = m if gap > 0 else -m
        copies[i] += m
        gap -= m * sizes[i]

    fitting = [i for i in range(n) if sizes[i] <= abs(gap)]
    left, owed = sum(room(i) * sizes[i] for i in fitting), 0.0
    for i in fitting:
        free = room(i)
        if free and gap:
            owed += min(1.0, abs(gap) / left) * free
            m = max(0, min(int(owed + 0.5), free, int(abs(gap) // sizes[i])))
            owed -= m
            left -= free * sizes[i]
            move(i, m)
    while gap:
        for i in range(n):
            m = min(int(abs(gap) // sizes[i]), room(i))
            if m:
                move(i, m)
        able = [i for i in range(n) if room(i) > 0]
        best = min(able, key=lambda i: abs(abs(gap) - sizes[i]), default=None)
        if best is None or abs(abs(gap) - sizes[best]) >= abs(gap):
            break
        move(best, 1)
    return copies


def class_copies(classes: DataFrame, dual: DataFrame, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """(sid, size, n, copies): how many copies each class of equal documents gets in all."""
    rate = (F.when(F.col("full"), F.lit(float(cap)))
            .otherwise(F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("scale")))))
    rated = classes.join(dual.select("sid", "scale", "lam", "full"), "sid", "left").withColumn(
        "rate", F.coalesce(rate, F.lit(1.0)))
    upto = W.partitionBy("sid").orderBy("size").rowsBetween(W.unboundedPreceding, 0)
    run = F.floor(F.sum(F.col("rate") * F.col("n")).over(upto) + 0.5)
    step = W.partitionBy("sid").orderBy("size")
    rounded = (rated.withColumn("_u", run).withColumn("copies", F.col("_u") - F.coalesce(F.lag("_u").over(step), F.lit(0)))
               .withColumn("copies", F.greatest(F.lit(0), F.least("copies", cap * F.col("n"))).cast("bigint"))
               .join(goal.select("sid", "target"), "sid").select("sid", "size", "n", "copies", "target"))

    def repair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False, ignore_index=True)
        k = int((pdf["size"] > 0).sum())
        size, own = pdf["size"].tolist(), pdf["copies"].tolist()
        gap = float(pdf["target"].iloc[0]) - sum(a * b for a, b in zip(size, own))
        pdf["copies"] = _close_gap(size[:k], own[:k], [cap * n for n in pdf["n"].tolist()[:k]], gap) + own[k:]
        return pdf[["sid", "size", "n", "copies"]]

    # one row for each distinct size of a source
    return materialize(rounded.groupBy("sid").applyInPandas(repair, "sid long, size long, n long, copies long"), "copies")


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(doc_id, row, size, source_size, target, copies) of every row of `docs`; `row` is its `row_key()`."""
    rows = docs.select("doc_id", row_key().alias("row"), "source", word_count(F.col("text")).alias("size"))
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    sources = materialize(sources.select(F.col("source").alias("_s"), (F.row_number().over(
        W.orderBy(F.col("source").asc_nulls_last())) - 1).cast("bigint").alias("sid")), "sources")
    rows = materialize(rows.join(sources, F.col("source").eqNullSafe(F.col("_s")))
                       .select("doc_id", "row", "sid", "size"), "sizes")
    classes = materialize(rows.groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")), "classes")
    goal = materialize(targets(classes, weights, budget, cap), "targets")
    copies = class_copies(classes, solve(classes, goal, cap), goal, cap)
    ranked = rank_by_hash(rows.withColumn("_h", hash52("doc_id", "row")), ["sid", "size"], "_h", ["doc_id", "row"], "_k", equal=True)
    own: Column = F.floor(F.col("copies") / F.col("n")) + F.when(
        F.col("_k") < F.col("copies") % F.col("n"), F.lit(1)).otherwise(F.lit(0))
    return (ranked.join(copies, ["sid", "size"]).join(goal, "sid")
            .select("doc_id", "row", "size", "source_size", "target", own.cast("bigint").alias("copies")))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of `docs` as often as it has copies, with the columns of `docs`."""
    counts = (mix(docs).where("copies > 0").select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"),
                                                  F.col("copies").alias("_copies")).distinct())
    return (docs.withColumn("_row", row_key())
            .join(counts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")))
            .select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_k"))
            .drop("_k"))
