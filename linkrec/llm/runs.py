"""Periodic runs of words, found as the maximal pairs of a suffix structure.

A run is a stretch of words that repeats with smallest period q, is at least `times` periods and
`least` words long, and cannot be extended on either side with that period.  Two places y < x with
the common continuation of d words, which neither the word before nor the one behind
prolongs, are a maximal pair; words y to x + d then repeat with period x - y and no neighbour
goes on so.  With x - y <= d / (times - 1) that stretch is a run, and every run is such a pair: nothing is
extended afterwards.  Pairs of one stretch with a multiple of its period are dropped.

Maximal pairs come from the tree of LCP intervals over the text's suffix array, walked bottom-up.  A node keeps its places
in order, and by the word on their left; when a child joins its node, every place of the smaller
side looks for places of the other with another left word within d / (times - 1).  Stretches of
places with the same left word are skipped at once by bisecting that word's list, so the work follows the pairs
found, which are few: inside one node near places lie a period apart and only a stretch's first and last one make a pair.

Before that, a document goes through the tree only if it repeats some sequence of `least` * (times - 1) / times
words, as any run does (a hash over all its places, equal for equal sequences; nothing is lost).
Documents are independent, so there is no shuffle; a task holds one document's arrays.

Edge cases: null, empty and wordless texts have no words, no runs and an empty collapsed text; repeated ids stay apart;
other columns of `docs` are left aside.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrec.llm.common import WS, ascii_trim, small_batches

LEAST, TIMES = 24, 3
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters returned at once by a task.
CHUNK_CHARS = 4_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def seed_length(least: int = LEAST, times: int = TIMES) -> int:
    """The shortest common continuation that a run's pair can have: q + d >= least, q <= d / (times - 1)."""
    return -(-least * (times - 1) // times)


def repeats(words: list[str], w: int) -> bool:
    """Whether some sequence of `w` words may occur twice (always true if one does)."""
    if len(words) <= w:
        return False
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(h) - w + 1
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(w):
            grams += (h[k:k + n] ^ (h[k:k + n] >> np.uint64(29))) * np.uint64(2 * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) + 1 & (1 << 64) - 1)
    grams.sort()
    return bool((grams[1:] == grams[:-1]).any())


def suffix_array(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes, rank of each), by prefix doubling."""
    n, k = len(a), 1
    rank = np.unique(a, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:-k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        in_order = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(in_order[1:] != in_order[:-1])))
        if rank[order[-1]] == n - 1:
            return order, rank
        k *= 2
        if k >= n:
            return np.argsort(rank, kind="stable"), rank


def common_prefixes(a: list[int], order: list[int], rank: list[int]) -> list[int]:
    """Words that the suffix at each place of `order` shares with the one before it."""
    n, h, out = len(a), 0, [0] * len(a)
    for i in range(n):
        r = rank[i]
        if not r:
            h = 0
            continue
        j = order[r - 1]
        most = n - max(i, j)
        while h < most and a[i + h] == a[j + h]:
            h += 1
        out[r] = h
        if h:
            h -= 1
    return out


class Node:
    """The places of an LCP interval: all in order, and by the word on their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all, self.by_left = [place], {left: [place]}

    def add(self, place: int, left: int) -> None:
        insort(self.all, place)
        own = self.by_left.get(left)
        if own is None:
            self.by_left[left] = [place]
        else:
            insort(own, place)

    def stretch_end(self, i: int, left: int, step: int) -> int:
        """The last index, from i on in direction `step`, of the places that share the left word of
        the i-th one without another between them."""
        own, places = self.by_left[left], self.all
        e = bisect_left(own, places[i])
        near, far = 0, e if step < 0 else len(own) - 1 - e
        while near < far:                                # the farthest that is as far in both lists
            mid = (near + far + 1) // 2
            if places[i + step * mid] == own[e + step * mid] if 0 <= i + step * mid < len(places) else False:
                near = mid
            else:
                far = mid - 1
        return i + step * near


def runs_of(words: list[str] | np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    seed = seed_length(least, times)
    if isinstance(words, list):
        ids: dict[str, int] = {}
        number = count()
        a = np.fromiter((ids[x] if x in ids else ids.setdefault(x, next(number)) for x in words), np.int64, len(words))
    else:
        a = words
    if len(a) < max(2, least):
        return []
    order_, rank_ = suffix_array(a)
    a, order, rank = a.tolist(), order_.tolist(), rank_.tolist()
    lcp = common_prefixes(a, order, rank)
    left_of = [-1, *a]                                   # left_of[i] is the word before place i
    found: dict[tuple[int, int], int] = {}

    def join(one: Node, two: Node, depth: int) -> Node:
        small, large = (one, two) if len(one.all) < len(two.all) else (two, one)
        reach, places = depth // (times - 1), large.all
        for x in small.all:
            left, k = left_of[x], bisect_left(places, x)
            for i, step in ((k - 1, -1), (k, 1)):
                while 0 <= i < len(places) and abs(x - places[i]) <= reach:
                    y = places[i]
                    if left_of[y] == left:
                        i = large.stretch_end(i, left, step)
                    elif depth + abs(x - y) >= least:
                        stretch = (min(x, y), max(x, y) + depth)
                        found[stretch] = min(found.get(stretch, len(a)), abs(x - y))
                    i += step
        for x in small.all:
            large.add(x, left_of[x])
        return large

    r, n = 1, len(a)
    while r < n:
        if lcp[r] < seed:
            r += 1
            continue
        node, open_ = Node(order[r - 1], left_of[order[r - 1]]), []     # open_: [depth, node] of the intervals begun
        while r < n and lcp[r] >= seed:
            depth = lcp[r]
            while open_ and open_[-1][0] > depth:
                inner, begun = open_.pop()
                node = join(begun, node, inner)
            if open_ and open_[-1][0] == depth:
                open_[-1][1] = join(open_[-1][1], node, depth)
            else:
                open_.append([depth, node])
            node = Node(order[r], left_of[order[r]])
            r += 1
        while open_:
            inner, begun = open_.pop()
            node = join(begun, node, inner)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words, without those that a run holds behind its first period, joined by spaces."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return " ".join([w for w, c in zip(words, np.cumsum(change).tolist()) if not c])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document: its runs as (start, length, period) by start and
    period, and its text with every run cut to its first period."""
    small_batches(docs.sparkSession)
    seed = seed_length(least, times)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, chars = [], 0
            for i, text in zip(pdf["doc_id"], pdf["text"]):
                words = WORD.findall(text or "")
                runs = runs_of(words, least, times) if repeats(words, seed) else []
                rows.append((None if pd.isna(i) else int(i), len(words),
                             [{"start": s, "length": n, "period": q} for s, n, q in runs], collapse(words, runs)))
                chars += len(text or "")
                if chars > CHUNK_CHARS:
                    yield _frame(rows)
                    rows, chars = [], 0
            yield _frame(rows)
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "collapsed"]).astype({"doc_id": "Int64"})


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    t = ascii_trim(F.coalesce(text, F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{WS}]+"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the documents whose crc32(doc_id) is a multiple of 10 repeat from a word on: the
    registered query's input.  With g = floor(crc32 / 10), word i >= a = g mod n becomes word a + (i - a) mod p,
    p = 1 + floor((n - a) / (3 + g mod 8)).  Rows without a doc_id stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = docs.select("doc_id", "text", h.alias("h"))
    # one-element arrays have the words cut once, not once a use
    g = F.floor(F.col("h") / 10).cast("bigint")

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("bigint")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")
    again = F.get(F.transform(F.array(words_of(F.col("text"))), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise("")), F.lit(0))
    return some.select("doc_id", F.when((F.col("h").isNotNull()) & (F.col("h") % 10 == 0), again).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """The registered query's columns: counts, the run of greatest length / period (exactly; ties: smallest
    start, then period), and digests of the runs and of the collapsed text."""
    found = periodic_runs(with_planted_runs(docs))
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
