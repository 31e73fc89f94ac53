"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts are canonicalised token by token: numbers, names (capitalised words inside
a sentence) and units become typed placeholders.  Every window of `w` template
tokens is hashed and hash-joined to the benchmark's windows; a document holds an
item if it has `coverage` of the item's distinct windows.  For items with
placeholders the documents' values must then fit, in one stretch of the document that
has the coverage: a value of the item is replaced by the same value throughout,
in `coverage` of its matched places.  Any one stretch that fits is enough, so
siblings of the same template beside a copy do not hide it.  Texts are read in three
modes, any of which is enough: with the names inside sentences as placeholders, with
the same names at sentence starts too, and literally in lower case, where values need not be typed.
So verbatim copies and re-parameterised ones are caught, chance templates are not.
Most documents cannot hold any item and are passed over after one look at their words: of each item some words, the
rarest among the documents, are taken such that no `coverage` of its windows is without all of them (`anchors`).

Edge cases: null and empty texts hold and match nothing; texts shorter than a
window are one padded window, and such items are also looked for literally inside longer texts; a row is known by doc_id and text, so repeated
doc_ids and null ones stay apart; an empty benchmark gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrec.llm.common import row_key
from linkrec.session import materialize

#: Units that a question may be restated in.
UNITS = ["mm", "cm", "km", "mg", "kg", "ml", "meter", "meters", "metre", "metres", "mile", "miles", "inch", "inches",
         "foot", "feet", "gram", "grams", "pound", "pounds", "litre", "litres", "liter", "liters", "second", "seconds",
         "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
         "percent", "dollar", "dollars", "euro", "euros", "cent", "cents"]
#: Marks, private characters: a name; another capitalised word that is a name elsewhere in the text.
NAME = ""
START = "\ue001"
WINDOW, COVERAGE = 5, 0.8
#: Most benchmark windows that are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Most words that are sent along with the plan; with more, all documents are read in full.
PLAN_WORDS = 20_000


def _marked(text: Column) -> Column:
    """Lower-case words, 1,000 and 2.5 as one number; names carry a mark in front, and other capitalised
    words that are a name elsewhere in the text another one."""
    t = F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", "")
    t = F.regexp_replace(t, r"(?<=[\p{Ll},;] )(\p{Lu}\p{Ll}+)", NAME + "$1")
    t = F.regexp_replace(t, rf"(?<![\p{{L}}\p{{N}}{NAME}])(\p{{Lu}}\p{{Ll}}+)", START + "$1")
    words = F.filter(F.split(F.lower(t), rf"[^\p{{L}}\p{{N}}{NAME}{START}]+"), lambda x: x != "")
    both = F.transform(F.array(words), lambda ws: F.struct(
        ws.alias("ws"), F.array_distinct(F.filter(ws, lambda x: x.startswith(NAME))).alias("names")))
    return F.get(F.transform(both, lambda b: F.transform(b["ws"], lambda x: F.when(
        x.startswith(START) & ~F.array_contains(b["names"], F.concat(F.lit(NAME), F.substr(x, F.lit(2)))),
        F.substr(x, F.lit(2))).otherwise(x))), F.lit(0))


def _form(token: Column, mode: str) -> Column:
    """A marked token as read in a mode: "t" names inside sentences, "s" names at their starts too, "l" literally."""
    if mode == "s":
        return F.translate(token, START, NAME)
    return F.translate(token, START if mode == "t" else NAME + START, "")


def tokens(text: Column, mode: str = "t") -> Column:
    """The words of a text in a mode; names carry a mark in front."""
    return F.transform(_marked(text), lambda x: _form(x, mode))


def kind(token: Column) -> Column:
    """The token's placeholder, or null."""
    return (F.when(token.between("0", "9￿"), F.lit("#number")).when(token.startswith(NAME), F.lit("#name"))
            .when(token.isin(UNITS), F.lit("#unit")))


def windows(df: DataFrame, keys: list[str], w: int, modes: str = "t") -> DataFrame:
    """(keys, pos, window): the 64-bit hash of every window of template tokens, in each of the modes.
    The token hashes are zipped with themselves shifted, so that the windows are
    hashed in generated code, not element by element."""
    def hashes(mode: str) -> Column:
        def one(x: Column) -> Column:
            t = _form(x, mode)
            return F.xxhash64(t if mode == "l" else F.coalesce(kind(t), t))
        return F.transform("m", one)
    pad = F.array_repeat(F.lit(0).cast("bigint"), w - F.size("m"))
    hashed = (df.where(F.length("text") > 0).select(*keys, _marked(F.col("text")).alias("m")).where(F.size("m") > 0)
              .select(*keys, *[F.concat(hashes(mode), pad).alias(mode) for mode in modes]))
    n = F.size(modes[0]) - (w - 1)
    cols = {mode: [f"{mode}{i}" for i in range(w)] for mode in modes}
    zipped = F.arrays_zip(*[F.slice(mode, F.lit(i + 1), n).alias(c) for mode in modes for i, c in enumerate(cols[mode])])
    at = hashed.select(*keys, F.posexplode(zipped).alias("pos", "z"))
    found = [F.xxhash64(*[F.col("z")[c] for c in cols[mode]]) for mode in modes]
    if len(modes) == 1:
        return at.select(*keys, "pos", found[0].alias("window"))
    return at.select(*keys, "pos", F.explode(F.array_distinct(F.array(*found))).alias("window"))


def _words(text: Column) -> Column:
    """The literal words of a text that holds no digits in them, as `_marked` cuts them."""
    return F.split(F.lower(F.translate(text, NAME + START, "")), r"[^\p{L}\p{N}]+")


def anchors(docs: DataFrame, items: DataFrame, w: int, coverage: float) -> list[str] | None:
    """Words of which every document that holds an item, and is not shorter than a window, has at least one; None where
    an item has no such words, or too many would be needed.  Only words that no mode reads as a placeholder count.
    A window ranks by its word that is rarest among the documents; an item's words up to the rank at which fewer
    than `coverage` of its distinct windows are left, in any mode, are taken."""
    def literal(x: Column) -> Column:
        return kind(_form(x, "s")).isNull() & ~x.startswith(START) & ~x.rlike(r"\p{N}")
    keyed = items.where(F.length("text") > 0).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("\x00")).alias("item"), row_key().alias("uid"), "text")
    toks = keyed.withColumn("m", _marked(F.col("text"))).where(F.size("m") > 0)
    at = materialize(toks.select("item", "uid", F.size("m").alias("n"), F.posexplode(
        F.transform("m", lambda x: F.when(literal(x), x))).alias("pos", "word")).distinct(), "item_words")
    words = at.select("word").where("word is not null").distinct()
    if words.count() > PLAN_WORDS:
        return None
    seen = (docs.where(F.length("text") > 0).select(F.explode(_words(F.col("text"))).alias("word"))
            .join(F.broadcast(words), "word").groupBy("word").agg(F.count(F.lit(1)).alias("c")))
    rank = materialize(words.join(seen, "word", "left").select(
        "word", F.struct(F.coalesce("c", F.lit(0).cast("bigint")).alias("c"), "word").alias("rank")), "word_ranks")
    # the windows that a word lies in start up to w - 1 places before it
    starts = F.sequence(F.greatest(F.lit(0), F.col("pos") - (w - 1)), F.least(F.col("pos"), F.greatest(F.lit(0), F.col("n") - w)))
    best = (at.join(rank, "word", "left").withColumn("pos", F.explode(starts))
            .groupBy("item", "uid", "pos").agg(F.min("rank").alias("rank")))
    limits = []
    for mode in "tls":
        ranked = (windows(keyed, ["item", "uid"], w, mode).join(best, ["item", "uid", "pos"], "left")
                  .groupBy("item", "window").agg(F.min("rank").alias("rank"))
                  .groupBy("item").agg(F.sort_array(F.collect_list("rank")).alias("ranks"), F.count(F.lit(1)).alias("n")))
        left = F.col("n") - F.ceil(F.lit(coverage) * F.col("n") - 1e-9)
        limits.append(ranked.select("item", F.get("ranks", left.cast("int")).alias("limit")))
    limit = materialize(limits[0].unionByName(limits[1]).unionByName(limits[2]), "limits")
    if limit.where("limit is null").count():
        return None
    top = limit.groupBy("item").agg(F.max("limit").alias("limit"))
    chosen = at.join(rank, "word").join(top, "item").where("rank <= limit").select("word").distinct()
    return sorted(r["word"] for r in chosen.collect())


def _candidates(docs: DataFrame, items: DataFrame, w: int, coverage: float) -> DataFrame:
    """The documents that may hold an item."""
    some = anchors(docs, items, w, coverage)
    if some is None:
        return docs
    words = _words(F.col("text"))
    # up to two of the parts are empty ones at the text's ends
    return docs.where(F.length("text") > 0).where(F.get(F.transform(F.array(words), lambda ws: (
        F.size(ws) < w + 2) | F.arrays_overlap(ws, F.lit(some).cast("array<string>"))), F.lit(0)))


def contaminated(docs: DataFrame, benchmark: DataFrame, w: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, row, item_id, n_windows, n_matched, coverage, n_slots, consistency), one row for
    each document row (`row` is `row_key()` of its text) and item it holds, in the mode that fits best."""
    items = benchmark.select("item_id", "text")
    read = _marked(F.col("text"))
    typed = items.where(F.exists(read, lambda x: kind(_form(x, "s")).isNotNull()))     # the others read the same in all modes
    started = items.where(F.exists(read, lambda x: x.startswith(START)))
    bench = materialize(windows(items, ["item_id"], w).withColumn("mode", F.lit("t"))
                        .unionByName(windows(typed, ["item_id"], w, "l").withColumn("mode", F.lit("l")))
                        .unionByName(windows(started, ["item_id"], w, "s").withColumn("mode", F.lit("s"))), "benchmark_windows")
    distinct = bench.select("item_id", "mode", "window").distinct()
    total = distinct.groupBy("item_id", "mode").agg(F.count(F.lit(1)).alias("n_windows"))
    rows = _candidates(docs.select("doc_id", row_key().alias("row"), "text"), items, w, coverage)
    modes = "".join(m for m in "tls" if m in {r["mode"] for r in bench.select("mode").distinct().collect()})

    def matches(of: DataFrame, side: DataFrame) -> DataFrame:
        side = F.broadcast(side) if side.count() <= BROADCAST_WINDOWS else side
        return (of.join(side, "window").groupBy("doc_id", "row", "item_id", "mode")
                .agg(F.count_distinct("window").alias("n_matched")))
    found = matches(windows(rows, ["doc_id", "row"], w, modes or "t"), distinct).join(total, ["item_id", "mode"])
    # items shorter than a window, literally, anywhere in a text
    short = items.withColumn("n", F.size(_marked(F.col("text")))).where(F.col("n").between(1, w - 1))
    for k in sorted(r["n"] for r in short.select("n").distinct().collect()):
        own = windows(short.where(F.col("n") == k).select("item_id", "text"), ["item_id"], k, "l").select(
            "item_id", F.lit("l").alias("mode"), "window").distinct()
        found = found.unionByName(matches(windows(rows, ["doc_id", "row"], k, "l"), own)
                                  .withColumn("n_windows", F.lit(1).cast("bigint")))
    held = found.withColumn("coverage", F.col("n_matched") / F.col("n_windows")).where(F.col("coverage") >= coverage - 1e-9)
    held = materialize(held.select("doc_id", "row", "item_id", "n_windows", "n_matched", "coverage", "mode"), "held")
    slotted = typed.select("item_id")
    fit = held.where("mode = 'l'").unionAll(held.where("mode = 't'").join(slotted, "item_id", "left_anti").select(*held.columns))
    fit = fit.drop("mode").withColumns({"n_slots": F.lit(0).cast("bigint"), "consistency": F.lit(1.0)})
    for mode in "ts":
        open_ = held.where(F.col("mode") == mode).join(slotted, "item_id", "left_semi")
        if not open_.isEmpty():
            fit = fit.unionByName(_best_stretch(open_, rows, items, w, coverage, mode))
    best = fit.groupBy("doc_id", "row", "item_id").agg(
        F.max(F.struct("coverage", "consistency", "n_slots", "n_matched", "n_windows")).alias("b"))
    return best.select("doc_id", "row", "item_id", "b.n_windows", "b.n_matched", "b.coverage", "b.n_slots", "b.consistency")


def _slots(df: DataFrame, keys: list[str], w: int, mode: str) -> DataFrame:
    """(keys, pos, window, slots): every window with the (place, value) of its placeholders."""
    toks = df.where(F.length("text") > 0).select(*keys, tokens(F.col("text"), mode).alias("t")).where(F.size("t") > 0)
    at = (windows(df, keys, w, mode).join(
        toks.select(*[F.col(k).alias(f"_{k}") for k in keys], "t"),
        [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*[f"_{k}" for k in keys]))
    return at.select(*keys, "pos", "window", F.filter(F.transform(
        F.slice("t", F.col("pos") + 1, F.lit(w)), lambda v, i: F.struct(i.alias("place"), v.alias("value"))),
        lambda x: kind(x["value"]).isNotNull()).alias("slots"))


def _stretches(start: Column, length: Column) -> Column:
    """The stretches (level, k) of an occurrence's start: that start alone, the ranges of 2, 4, ... starts up
    to the item's length or more, each range twice (half a range apart, so that a drift of half a
    range stays inside one), and the whole document."""
    ranges = F.flatten(F.transform(F.sequence(F.lit(0), F.ceil(F.log2(length + 1)).cast("int")), lambda level: F.transform(
        F.array(F.lit(0), F.lit(1)), lambda back: F.struct(
            level.alias("level"), (F.floor(start / F.pow(F.lit(2.0), level)) - back).cast("bigint").alias("k")))))
    one = [F.struct(F.lit(n).alias("level"), k.cast("bigint").alias("k")) for n, k in ((-1, start), (-2, F.lit(0)))]
    return F.concat(F.array(*one), ranges)


def _best_stretch(open_: DataFrame, rows: DataFrame, items: DataFrame, w: int, coverage: float,
                  mode: str) -> DataFrame:
    """`open_` with n_slots and consistency, and n_matched and coverage, of the best stretch that reaches
    `coverage` in both; rows without one are dropped.  A stretch takes the window matches whose starts (place
    in the document less place in the item) lie together, so a copy is judged without its siblings.
    Consistency: of the matched placeholders, the share whose value is the one that the item's value
    has most often in the stretch."""
    pair, cond = ["doc_id", "row", "item_id"], lambda: F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r"))
    wanted = open_.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), F.col("item_id").alias("_i"),
                          "n_windows")
    of_docs = rows.join(wanted.select("_d", "_r").distinct(), cond(), "left_semi").distinct()
    mine = _slots(of_docs, ["doc_id", "row"], w, mode).withColumnRenamed("slots", "doc_slots")
    theirs = _slots(items.join(wanted, F.col("item_id") == F.col("_i"), "left_semi"), ["item_id"], w, mode).select(
        "item_id", "window", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    at = mine.join(theirs, "window").join(wanted, cond() & (F.col("item_id") == F.col("_i"))).select(
        *pair, "n_windows", "window", (F.col("pos") - F.col("item_pos")).cast("bigint").alias("start"), "item_slots", "doc_slots")
    # equal windows have their placeholders at the same places
    at = at.select(*pair, "n_windows", "window", F.explode(_stretches(F.col("start"), F.col("n_windows") + w)).alias("s"),
                   F.arrays_zip(F.col("item_slots.value").alias("item_value"), F.col("doc_slots.value").alias("doc_value")).alias("v"))
    at = materialize(at, "aligned")
    keys = [*pair, "s", "n_windows"]
    found = (at.groupBy(*keys).agg(F.count_distinct("window").alias("n_matched"))
             .withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
             .where(F.col("coverage") >= coverage - 1e-9))
    fit = (at.select(*pair, "s", F.explode("v").alias("v")).groupBy(*pair, "s", "v").agg(F.count(F.lit(1)).alias("c"))
           .groupBy(*pair, "s", F.col("v.item_value").alias("item_value")).agg(F.max("c").alias("top"), F.sum("c").alias("all"))
           .groupBy(*pair, "s").agg(F.count(F.lit(1)).alias("n_slots"), (F.sum("top") / F.sum("all")).alias("consistency")))
    fit = fit.withColumnsRenamed({"doc_id": "_d", "row": "_r", "item_id": "_i", "s": "_s"})
    fitting = (found.join(fit, cond() & (F.col("item_id") == F.col("_i")) & (F.col("s") == F.col("_s")), "left")
               .withColumns({"n_slots": F.coalesce("n_slots", F.lit(0).cast("bigint")),
                             "consistency": F.coalesce("consistency", F.lit(1.0))})
               .where(F.col("consistency") >= coverage - 1e-9))
    best = fitting.groupBy(*pair).agg(F.max(F.struct("coverage", "consistency", "n_slots", "n_matched", "n_windows")).alias("b"))
    return best.select(*pair, "b.n_windows", "b.n_matched", "b.coverage", "b.n_slots", "b.consistency")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, unchanged."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("_d"), F.col("row").alias("_r")).distinct()
    return docs.withColumn("_row", row_key()).join(
        bad.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")),
        "left_anti").drop("_row")
