"""Toxicity scores from a lexicon trie crossed with Levenshtein automata.

The lexicon is learned from all labelled texts of the training rows: words of any length, common or
rare, that toxic texts hold far more often than chance would have it, and clean ones hardly.  Every distinct
token is matched by walking the lexicon's trie with a Levenshtein automaton that counts
two swapped letters as one edit, of distance 1 (terms of four letters or more) or 2 (eight or more),
after undoing digit and sign disguises, so misspelled terms are caught; training
words near a term that occur in clean texts are not taken for it.  Each hit is
looked at in a window of words: inside quotation marks or after a reporting
word it counts as quoted, near a second person as direct.  A logistic
regression over those counts, fitted to a bounded sample of the labelled texts, gives the score.

Edge cases: null and empty texts have no hits and get the score of such texts;
without labelled texts of both kinds every score is the prior of 0 hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkrec.llm.common import hash52, small_batches
from linkrec.llm.components import connected_components
from linkrec.session import materialize

#: The classifier is fitted to at most this many labelled texts, first in hash order.
SAMPLE_ROWS = 20_000
DISGUISE = str.maketrans("013457@$!", "oieastasi")
REPORTING = {"said", "says", "called", "call", "calls", "word", "words", "term", "quote", "quoted", "wrote", "insult"}
SECOND = {"you", "your", "you're", "youre", "u", "ur"}
QUOTES = "\"“”„«»"
WINDOW = 4
CACHE = 300_000
#: States of the automaton that are kept before it is built anew, a bound on memory.
STATES = 50_000
#: Most label rows (16 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Salts of the MinHashes that find near copies among the labelled texts.
SIGNATURES = range(1, 9)
#: Misspellings that the operator looks for: in any letter, in terms of at least so many letters.
NEAR = {"first": False, "least": 4}


class Trie:
    """Lexicon trie x Levenshtein automaton, made deterministic as words ask for it: a state is the set of
    (node, edits, letter that must follow) a word's beginning can be at, its steps are kept.

    `first`: the first letters must agree; `least`: letters of a term that may be misspelled."""

    def __init__(self, terms, not_terms=(), first: bool = True, least: int = 5):
        self.first, self.least = first, least
        self.exact, self.not_terms = set(terms), set(not_terms)
        self.letters = {c for t in terms for c in t}
        # nodes: children, term that ends here, most edits of any term below
        self.child, self.term, self.most = [{}], [None], [0]
        for t in sorted(self.exact):
            at, edits = 0, self.edits(t)
            self.most[0] = max(self.most[0], edits)
            for c in t:
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.most.append(0)
                at = self.child[at][c]
                self.most[at] = max(self.most[at], edits)
            self.term[at] = t
        self.low = min((len(t) - self.edits(t) for t in terms), default=1)
        self.high = max((len(t) + self.edits(t) for t in terms), default=0)
        self._forget()

    def edits(self, term: str) -> int:
        return 0 if len(term) < self.least else 2 if len(term) >= 8 else 1

    def _forget(self) -> None:
        self.ids, self.states, self.steps, self.starts = {}, [], [], {}

    def _state(self, items: dict) -> int | None:
        """The id of the state of `items`, (node, letter) -> edits, and all that letters left out lead to."""
        todo = list(items.items())
        while todo:
            (node, letter), e = todo.pop()
            if letter or items[node, letter] < e:
                continue
            for nxt in self.child[node].values():
                if e + 1 <= self.most[nxt] and items.get((nxt, ""), 9) > e + 1:
                    items[nxt, ""] = e + 1
                    todo.append(((nxt, ""), e + 1))
        if not items:
            return None
        key = frozenset(items.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(items)
            self.steps.append({})
        return self.ids[key]

    def _step(self, state: int, c: str) -> int | None:
        out: dict = {}

        def add(node, letter, e):
            if e <= self.most[node] and out.get((node, letter), 9) > e:
                out[node, letter] = e
        for (node, letter), e in self.states[state].items():
            if letter:
                if letter == c:
                    add(node, "", e)
                continue
            add(node, "", e + 1)                                         # a letter too many
            for x, nxt in self.child[node].items():
                add(nxt, "", e + (x != c))
                if x != c and c in self.child[nxt]:                      # the term has x c, the word c x
                    add(self.child[nxt][c], x, e + 1)
        return self._state(out)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance, 0 to 2."""
        if word in self.exact:
            return word, 0
        if word in self.not_terms or not self.low <= len(word) <= self.high:
            return None
        if len(self.states) > STATES:
            self._forget()
        rest = word[1:] if self.first else word
        start = word[:1] if self.first else ""
        if start not in self.starts:
            node = self.child[0].get(start) if self.first else 0
            self.starts[start] = None if node is None else self._state({(node, ""): 0})
        state = self.starts[start]
        for c in rest:
            if state is None:
                return None
            c = c if c in self.letters else "\0"
            steps = self.steps[state]
            if c not in steps:
                steps[c] = self._step(state, c)
            state = steps[c]
        if state is None:
            return None
        found = [(e, self.term[node]) for (node, letter), e in self.states[state].items()
                 if not letter and self.term[node] is not None and e <= self.edits(self.term[node])]
        if not found:
            return None
        e, term = min(found)
        return term, e


_STRIP, _TAIL = re.compile(r"^[\W_]+|[\W_]+$"), re.compile(r"[\W_]+$")


def plain(token: str) -> str:
    """Lower-case core of a token, with digits and signs between letters read as letters."""
    core = _STRIP.sub("", token.lower())
    if core.isalpha() and token[:1] not in "$@":
        return core
    if sum(c.isalpha() for c in core) < 2:
        return core
    spelled = _STRIP.sub("", _TAIL.sub("", token.lower()).translate(DISGUISE))
    return "".join(c for c in spelled if c.isalpha())


class Tokens:
    """Matches of the tokens met so far: those that are hits, and the set of the others."""

    def __init__(self, trie: Trie):
        self.trie, self.hits, self.misses = trie, {}, set()

    def of(self, tokens: list[str]) -> dict[str, tuple[str, int]]:
        """The hits among `tokens`, by token."""
        distinct = set(tokens)
        fresh = distinct - self.misses
        found = {}
        if len(self.misses) + len(self.hits) > CACHE:
            self.hits, self.misses = {}, set()
        for t in fresh:
            m = self.hits.get(t) or self.trie.match(plain(t))
            if m:
                self.hits[t] = found[t] = m
            else:
                self.misses.add(t)
        return found


def features(text: str | None, known: Tokens) -> np.ndarray:
    """[any, log exact, log misspelled, log quoted, log direct, share of words]."""
    tokens = (text or "").split()
    hits = known.of(tokens)
    if not hits:
        return np.zeros(6)
    exact = fuzzy = quoted = direct = 0
    open_quote, quotes = False, [q for q in QUOTES if q in text]
    for i, t in enumerate(tokens):
        marks = sum(t.count(q) for q in quotes)
        m = hits.get(t)
        if m:
            around = [plain(x) for x in tokens[max(0, i - WINDOW):i + WINDOW + 1]]
            if open_quote or marks or REPORTING & set(around[:min(i, WINDOW)]):
                quoted += 1
            elif m[1]:
                fuzzy += 1
            else:
                exact += 1
            direct += bool(SECOND & set(around))
        if marks % 2:
            open_quote = not open_quote
    n = exact + fuzzy + quoted
    return np.array([float(exact + fuzzy > 0), np.log1p(exact), np.log1p(fuzzy), np.log1p(quoted),
                     np.log1p(direct), min(10.0, 100.0 * n / len(tokens))])


def train_rows(key: Column) -> Column:
    """Rows whose labels may be learned from: crc32(key as text) mod 5 is not 0."""
    return F.crc32(key.cast("string").cast("binary")) % 5 != 0


def _term_counts(batches):
    for pdf in batches:
        seen: dict[str, list[int]] = {}
        for text, y in zip(pdf["text"], pdf["toxic"]):
            for w in {plain(t) for t in set((text or "").split())}:
                if w:
                    seen.setdefault(w, [0, 0])[y] += 1
        yield pd.DataFrame([(w, c[0], c[1]) for w, c in seen.items()], columns=["term", "clean", "toxic"])


def _evidence(toxic: Column, clean: Column, base: float) -> Column:
    """-log of the Chernoff bound on a term's chance to be in so many toxic texts, if it were
    spread over the texts at random; `base` is the share of toxic texts."""
    n = toxic + clean
    return toxic * F.log(toxic / n / base) + F.when(clean > 0, clean * F.log(clean / n / (1 - base))).otherwise(0.0)


def _least(text: str | None) -> np.ndarray:
    """MinHashes of the text's runs of three words, one for each of `SIGNATURES`."""
    words = (text or "").split()
    h = np.fromiter((crc32(x.encode()) for x in words), np.uint64, len(words))
    n = max(1, len(h) - 2)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(3, len(h))):
            grams = (grams ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
        return np.array([((grams ^ np.uint64(s)) * np.uint64(0xBF58476D1CE4E5B9 + 2 * s)).min() for s in SIGNATURES])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _signatures(texts: pd.Series) -> pd.Series:
    return pd.Series([_least(t).view(np.int64).tolist() for t in texts])


def _distinct_texts(labelled: DataFrame) -> DataFrame:
    """(text, toxic): of the labelled texts (key, text, toxic) one for each group of near copies of a label.
    Texts that agree in a MinHash are linked, near copies of 80 % in at least one of eight but for 3 in a million;
    a group is what the links connect, so it counts once as evidence however its copies differ."""
    sig = materialize(labelled.select("key", "toxic", F.posexplode(_signatures(F.col("text"))).alias("j", "s")), "signatures")
    first = sig.groupBy("toxic", "j", "s").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    links = sig.join(first, ["toxic", "j", "s"]).where("key <> first").select(F.col("key").alias("a"), F.col("first").alias("b"))
    copies = connected_components(links).where("node <> component").select(F.col("node").alias("key"))
    return labelled.join(copies, "key", "left_anti").select("text", "toxic")


def _near_terms(terms: list[str]):
    def run(batches):
        trie = Trie(terms, **NEAR)
        for pdf in batches:
            yield pdf[[t not in trie.exact and trie.match(t) is not None for t in pdf["term"]]]
    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chance: float = 0.01,
        precision: float = 0.8) -> dict:
    """The model: lexicon, near words that are no terms, weights.  `chance`: of any term at all being
    in the lexicon by chance; `precision`: of its texts that must be toxic."""
    small_batches(docs.sparkSession)
    known = materialize(labels.where("doc_id is not null and toxic in (0, 1)").where(train_rows(F.col("doc_id")))
                        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "known")
    some = known.orderBy(hash52("doc_id"), "doc_id").limit(rows)
    # texts are shuffled only where the labels are too many to be sent along
    side = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    labelled = materialize(docs.select("doc_id", "text").join(side, "doc_id").withColumn(
        "key", F.xxhash64("doc_id", "text", F.col("text").isNull())), "labelled")
    sample = materialize(labelled.join(F.broadcast(some.select("doc_id")), "doc_id").select("text", "toxic"), "sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = {"terms": [], "not_terms": [], "weights": [float(np.log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 0.5)))] + [0.0] * 6}
    if not n.get(0) or not n.get(1):
        return model
    # near copies are no evidence of their own
    once = materialize(_distinct_texts(labelled.where("length(text) > 0").dropDuplicates(["key"])), "distinct_texts")
    counts = materialize(once.mapInPandas(_term_counts, "term string, clean long, toxic long")
                         .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")
    base, n_terms = once.select(F.avg("toxic")).first()[0], counts.count()
    if not base or base == 1:
        return model
    # words of the context have their own features and are no terms
    lexicon = sorted(r["term"] for r in counts.where(
        ~F.col("term").isin(sorted(SECOND | REPORTING)) & (F.col("toxic") >= precision * (F.col("toxic") + F.col("clean")))
        & (F.col("toxic") > base * (F.col("toxic") + F.col("clean")))
        & (_evidence(F.col("toxic"), F.col("clean"), base) >= float(np.log(n_terms / chance)))).select("term").collect())
    if not lexicon:
        return model
    innocent = counts.where((F.col("clean") >= 2) & (F.col("clean") >= F.col("toxic"))).select("term")
    model |= {"terms": lexicon, "not_terms": sorted(
        r["term"] for r in innocent.mapInPandas(_near_terms(lexicon), "term string").collect())}
    seen = sample.select("toxic", _feature_udf(model)(F.col("text")).alias("x")).toPandas()
    model["weights"] = _logistic(np.stack(seen["x"].to_numpy()), seen["toxic"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton steps of a ridge logistic regression with an intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def _feature_udf(model: dict):
    """An iterator UDF: one trie and one token cache for all batches of a task."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Tokens(Trie(model["terms"], model["not_terms"], **NEAR))
        for text in batches:
            yield pd.Series([features(t, known) for t in text])
    return run


def _scorer(model: dict):
    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Tokens(Trie(model["terms"], model["not_terms"], **NEAR))
        w = np.array(model["weights"])
        for text in batches:
            z = np.array([w[0] + features(t, known) @ w[1:] for t in text])
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return run


def score(docs: DataFrame, model: dict, out: str = "score") -> DataFrame:
    """`docs` with the column `out`, the text's toxicity from 0 to 1."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out, _scorer(model)(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(~train_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
