"""Blocked all-pairs scoring for dense similarities.

Content cosine and factor scores are dense: almost every user pair has a
non-zero score, so an inverted index does not help and the n x n matrix must
never exist.  Rows are ranged by id and packed, ``block_size`` to a block, one
table row of flat arrays each; the left blocks meet the right ones in a
shuffle-replicated nested loop join, whose right partitions are streamed to
the tasks, so each row is shuffled once, not once a block.  A task multiplies
two blocks in numpy (content rows dense, factor rows by their entries) and
carries along, for the left block it is at, only what is needed:

* pass 1 (hybrid only): per user, min and max of each score, reduced by
  ``groupBy(user)`` -- the per-user min-max normalisation needs the whole row,
  which is never kept;
* pass 2: per user, the best ``k`` candidates so far after removing the user
  itself and the users it already follows, merged by a per-user top-k.
  Right blocks come in the order of their ids, so a later candidate must beat
  the k-th best so far, and next to none does.

A task leaves at most k rows a user, and there are as many tasks a user as
right partitions (one per ``RIGHT_BLOCKS`` blocks).  Work is O(n^2 d / P) --
inherent to exact all-pairs scores; disk is in proportion to the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrec.operators.topk import top_k_per
from linkrec.session import materialize

EPS = 1e-9


def n_blocks(n_rows: int, block_size: int) -> int:
    return max(1, -(-n_rows // block_size))


_NO_IDX = np.zeros(0, dtype=np.int64)
_NO_VAL = np.zeros(0, dtype=np.float64)


def _entries(idx_series, val_series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows -> flat (row, column, value), ordered by column, then row."""
    idx = [_NO_IDX if x is None else x for x in idx_series]
    val = [_NO_VAL if x is None else x for x in val_series]
    row = np.repeat(np.arange(len(idx)), np.fromiter(map(len, idx), dtype=np.int64, count=len(idx)))
    col = np.concatenate([_NO_IDX, *idx]).astype(np.int64)
    order = np.argsort(col, kind="stable")
    return row[order], col[order], np.concatenate([_NO_VAL, *val])[order]


def _order(col: np.ndarray) -> np.ndarray:
    """Stable order of columns; those of few kinds, as factors have, are counted, not compared."""
    small = len(col) and 0 <= col.min() and col.max() < 1 << 16
    return np.argsort(col.astype(np.uint16) if small else col, kind="stable")


DENSE_GAIN = 16            # a multiply-add of a dense product is so many times cheaper than one by index
PAIRS_AT_ONCE = 4_000_000


def sparse_product(left: tuple, right: tuple, shape: tuple[int, int]) -> np.ndarray:
    """L Rᵀ of two blocks of sparse rows (``_entries``), whatever the width of the rows.

    Only columns with entries on both sides count.  A column of l and r entries costs
    l * r by index and all of ``shape`` in a dense product, and goes the cheaper
    way; the dense matrices are at most ``DENSE_GAIN`` times the mean row's entries wide."""
    (lr, lc, lv), (rr, rc, rv) = left, right
    cols = np.intersect1d(lc, rc)
    out = np.zeros(shape)
    if not len(cols):
        return out
    lstart, rstart = np.searchsorted(lc, cols), np.searchsorted(rc, cols)
    ln, rn = np.searchsorted(lc, cols, "right") - lstart, np.searchsorted(rc, cols, "right") - rstart
    heavy = ln * rn * DENSE_GAIN > out.size
    if heavy.any():
        dense = []
        for (row, col, val), n in ((left, shape[0]), (right, shape[1])):
            at = np.minimum(np.searchsorted(cols[heavy], col), heavy.sum() - 1)
            take = cols[heavy][at] == col
            wide = int(heavy.sum())
            dense.append(np.bincount(row[take] * wide + at[take], val[take], n * wide).reshape(n, wide))
        out += dense[0] @ dense[1].T
    # light columns: each left entry meets the right entries of its column
    at = np.repeat(np.flatnonzero(~heavy), ln[~heavy])
    entry = np.flatnonzero(np.isin(lc, cols[~heavy]))
    ends = np.cumsum(rn[at])
    done = 0
    while done < len(entry):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS_AT_ONCE, "right")))
        e, n = entry[done:upto], rn[at[done:upto]]
        first = np.repeat(rstart[at[done:upto]] - (np.cumsum(n) - n), n)
        other, mine = first + np.arange(n.sum()), np.repeat(e, n)
        out += np.bincount(lr[mine] * shape[1] + rr[other], lv[mine] * rv[other], out.size).reshape(shape)
        done = upto
    return out


FEW = 16                   # a product of which at most one cell in so many is filled is kept as cells


def few_cells(left: tuple, right: tuple, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray] | None:
    """``sparse_product`` as (flat places, values) of the cells whose rows share a column, ascending;
    None where so many entries meet that a whole matrix is the cheaper form."""
    (lr, lc, lv), (rr, rc, rv) = left, right
    first = np.searchsorted(rc, lc)
    n = np.searchsorted(rc, lc, "right") - first
    if n.sum() * FEW > shape[0] * shape[1]:
        return None
    other = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    mine = np.repeat(np.arange(len(lc)), n)
    at, place = np.unique(lr[mine] * shape[1] + rr[other], return_inverse=True)
    return at, np.bincount(place, lv[mine] * rv[other], len(at))


TILE = 64                  # rows of a dense product at once: they stay in the processor's cache


def _tiles(left: np.ndarray, right: np.ndarray):
    """(first row, rows of ``left @ right.T``) by TILE rows; each overwrites the one before."""
    buffer, right = np.empty((TILE, len(right))), np.ascontiguousarray(right.T)
    for lo in range(0, len(left), TILE):
        part = left[lo:lo + TILE]
        yield lo, np.matmul(part, right, out=buffer[:len(part)])


def best_columns(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k best entries of each row, of equal ones the first (-inf counts as an entry)."""
    n = scores.shape[1]
    if k >= n:
        return np.ones(scores.shape, dtype=bool)
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    more, equal = scores > kth, scores == kth
    room = k - more.sum(axis=1, keepdims=True)
    return more | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= room))


RIGHT_BLOCKS = 256         # blocks in one right partition, which a task holds as packed rows
LEFT_PARTS = 96
TASKS = 48

_PACKED = "lo long, n int, ids binary, known binary"


def _flat(series, dtype) -> tuple[bytes, bytes]:
    """Arrays of the rows -> (lengths, entries) as bytes."""
    rows = [() if x is None else x for x in series]
    lens = np.fromiter(map(len, rows), dtype=np.int32, count=len(rows))
    flat = np.concatenate([np.asarray(x, dtype=dtype) for x in rows]) if lens.sum() else np.zeros(0, dtype)
    return lens.tobytes(), flat.astype(dtype).tobytes()


def _ids(series: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    known = series.notna().to_numpy()
    return series.fillna(0).to_numpy().astype(np.int64), known


def packed_blocks(rows: DataFrame, block_size: int, scalars: tuple[str, ...] = (), n_rows: int | None = None) -> DataFrame:
    """Rows ``(id, c_idx, c_val, f_idx, f_val [, excl] [, scalars])`` -> one row per block of at most ``block_size``
    of them, in ranges of ``id``: ``lo`` (its first id) and flat arrays as binary columns, and the
    number ``block``; written once."""
    lists = [(c, t) for c, t in (("c_idx", np.int32), ("c_val", np.float64), ("f_idx", np.int32),
                                 ("f_val", np.float64), ("excl", np.int64)) if c in rows.columns]
    schema = ", ".join([_PACKED, *[f"{c}_len binary, {c} binary" for c, _ in lists], *[f"{c} binary" for c in scalars]])
    # ranges of about eight blocks
    parts = n_blocks(rows.count() if n_rows is None else n_rows, 8 * block_size)
    rows = rows.repartitionByRange(parts, "id").sortWithinPartitions("id")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, known = _ids(pdf["id"])
        out = {"lo": int(ids[0]) if known[0] else None, "n": len(pdf), "ids": ids.tobytes(), "known": known.tobytes()}
        for c, t in lists:
            out[f"{c}_len"], out[c] = _flat(pdf[c], t)
        for c in scalars:
            out[c] = pdf[c].to_numpy(dtype=np.float64).tobytes()
        return pd.DataFrame([out])

    def blocks(batches):
        held, n = [], 0
        for pdf in batches:
            held, n = [*held, pdf], n + len(pdf)
            while n > block_size:
                whole = pd.concat(held, ignore_index=True)
                # rows of one id stay together where a block can hold them
                ids, known = _ids(whole["id"])
                first, cut = int(np.count_nonzero(~known)), block_size
                if first < cut and ids[cut] == ids[cut - 1]:
                    cut = first + int(np.searchsorted(ids[first:], ids[cut])) or cut
                yield pack(whole[:cut].reset_index(drop=True))
                held, n = [whole[cut:]], n - cut
        if n:
            yield pack(pd.concat(held, ignore_index=True))

    packed = rows.mapInPandas(blocks, schema)
    return materialize(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")


class _Block:
    """One side of a block pair, read from its packed row."""

    def __init__(self, row: dict, prefix: str):
        self._row, self._prefix = row, prefix
        self.n = int(row[prefix + "n"])
        self.ids = self.read("ids", np.int64)
        self.known = self.read("known", np.bool_)

    def read(self, name: str, dtype) -> np.ndarray:
        return np.frombuffer(self._row[self._prefix + name], dtype=dtype)

    def has(self, name: str) -> bool:
        return self._row.get(self._prefix + name) is not None

    def rows_of(self, name: str) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.read(name + "_len", np.int32))

    def dense(self, width: int) -> np.ndarray:
        m = np.zeros((self.n, width))
        m[self.rows_of("c_idx"), self.read("c_idx", np.int32)] = self.read("c_val", np.float64)
        return m

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Factor entries as (row, column, value), ordered by column, then row."""
        col = self.read("f_idx", np.int32).astype(np.int64)
        order = _order(col)
        return self.rows_of("f_idx")[order], col[order], self.read("f_val", np.float64)[order]

    def self_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows, ids) ordered by id: the pairs of a user with itself."""
        at = np.flatnonzero(self.known)
        at = at[np.argsort(self.ids[at], kind="stable")]
        return at, self.ids[at]

    def followed(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows, ids) ordered by id: the users each row already follows."""
        if not self.has("excl"):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, ids = self.rows_of("excl"), self.read("excl", np.int64)
        order = np.argsort(ids, kind="stable")
        return at[order], ids[order]


def _cells(pairs: tuple[np.ndarray, np.ndarray], right: _Block, once: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the left block's ``pairs`` (row, id) in the right block, whose ids ascend (null ones first):
    all columns of an id that comes more than once, or with ``once`` the first."""
    rows, ids = pairs
    first = int(np.argmax(right.known)) if right.known.any() else right.n
    rid = right.ids[first:]
    if not len(rid) or not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    part = slice(np.searchsorted(ids, rid[0]), np.searchsorted(ids, rid[-1], "right"))
    lo, hi = np.searchsorted(rid, ids[part]), np.searchsorted(rid, ids[part], "right")
    n = np.minimum(hi - lo, 1) if once else hi - lo
    starts = np.repeat(lo - (np.cumsum(n) - n), n)
    return np.repeat(rows[part], n), first + starts + np.arange(n.sum())


def block_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left block (columns ``l_...``) beside every right one (``r_...``), by left block, the
    right blocks of a task in the order of their ids."""
    n_left, n_right = left.count(), right.count()
    parts = max(1, min(n_left, LEFT_PARTS))
    slices = max(n_blocks(n_right, RIGHT_BLOCKS), min(n_right, n_blocks(TASKS, parts)))
    r = right.select(*[F.col(c).alias("r_" + c) for c in right.columns])
    # the partition's number, not being a function of the row, keeps the sort, which a join would drop
    r = r.repartitionByRange(slices, "r_lo").sortWithinPartitions("r_lo").withColumn("r_slice", F.spark_partition_id())
    le = left.select(*[F.col(c).alias("l_" + c) for c in left.columns]).repartition(parts)
    return le.crossJoin(r.hint("shuffle_replicate_nl"))


def _walk(batches, start, step, end):
    """Runs ``step(state, left, right)`` over the block pairs of a task; ``start(left)`` and ``end(state)`` at each left block."""
    state, key = None, None
    for pdf in batches:
        for row in pdf.to_dict("records"):
            if key is None or key != row["l_block"]:
                if state is not None:
                    yield end(state)
                left = _Block(row, "l_")
                state, key = start(left), row["l_block"]
            step(state, left, _Block(row, "r_"))
    if state is not None:
        yield end(state)


def score_rows(content: DataFrame, factor_left: DataFrame | None, factor_right: DataFrame | None) -> tuple:
    """Join the per-user sparse rows: ``content(id, c_idx, c_val)`` (unit
    length), ``factor_*(id, f_idx, f_val)``.  Candidates are the content
    users; a missing factor row scores 0."""
    empty_i = F.array().cast("array<int>")
    empty_v = F.array().cast("array<double>")
    def with_f(f):
        if f is None:
            return content.select("id", "c_idx", "c_val", empty_i.alias("f_idx"), empty_v.alias("f_val"))
        j = content.join(f, "id", "left")
        return j.select("id", "c_idx", "c_val", F.coalesce("f_idx", empty_i).alias("f_idx"),
                        F.coalesce("f_val", empty_v).alias("f_val"))
    return with_f(factor_left), with_f(factor_right)


def _scores(state: dict, right: _Block, width: int, mode: str) -> tuple[np.ndarray | None, np.ndarray | None]:
    c = None if mode == "factor" else state["dense"] @ right.dense(width).T
    s = None if mode == "content" else sparse_product(state["entries"], right.entries(), (state["n"], right.n))
    return c, s


def _started(left: _Block, width: int, mode: str) -> dict:
    return {"n": left.n, "ids": left.ids, "known": left.known,
            "dense": None if mode == "factor" else left.dense(width),
            "entries": None if mode == "content" else left.entries()}


def _nullable(ids: np.ndarray, known: np.ndarray) -> pd.Series:
    return pd.Series(pd.arrays.IntegerArray(ids.astype(np.int64), ~known))


def user_minmax(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    """Pass 1, of packed blocks: per user, min/max of the content score over all other users
    and of the factor score over all users (self included)."""
    schema = "id long, cmin double, cmax double, smin double, smax double"

    def start(block: _Block) -> dict:
        state = _started(block, width, "hybrid")
        state["self"] = block.self_pairs()
        state["low"], state["high"] = np.full((2, block.n), np.inf), np.full((2, block.n), -np.inf)
        return state

    def by_tiles(state: dict, block: _Block, other: _Block) -> bool:
        """The step without whole matrices; False where a user meets itself or the factor scores are many."""
        cells = few_cells(state["entries"], other.entries(), (block.n, other.n))
        if cells is None or len(_cells(state["self"], other)[0]):
            return False
        low, high = state["low"], state["high"]
        for lo, c in _tiles(state["dense"], other.dense(width)):
            at = slice(lo, lo + len(c))
            low[0, at] = np.minimum(low[0, at], c.min(axis=1))
            high[0, at] = np.maximum(high[0, at], c.max(axis=1))
        row = cells[0] // other.n
        gap = np.bincount(row, minlength=block.n) < other.n           # rows with a cell of no entry, of score 0
        low[1, gap], high[1, gap] = np.minimum(low[1, gap], 0.0), np.maximum(high[1, gap], 0.0)
        np.minimum.at(low[1], row, cells[1])
        np.maximum.at(high[1], row, cells[1])
        return True

    def step(state: dict, block: _Block, other: _Block) -> None:
        if by_tiles(state, block, other):
            return
        c, s = _scores(state, other, width, "hybrid")
        for x, m in enumerate((c, s)):
            own = _cells(state["self"], other) if m is c else ((), ())
            if len(own[0]):
                m[own] = np.inf
            state["low"][x] = np.minimum(state["low"][x], m.min(axis=1))
            if len(own[0]):
                m[own] = -np.inf
            state["high"][x] = np.maximum(state["high"][x], m.max(axis=1))

    def end(state: dict) -> pd.DataFrame:
        low, high = state["low"], state["high"]
        return pd.DataFrame({"id": _nullable(state["ids"], state["known"]), "cmin": low[0], "cmax": high[0],
                             "smin": low[1], "smax": high[1]})

    part = block_pairs(left, right).mapInPandas(lambda it: _walk(it, start, step, end), schema)
    return part.groupBy("id").agg(F.min("cmin").alias("cmin"), F.max("cmax").alias("cmax"),
                                  F.min("smin").alias("smin"), F.max("smax").alias("smax"))


class _Best:
    """The k best candidates of each left row so far: score falling, then id (null first)."""

    def __init__(self, n: int, k: int):
        self.k, self.kth, self.last = k, np.full(n, -np.inf), None
        self.rows = np.zeros(0, np.int64)
        self.cols = [np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0), np.zeros(0)]

    def add(self, scores: np.ndarray, right: _Block, c: np.ndarray | None, s: np.ndarray | None) -> None:
        """Where the right blocks come in ascending order of their ids, an equal later score loses."""
        over = scores > self.kth[:, None] if self.ascends(right) else (scores >= self.kth[:, None]) & np.isfinite(scores)
        self.passed(right)
        if np.count_nonzero(over) > 4 * self.k * len(self.kth):
            over &= best_columns(scores, self.k)           # columns ascend by id
        rows, at = np.nonzero(over)
        self.take(rows, [scores[rows, at], right.ids[at], right.known[at], np.full(len(at), np.nan) if c is None else c[rows, at],
                         np.full(len(at), np.nan) if s is None else s[rows, at]])

    def ascends(self, right: _Block) -> bool:
        """Whether the block's ids come after all before."""
        return self.last is None or (bool(right.known[0]), int(right.ids[0])) >= self.last

    def passed(self, right: _Block) -> None:
        last = (bool(right.known[-1]), int(right.ids[-1]))
        self.last = last if self.last is None else max(self.last, last)

    def take(self, rows: np.ndarray, got: list[np.ndarray]) -> None:
        """Merges candidates: their rows and (score, id, known, content, factor)."""
        if not len(rows):
            return
        hit = np.zeros(len(self.kth), dtype=bool)
        hit[rows] = True
        old = hit[self.rows]
        r = np.concatenate([self.rows[old], rows])
        cols = [np.concatenate([a[old], b]) for a, b in zip(self.cols, got, strict=True)]
        order = np.lexsort((cols[1], cols[2], -cols[0], r))
        r, cols = r[order], [x[order] for x in cols]
        first = np.searchsorted(r, r)
        place = np.arange(len(r)) - first
        best = place < self.k
        last = place == self.k - 1
        self.kth[r[last]] = cols[0][last]
        self.rows = np.concatenate([self.rows[~old], r[best]])
        self.cols = [np.concatenate([a[~old], b[best]]) for a, b in zip(self.cols, cols, strict=True)]


def _least_content(state: dict, alphas: list[float]) -> np.ndarray:
    """Per row, the content score that a candidate of factor score 0 must reach to be among the best k so far for any alpha;
    -inf where there are fewer than k.  A little low, so that rounding bars none."""
    zero = -state["low"]["s"][:, 0] / state["span"]["s"][:, 0]
    least = np.full(len(zero), np.inf)
    for a, best in zip(alphas, state["best"], strict=True):
        if a > 0:
            need = (best.kth - (1.0 - a) * zero) / a
            need = need - 1e-9 * (1 + np.abs(best.kth) + np.abs(zero)) / a
        else:
            need = np.where(zero > best.kth, -np.inf, np.inf)
        least = np.fmin(least, need)
    out, some = np.where(least == np.inf, np.inf, -np.inf), np.isfinite(least)
    scaled, low = least[some] * state["span"]["c"][some, 0], state["low"]["c"][some, 0]
    out[some] = scaled + low - 1e-9 * (np.abs(scaled) + np.abs(low))
    return np.where(np.isnan(out), -np.inf, out)


def blocked_topk(left: DataFrame, right: DataFrame, width: int, k: int, alphas: list[float], *,
                 block_size: int, exclude: DataFrame | None = None, minmax: DataFrame | None = None,
                 mode: str = "hybrid") -> DataFrame:
    """Pass 2: best k candidates per (alpha, user) of the rows ``left`` among the packed blocks ``right``.

    ``mode``: "content" ranks by the cosine, "factor" by the factor score,
    "hybrid" by alpha * norm(content) + (1 - alpha) * norm(factor) with the
    per-user min-max of pass 1; a score that the mode does not use is neither
    computed nor filled.  ``exclude(src, dst)``: pairs never
    recommended (already followed).  Output ``alpha, user_id,
    recommended_user, score, content, factor, rank``.
    """
    scalars = ("cmin", "cmax", "smin", "smax") if minmax is not None else ()
    n_left = left.count()
    if minmax is not None:
        left = left.join(minmax, "id", "left")
    if exclude is not None:
        ex = (exclude.select(F.col("src").alias("id"), F.col("dst").cast("long").alias("_v")).where("_v is not null")
              .distinct().groupBy("id").agg(F.collect_list("_v").alias("excl")))
        left = left.join(ex, "id", "left")
    packed = packed_blocks(left, block_size, scalars, n_left)
    schema = ("alpha double, user_id long, recommended_user long, score double, "
              "content double, factor double")

    def start(block: _Block) -> dict:
        state = _started(block, width, mode)
        state["self"], state["followed"] = block.self_pairs(), block.followed()
        state["best"] = [_Best(block.n, k) for _ in alphas]
        if mode == "hybrid":
            low = {x: block.read(x + "min", np.float64)[:, None] for x in "cs"}
            state["low"] = low
            state["span"] = {x: block.read(x + "max", np.float64)[:, None] - low[x] + EPS for x in "cs"}
        return state

    def few(state: dict, block: _Block, other: _Block, barred: tuple) -> bool:
        """The hybrid step for factor rows that seldom share an entry: a candidate without one has factor score 0, so
        that its content score alone tells whether it can be among the best k of any alpha; only such
        candidates, and those that share an entry, are scored.  False where that does not hold."""
        if other.n <= k or not all(0 <= a <= 1 for a in alphas) or not all(b.ascends(other) for b in state["best"]):
            return False
        cells = few_cells(state["entries"], other.entries(), (block.n, other.n))
        if cells is None or not (cells[1] >= 0).all():
            return False
        least = _least_content(state, alphas)
        known = least > -np.inf                             # other rows have fewer than k candidates so far
        row, col = barred
        order = np.argsort(row, kind="stable")
        row, col = row[order], col[order]
        at, score = [], []
        for lo, c in _tiles(state["dense"], other.dense(width)):
            here = slice(lo, lo + len(c))
            need = least[here].copy()
            out = slice(*np.searchsorted(row, (lo, lo + len(c))))
            if not known[here].all():
                if not np.isfinite(c).all():
                    return False
                c[row[out] - lo, col[out]] = -np.inf
                top = np.partition(c[~known[here]], other.n - k, axis=1)[:, other.n - k]
                need[~known[here]] = top - 1e-9 * (1 + np.abs(top))
            c[row[out] - lo, col[out]] = np.nan
            mine = cells[0][slice(*np.searchsorted(cells[0], (lo * other.n, (lo + len(c)) * other.n)))] - lo * other.n
            over = c >= need[:, None]
            if 0 in alphas and not known[here].all():       # without content, the first ids of score 0
                free = ~np.isnan(c) & ~known[here][:, None]
                free.ravel()[mine] = False
                over |= free & (np.cumsum(free, axis=1, dtype=np.int32) <= k)
            over.ravel()[mine] = True
            over = np.flatnonzero(over)
            at.append(over + lo * other.n)
            score.append(c.ravel()[over])
        at, c = np.concatenate(at), np.concatenate(score)
        s = np.zeros(len(at))
        s[np.searchsorted(at, cells[0])] = cells[1]
        row, col = at // other.n, at % other.n
        cn, sn = ((m - state["low"][x][row, 0]) / state["span"][x][row, 0] for x, m in (("c", c), ("s", s)))
        for a, best in zip(alphas, state["best"], strict=True):
            sc = a * cn + (1.0 - a) * sn
            take = np.flatnonzero((sc > best.kth[row]) & np.isfinite(sc))
            best.passed(other)
            best.take(row[take], [sc[take], other.ids[col[take]], other.known[col[take]], c[take], s[take]])
        return True

    def step(state: dict, block: _Block, other: _Block) -> None:
        # of a followed user whose row is repeated, the first copy is barred
        cells = tuple(map(np.concatenate, zip(_cells(state["self"], other), _cells(state["followed"], other, True),
                                              strict=True)))
        if mode == "hybrid" and few(state, block, other, cells):
            return
        c, s = _scores(state, other, width, mode)
        if mode == "hybrid":
            cn, sn = ((m - state["low"][x]) / state["span"][x] for x, m in (("c", c), ("s", s)))
        for a, best in zip(alphas, state["best"], strict=True):
            sc = c if mode == "content" else s if mode == "factor" else a * cn + (1.0 - a) * sn
            odd = ~np.isfinite(sc)
            if odd.any():
                sc[odd] = -np.inf
            sc[cells] = -np.inf
            best.add(sc, other, c, s)

    def end(state: dict) -> pd.DataFrame:
        out = []
        for a, best in zip(alphas, state["best"], strict=True):
            score, ids, known, content, factor = best.cols
            out.append(pd.DataFrame({"alpha": float(a), "user_id": _nullable(state["ids"][best.rows], state["known"][best.rows]),
                                     "recommended_user": _nullable(ids, known), "score": score,
                                     "content": content, "factor": factor}))
        return pd.concat(out, ignore_index=True)

    part = block_pairs(packed, right).mapInPandas(lambda it: _walk(it, start, step, end), schema)
    return top_k_per(part, ["alpha", "user_id"], [F.col("score").desc(), F.col("recommended_user")], k)
