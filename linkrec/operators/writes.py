"""Keyed writes of the relational / graph stores re-expressed on DataFrames
(A7-A16).

Each operator returns the *new content* of the target as a DataFrame; the
physical write is a separate step (``SnapshotTable``), because parquet has no
MERGE.  A snapshot is a folder of versions ``v=<n>``; writing version ``n``
again replaces it, so replaying a micro-batch id is idempotent.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dedup(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def insert_first_wins(target: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO NOTHING.

    Within ``new`` the first row per key (by ``order``, the input ordinal)
    wins; keys already in ``target`` keep the existing row."""
    first = _dedup(new, key, [F.col(order).asc()]).drop(order)
    fresh = first.join(target.select(*key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def upsert_last_wins(target: DataFrame, new: DataFrame, key: list[str], order: str,
                     set_cols: list[str]) -> DataFrame:
    """MERGE (n {key}) SET n.c = row.c ...

    The last input row per key wins; on a match the ``set_cols`` take the new
    values (a NULL clears the property, as SET to null does); other columns of
    an existing row stay; unknown keys are created."""
    last = _dedup(new, key, [F.col(order).desc()]).drop(order).withColumn("_hit", F.lit(True))
    t = target.alias("t")
    n = last.alias("n")
    j = t.join(n, key, "full_outer")
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.col(c))
        elif c in set_cols:
            out.append(F.when(F.col("n._hit"), F.col(f"n.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def nodes_from_edges(edges: DataFrame, nodes: DataFrame, key: str = "new_id",
                     src: str = "src", dst: str = "dst") -> DataFrame:
    """MERGE (u {key}) for every edge endpoint -> the nodes to create."""
    ends = edges.select(F.col(src).alias(key)).union(edges.select(F.col(dst).alias(key))).distinct()
    return ends.join(nodes.select(key), key, "left_anti")


def replacing_upsert(current: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """ON CONFLICT (key) DO UPDATE SET ... / MERGE edge SET ...

    New rows replace old rows with the same key; old rows absent from the new
    run stay (stale rows are not removed, as in the reference).  Rows of two whole-number keys, as
    all pairs have, are shuffled in compressed boxes."""
    old = current.select(*new.columns)
    if len(key) == 2 and all(isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType)) for df in (old, new) for c in key):
        return new.unionByName(_without(old, new, key))
    return new.unionByName(current.join(new.select(*key), key, "left_anti").select(*new.columns))


# Boxes per shuffle partition, and rows that are put in boxes at once.
BOXES, BOX_ROWS = 4, 1 << 18


def _boxed(df: DataFrame, key: list[str], side: int, boxes: int) -> DataFrame:
    """``(box, side, rows)``: the rows by a hash of the first key, sorted and compressed, the keys as differences."""
    def pack(table: pa.Table):
        k0, k1 = (table[c].to_numpy().astype(np.int64) for c in key)
        with np.errstate(over="ignore"):
            box = ((k0.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(boxes)).astype(np.int32)
        order = np.lexsort((k1, k0, box))
        table, box, k0, k1 = table.take(order), box[order], k0[order], k1[order]
        start = np.flatnonzero(np.r_[True, box[1:] != box[:-1]])
        out = []
        for lo, hi in zip(start.tolist(), [*start[1:].tolist(), len(box)], strict=True):
            part = table.slice(lo, hi - lo)
            for c, k in zip(key, (k0, k1), strict=True):
                part = part.set_column(part.column_names.index(c), c, pa.array(np.diff(k[lo:hi], prepend=0)))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(part.combine_chunks())
            out.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_pydict({"box": pa.array(box[start]), "side": pa.array([side] * len(out), pa.int32()), "rows": pa.array(out, pa.binary())})

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= BOX_ROWS:
                yield pack(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield pack(pa.Table.from_batches(held))

    return df.where(" and ".join(f"`{c}` is not null" for c in key)).mapInArrow(run, "box int, side int, rows binary")


def _without(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``old`` whose two keys no row of ``new`` has; a null key is like no other.

    A task holds the keys that ``new`` has in one box, a share of 1 / (BOXES * shuffle partitions)."""
    parts = int(old.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (_boxed(new.select(*key), key, 0, BOXES * parts)
            .unionByName(_boxed(old, key, 1, BOXES * parts)))

    def unpack(blob: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        table = pa.ipc.open_stream(blob).read_all()
        return table, *(np.cumsum(table[c].to_numpy()) for c in key)

    def place(k: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, k), len(known) - 1)
        return at, known[at] == k

    def rest(batches):
        box, found, index = None, [], None
        for batch in batches:
            for now, side, blob in zip(*(batch.column(x).to_pylist() for x in range(3)), strict=True):
                if now != box:
                    box, found, index = now, [], None
                table, k0, k1 = unpack(blob)
                if side == 0:
                    found.append((k0, k1))
                    continue
                if found:
                    (u0, i0), (u1, i1) = (np.unique(np.concatenate(x), return_inverse=True) for x in zip(*found, strict=True))
                    index, found = (u0, u1, np.unique(i0 * len(u1) + i1)), []
                stay = np.ones(len(k0), dtype=bool)
                if index is not None:
                    (i0, in0), (i1, in1) = place(k0, index[0]), place(k1, index[1])
                    stay = ~(in0 & in1 & place(i0 * len(index[1]) + i1, index[2])[1])
                for c, k in zip(key, (k0, k1), strict=True):
                    table = table.set_column(table.column_names.index(c), c, pa.array(k))
                yield from table.filter(pa.array(stay)).to_batches()

    boxes = both.repartitionById(parts, F.pmod(F.col("box"), F.lit(parts))).sortWithinPartitions("box", "side")
    wide = T.StructType([T.StructField(f.name, T.LongType() if f.name in key else f.dataType) for f in old.schema])
    kept = boxes.mapInArrow(rest, wide).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema])
    return kept.unionByName(old.where(" or ".join(f"`{c}` is null" for c in key)))


def truncate_and_load(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """TRUNCATE + INSERT ... ON CONFLICT DO NOTHING: one row per key,
    the first by ``order`` (deterministic; lowest rank)."""
    return _dedup(rows, key, order)


def append_rows(df: DataFrame, path: str) -> None:
    """A10: CREATE of an edge -- plain append, duplicates kept."""
    df.write.mode("append").parquet(path)


def pk_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once (must be empty for a primary key)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def run_log_row(spark: SparkSession, previous: DataFrame | None, counts: DataFrame) -> DataFrame:
    """Append-only run log; ``run_id`` = previous max + 1 (serial)."""
    row = counts.withColumn("run_date", F.current_timestamp())
    if previous is None:
        nxt = F.lit(1)
    else:
        # scalar subquery: one value, no join
        nxt = previous.agg(F.coalesce(F.max("run_id"), F.lit(0)) + 1).scalar()
    return row.select(nxt.cast("int").alias("run_id"), *row.columns)


class SnapshotTable:
    """Versioned parquet table: ``<path>/v=<n>``; the highest version is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(self.path)
        return hpath, hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        return self.versions_named("v=")

    def versions_named(self, prefix: str) -> list[int]:
        """Completed sub-folders ``<prefix><n>`` (a ``_SUCCESS`` marker present)."""
        hpath, fs = self._fs()
        if not fs.exists(hpath):
            return []
        out = []
        for st in fs.listStatus(hpath):
            name = st.getPath().getName()
            if name.startswith(prefix) and fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(int(name[len(prefix):]))
        return sorted(out)

    def current(self) -> DataFrame | None:
        v = self.versions()
        if not v:
            return None
        return self.spark.read.parquet(os.path.join(self.path, f"v={v[-1]}"))

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(self.path, f"v={version}"))


class KeyedDeltaTable:
    """Merge-on-read keyed table for streaming upserts.

    Each micro-batch writes only its rows (full current values of the keys it
    updated) to ``deltas/batch=<id>``; rewriting the same batch id replaces
    that folder, so replays are idempotent.  The current content is the latest
    row per key over the last compacted base and the newer deltas -- one
    distributed ``max_by`` aggregate.  Every ``compact_every`` batches the
    current content is written as ``base/v=<id>``, so readers never scan more
    than that many deltas.  Write cost per batch is O(batch), not O(state).
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], compact_every: int = 10):
        self.spark = spark
        self.path = path
        self.key = key
        self.compact_every = compact_every
        self.base = SnapshotTable(spark, os.path.join(path, "base"))
        self.deltas = os.path.join(path, "deltas")

    def _delta_ids(self) -> list[int]:
        return SnapshotTable(self.spark, self.deltas).versions_named("batch=")

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(os.path.join(self.deltas, f"batch={batch_id}"))
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            # built from an older base only, so a replay never reads what it overwrites
            self.base.write(self._merged(upto=batch_id, base_before=batch_id), batch_id)

    def _merged(self, upto: int | None = None, base_before: int | None = None) -> DataFrame | None:
        bases = [v for v in self.base.versions()
                 if (upto is None or v <= upto) and (base_before is None or v < base_before)]
        start = bases[-1] if bases else -1
        ids = [b for b in self._delta_ids() if b > start and (upto is None or b <= upto)]
        parts = []
        if bases:
            parts.append(self.spark.read.parquet(os.path.join(self.base.path, f"v={start}"))
                         .withColumn("_batch", F.lit(start)))
        for b in ids:
            parts.append(self.spark.read.parquet(os.path.join(self.deltas, f"batch={b}"))
                         .withColumn("_batch", F.lit(b)))
        if not parts:
            return None
        allrows = parts[0]
        for p in parts[1:]:
            allrows = allrows.unionByName(p)
        vals = [c for c in allrows.columns if c not in self.key and c != "_batch"]
        latest = allrows.groupBy(*self.key).agg(
            F.max_by(F.struct(*vals), F.col("_batch")).alias("_v"))
        return latest.select(*self.key, *[F.col(f"_v.{c}").alias(c) for c in vals])

    def current(self) -> DataFrame | None:
        return self._merged()
