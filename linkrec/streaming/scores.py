"""Activity-event stream -> running interaction scores.

    readStream (kafka / json files) -> from_json -> [quarantine bad rows]
      -> weight(action) -> groupBy(user, target).agg(sum, max ts)   (state store)
      -> outputMode("update") -> foreachBatch: keyed merge into snapshots

The aggregation state lives in Spark's state store and is recovered from the
checkpoint; the sink writes each batch's updated rows as delta ``batch=<id>``
of a merge-on-read keyed table, so replaying a batch id rewrites the same
content (idempotent; effectively-once end to end) and a batch costs O(batch).  The
weight expression is the one of the batch path (``weighted_events``), so the
stream and the daily batch agree (L6).
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from linkrec.operators.interactions import PAIR, weighted_events
from linkrec.operators.writes import KeyedDeltaTable

# Wire format of one event (JSON object).
EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("target_user_id", T.LongType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("session_duration", T.IntegerType()),
])


# The running scores are kept on local disk and their changes in the checkpoint,
# so the state of all pairs need not fit into the executors' heap.
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROGRESS_EVERY = 50


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A5: subscribe from the earliest offset; offsets live in the query's
    checkpoint (the consumer group's role).  Needs the Kafka connector jar."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load())


def json_file_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """File form of the event stream: one JSON event per line, as a ``value`` column."""
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def decode(raw: DataFrame) -> DataFrame:
    """L1 + B8: bytes/text -> JSON -> typed columns.  Adds ``_bad`` (not
    parseable or a required key missing) for the quarantine split."""
    txt = F.col("value").cast("string")
    ev = raw.select(txt.alias("_raw"), F.from_json(txt, EVENT_SCHEMA).alias("e"))
    ok = (F.col("e").isNotNull() & F.col("e.user_id").isNotNull() & F.col("e.action").isNotNull()
          & F.col("e.target_user_id").isNotNull())
    return ev.select("_raw", (~F.coalesce(ok, F.lit(False))).alias("_bad"),
                     F.col("e.user_id").alias("user_id"), F.col("e.action").alias("action"),
                     F.col("e.target_user_id").alias("target_user_id"),
                     F.timestamp_seconds(F.col("e.timestamp")).alias("ts"),
                     F.col("e.session_duration").alias("session_duration"))


def running_scores(events: DataFrame) -> DataFrame:
    """L2: state per (user, target): score += weight(action), last event time."""
    return (weighted_events(events.where(~F.col("_bad"))).groupBy(*PAIR)
            .agg(F.sum("weight").alias("interaction_score"), F.max("ts").alias("last_updated")))


class ScoreSink:
    """foreachBatch sink writing the keyed tables (scores, edges).

    In update mode a micro-batch holds the *full* current aggregate of every
    key it touched, so writing just those rows as the batch's delta is a
    correct upsert; the tables are merge-on-read (``KeyedDeltaTable``), so a
    batch costs O(batch), not O(state)."""

    def __init__(self, spark: SparkSession, base: str, users: DataFrame | None = None,
                 compact_every: int = 10):
        self.spark = spark
        self.scores = KeyedDeltaTable(spark, os.path.join(base, "user_interactions"), PAIR, compact_every)
        self.edges = KeyedDeltaTable(spark, os.path.join(base, "interacted_with"), ["src", "dst"], compact_every)
        self.users = users

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        self.scores.apply(batch, batch_id)
        if self.users is not None:
            # INTERACTED_WITH only when both users exist
            u = self.users.select(F.col("new_id").alias("_u"))
            e = (batch.join(u, batch.user_id == u._u, "left_semi")
                 .join(u, batch.target_user_id == u._u, "left_semi")
                 .select(F.col("user_id").alias("src"), F.col("target_user_id").alias("dst"),
                         F.col("interaction_score").alias("weight"), F.col("last_updated").alias("updated")))
            self.edges.apply(e, batch_id)
        batch.unpersist()


def quarantine_sink(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.where(F.col("_bad")).select("_raw").write.mode("overwrite").parquet(
            os.path.join(path, f"v={batch_id}"))
    return write


class EventProgress(StreamingQueryListener):
    """L4: counts the events of the scoring query and reports
    ``report(count, latest)`` whenever the count passes a multiple of ``every``;
    ``latest`` is the (ts, user_id, action, target_user_id) row of the latest good
    event of that batch (None if it had none).

    Every micro-batch is added up, however many there are; a batch that is
    replayed after a restart counts once.  ``last_report`` keeps the last one.
    """

    def __init__(self, every: int = PROGRESS_EVERY, report: Callable | None = None):
        self.every, self.report = every, report
        self.total, self.last_report, self._seen = 0, None, {}
        self._ended, self._change = set(), threading.Condition()

    def add(self, query_id: str, batch_id: int, rows: int, latest=None) -> None:
        if batch_id <= self._seen.get(query_id, -1) or not rows:
            return
        self._seen[query_id] = batch_id
        before, self.total = self.total, self.total + rows
        passed = self.total // self.every * self.every
        if passed > before:
            self.last_report = (passed, latest)
            if self.report is not None:
                self.report(passed, latest)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get("events")
        if seen is not None:
            self.add(str(p.id), p.batchId, p.numInputRows, seen["latest"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, query, timeout: float = 30.0) -> bool:
        """Progress arrives after its batch: true once the ended query's last report is in."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, timeout)


def observed(events: DataFrame) -> DataFrame:
    """The decoded events, with the latest good one reported to the listeners."""
    good = F.when(~F.col("_bad"), F.struct("ts", "user_id", "action", "target_user_id"))
    return events.observe("events", F.max(good).alias("latest"))


def run_score_stream(spark: SparkSession, raw: DataFrame, out_base: str, checkpoint: str,
                     users: DataFrame | None = None, available_now: bool = True,
                     state_provider: str = STATE_PROVIDER, progress: EventProgress | None = None):
    """Start (and, with ``available_now``, finish) the scoring query plus the
    quarantine query.  Returns the sink (its tables hold the results).  A query
    that is started again keeps the state provider its checkpoint names."""
    ev = decode(raw)
    sink = ScoreSink(spark, out_base, users)
    w = (running_scores(observed(ev)).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", os.path.join(checkpoint, "scores")))
    qw = (ev.writeStream.outputMode("append").foreachBatch(quarantine_sink(os.path.join(out_base, "quarantine")))
          .option("checkpointLocation", os.path.join(checkpoint, "quarantine")))
    if available_now:
        w, qw = w.trigger(availableNow=True), qw.trigger(availableNow=True)
    if progress is not None:
        spark.streams.addListener(progress)
    # a query copies the session's settings as it starts
    before = spark.conf.get(_PROVIDER_KEY)
    spark.conf.set(_PROVIDER_KEY, state_provider)
    try:
        q1 = w.start()
    finally:
        spark.conf.set(_PROVIDER_KEY, before)
    q2 = qw.start()
    if available_now:
        q1.awaitTermination()
        q2.awaitTermination()
        if progress is not None:
            progress.wait(q1)
            spark.streams.removeListener(progress)
    return sink, (q1, q2)


def input_rows(query) -> int:
    """Events in the progress reports that a query still holds (the last 100
    batches); ``EventProgress`` counts all."""
    return sum(p.get("numInputRows", 0) for p in query.recentProgress)


def events_as_json(events: DataFrame) -> DataFrame:
    """Events table -> wire-format JSON lines (value column)."""
    return events.select(F.to_json(F.struct(
        "user_id", "action", "target_user_id",
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("timestamp"),
        F.when(F.col("action") == "watch", F.lit(None).cast("int")).alias("session_duration"),
    )).alias("value"))
