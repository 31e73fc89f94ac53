"""Stream golden values (FIXTURES.md §3) and delivery properties."""

import json
import os

from pyspark.sql import functions as F

from linkrec.streaming import scores as ST

EVENTS = [
    {"user_id": 1, "action": "follow", "target_user_id": 2, "timestamp": 1.0, "session_duration": None},
    {"user_id": 1, "action": "unfollow", "target_user_id": 2, "timestamp": 2.0, "session_duration": None},
    {"user_id": 1, "action": "zap", "target_user_id": 3, "timestamp": 3.0, "session_duration": None},
    {"user_id": 2, "action": "watch", "target_user_id": 1, "timestamp": 4.0, "session_duration": 60},
]


def _write(dirpath, name, lines):
    with open(os.path.join(dirpath, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _scores(sink):
    return {(r.user_id, r.target_user_id): r.interaction_score for r in sink.scores.current().collect()}


def test_stream_scores_quarantine_and_restart(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, "a.json", [json.dumps(e) for e in EVENTS[:2]])
    _write(src, "b.json", [json.dumps(e) for e in EVENTS[2:]] + ["{not json", '{"user_id": 5}'])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    users = spark.createDataFrame([(1,), (2,)], "new_id long")
    raw = ST.json_file_source(spark, str(src), files_per_trigger=1)
    sink, (q, _) = ST.run_score_stream(spark, raw, out, ck, users=users)
    assert _scores(sink) == {(1, 2): 2.0, (1, 3): 1.0, (2, 1): 2.0}
    # INTERACTED_WITH needs both users: (1, 3) has an unknown target
    edges = {(r.src, r.dst): r.weight for r in sink.edges.current().collect()}
    assert edges == {(1, 2): 2.0, (2, 1): 2.0}
    bad = spark.read.parquet(os.path.join(out, "quarantine", "*")).collect()
    assert sorted(r._raw for r in bad) == ['{"user_id": 5}', "{not json"]
    assert ST.input_rows(q) == 6

    # restart from the checkpoint: nothing new, same result
    sink2, _ = ST.run_score_stream(spark, ST.json_file_source(spark, str(src)), out, ck, users=users)
    assert _scores(sink2) == {(1, 2): 2.0, (1, 3): 1.0, (2, 1): 2.0}

    # a new file is folded into the running state
    _write(src, "c.json", [json.dumps({"user_id": 1, "action": "follow", "target_user_id": 3, "timestamp": 5.0})])
    sink3, _ = ST.run_score_stream(spark, ST.json_file_source(spark, str(src)), out, ck, users=users)
    assert _scores(sink3) == {(1, 2): 2.0, (1, 3): 4.0, (2, 1): 2.0}


def test_sink_replay_is_idempotent(spark, tmp_path):
    sink = ST.ScoreSink(spark, str(tmp_path / "t"))
    b0 = spark.createDataFrame([(1, 2, 3.0, None)], "user_id long, target_user_id long, interaction_score double, last_updated timestamp")
    b1 = spark.createDataFrame([(1, 2, 5.0, None), (3, 4, 1.0, None)], b0.schema)
    sink(b0, 0)
    sink(b1, 1)
    first = sorted(map(tuple, sink.scores.current().select("user_id", "target_user_id", "interaction_score").collect()))
    sink(b1, 1)                       # replay of batch 1
    again = sorted(map(tuple, sink.scores.current().select("user_id", "target_user_id", "interaction_score").collect()))
    assert first == again == [(1, 2, 5.0), (3, 4, 1.0)]


def test_stream_equals_batch(spark):
    from linkrec.operators.interactions import interaction_scores
    from linkrec.sources.tables import Tables
    from tests.conftest import SF001
    import tempfile
    t = Tables(spark, SF001)
    d = tempfile.mkdtemp(prefix="lr-test-")
    ST.events_as_json(t.events()).repartition(3).write.mode("overwrite").text(os.path.join(d, "in"))
    sink, _ = ST.run_score_stream(spark, ST.json_file_source(spark, os.path.join(d, "in"), 1),
                                  os.path.join(d, "out"), os.path.join(d, "ck"))
    s = sink.scores.current().select("user_id", "target_user_id", "interaction_score")
    b = interaction_scores(t.events()).select("user_id", "target_user_id", "interaction_score")
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_delta_table_compaction_and_replay(spark, tmp_path):
    from linkrec.operators.writes import KeyedDeltaTable
    t = KeyedDeltaTable(spark, str(tmp_path / "kt"), ["k"], compact_every=2)
    schema = "k long, v double"
    batches = [[(1, 1.0), (2, 1.0)], [(1, 2.0)], [(3, 5.0)], [(2, 7.0)], [(1, 9.0)]]
    for i, rows in enumerate(batches):
        t.apply(spark.createDataFrame(rows, schema), i)
    exp = {1: 9.0, 2: 7.0, 3: 5.0}
    assert {r.k: r.v for r in t.current().collect()} == exp
    assert t.base.versions() == [1, 3]                  # compacted after batches 1 and 3
    t.apply(spark.createDataFrame(batches[3], schema), 3)   # replay of a compacted batch
    assert {r.k: r.v for r in t.current().collect()} == exp


def test_progress_counts_every_batch_and_reports_each_fifty(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    ev = lambda i: json.dumps({"user_id": i, "action": "follow", "target_user_id": i + 1, "timestamp": float(i)})
    for f in range(6):
        _write(src, f"{f}.json", [ev(20 * f + i) for i in range(20)] + ["{bad"])
    seen = []
    prog = ST.EventProgress(report=lambda n, latest: seen.append((n, latest["user_id"])))
    raw = ST.json_file_source(spark, str(src), files_per_trigger=1)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    _, (q, _) = ST.run_score_stream(spark, raw, out, ck, progress=prog)
    assert prog.total == 126 == ST.input_rows(q)
    assert [n for n, _ in seen] == [50, 100] and prog.last_report[0] == 100
    # a restart goes on: what was counted is not counted again
    _write(src, "new.json", [ev(500 + i) for i in range(30)])
    ST.run_score_stream(spark, ST.json_file_source(spark, str(src)), out, ck, progress=prog)
    assert prog.total == 156 and seen[-1] == (150, 529)


def test_progress_adds_up_more_than_a_hundred_batches_and_replays():
    prog = ST.EventProgress()
    for b in range(250):
        prog.add("q", b, 3)
    prog.add("q", 249, 3)                      # replayed
    prog.add("other", 0, 1)
    assert prog.total == 751 and prog.last_report == (750, None)


def test_state_is_kept_outside_the_heap(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, "a.json", [json.dumps(e) for e in EVENTS])
    before = spark.conf.get(ST._PROVIDER_KEY)
    _, (q, _) = ST.run_score_stream(spark, ST.json_file_source(spark, str(src)), str(tmp_path / "o"), str(tmp_path / "c"))
    metrics = q.recentProgress[0]["stateOperators"][0]["customMetrics"]
    assert any(k.startswith("rocksdb") for k in metrics)
    assert spark.conf.get(ST._PROVIDER_KEY) == before
