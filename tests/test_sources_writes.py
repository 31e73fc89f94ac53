"""Parse rules, readers and keyed writes (FIXTURES.md §3 edge cases)."""

import pytest
import os

from pyspark.sql import functions as F

from linkrec.functions.exprs import bool_false_default, bool_lenient, parse_int_list
from linkrec.operators import writes as W
from linkrec.sources import files as FS


def test_boolean_parse_strict_and_lenient(spark):
    df = spark.createDataFrame([("TRUE",), ("false",), ("maybe",), ("1",)], "x string")
    rows = df.select(bool_false_default(F.col("x")).alias("s"), bool_lenient(F.col("x")).alias("l")).collect()
    assert [r.s for r in rows] == [True, False, False, False]
    assert [r.l for r in rows] == [True, False, None, None]


def test_json_decode_empty_default(spark):
    df = spark.createDataFrame([("[1, 2]",), (None,), ("",), ("oops",)], "f string")
    got = [r.a for r in df.select(parse_int_list(F.col("f")).alias("a")).collect()]
    assert got == [[1, 2], [], [], []]


def test_feature_map_reader(spark, tmp_path):
    p = tmp_path / "f.json"
    p.write_text('{"0": [12, 7], "5": [], "3": [7]}')
    got = sorted((r.new_id, r.game) for r in FS.read_feature_map(spark, str(p)).collect())
    assert got == [(0, 7), (0, 12), (3, 7), (5, None)]


def test_users_csv_lenient_int(spark, tmp_path):
    p = tmp_path / "u.csv"
    p.write_text("id,days,mature,views,partner,new_id\n1,10,True,5,false,0\n2,x,maybe,7,TRUE,1\n")
    rows = sorted(FS.read_users_csv(spark, str(p), lenient=True).collect(), key=lambda r: r.new_id)
    assert rows[1].days is None and rows[1].mature is None and rows[1].partner is True


def test_first_wins_last_wins_replace(spark):
    tgt = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (2, "c", 1)], "k int, v string, o int")
    assert sorted(map(tuple, W.insert_first_wins(tgt, new, ["k"], "o").collect())) == [(1, "old"), (2, "b")]
    lw = W.upsert_last_wins(tgt, new, ["k"], "o", ["v"])
    assert sorted(map(tuple, lw.collect())) == [(1, "a"), (2, "c")]
    rep = W.replacing_upsert(spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string"),
                             spark.createDataFrame([(1, "y")], "k int, v string"), ["k"])
    assert sorted(map(tuple, rep.collect())) == [(1, "y"), (3, "z")]
    dup = spark.createDataFrame([(1, 2), (1, 2), (2, 3)], "a int, b int")
    assert [tuple(r) for r in W.pk_violations(dup, ["a", "b"]).collect()] == [(1, 2, 2)]


def test_truncate_and_load_keeps_lowest_rank(spark):
    r = spark.createDataFrame([(1, 5, 2), (1, 5, 1), (1, 6, 3)], "user_id int, recommended_user int, rank int")
    out = W.truncate_and_load(r, ["user_id", "recommended_user"], [F.col("rank")])
    assert sorted(map(tuple, out.collect())) == [(1, 5, 1), (1, 6, 3)]


def test_batch_jaccard_golden(spark):
    from linkrec.operators.similarity import batch_jaccard, strong_similar_pairs
    inter = spark.createDataFrame([(1, 2, 3.0), (1, 3, 1.0), (2, 3, 2.0), (2, 4, 1.5), (3, 9, 1.0), (3, 4, -1.0)],
                                  "user_id long, target_user_id long, interaction_score double")
    j = {(r.user_a, r.user_b): r.jaccard_score for r in batch_jaccard(inter).collect()}
    assert list(j) == [(1, 2)] and abs(j[(1, 2)] - 1 / 3) < 1e-9      # (1,3), (2,3) disjoint -> not stored
    assert [(r.user_a, r.user_b) for r in strong_similar_pairs(batch_jaccard(inter)).collect()] == [(1, 2)]


def test_feature_map_is_split_and_keeps_every_list(spark, tmp_path):
    import json
    from linkrec.sources import files as FS
    want = {i: [i % 7, -i, 10 ** 12 + i] if i % 5 else [] for i in range(3000)}
    expect = sorted((k, g) for k, v in want.items() for g in v) + [(k, None) for k, v in want.items() if not v]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    key = lambda r: (r[1] is None, r[0], r[1] or 0)
    for indent in (None, 2):
        p = tmp_path / f"map{indent}.json"
        p.write_text(json.dumps({str(k): v for k, v in want.items()}, indent=indent))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        try:
            df = FS.read_feature_map(spark, str(p))
            assert df.select(F.spark_partition_id()).distinct().count() > 4
            assert sorted(map(tuple, df.collect()), key=key) == sorted(expect, key=key)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_feature_map_round_trip_empty_and_bad(spark, tmp_path):
    import json
    from linkrec.sources import files as FS
    lists = spark.createDataFrame([(5, [3, 1]), (2, []), (9, None), (None, [1]), (-4, [7])],
                                  "new_id long, features array<long>")
    FS.write_feature_map(lists, str(tmp_path / "m"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "m").glob("part-*")))
    assert json.loads(text) == {"-4": [7], "2": [], "5": [3, 1], "9": []}
    got = sorted(map(tuple, FS.read_feature_map(spark, str(tmp_path / "m")).collect()), key=str)
    assert got == sorted([(-4, 7), (2, None), (5, 3), (5, 1), (9, None)], key=str)
    FS.write_feature_map(lists.limit(0), str(tmp_path / "none"))
    assert FS.read_feature_map(spark, str(tmp_path / "none")).count() == 0
    for i, bad in enumerate(['{"a": [1]}', '{"1": [1, "x"]}', '{"1": [[1]]}', '{"1": [1, 2']):
        p = tmp_path / f"bad{i}.json"
        p.write_text(bad)
        with pytest.raises(Exception):
            FS.read_feature_map(spark, str(p)).collect()


def test_replacing_upsert_of_pairs_moves_boxes_not_rows(spark, monkeypatch):
    """Pairs with null and repeated keys, nulls in other columns and ids of any size: the rows of the anti join, of
    which only compressed boxes are shuffled."""
    from random import Random

    r = Random(11)
    ids = [None, 0, 1, 2, 3, -5, 1 << 40, (1 << 62) + 1, -(1 << 62)]
    old, new = ([(r.choice(ids), r.choice(ids), r.choice([None, 0.5, 0.25]), r.choice(["x", None])) for _ in range(n)] for n in (300, 25))
    monkeypatch.setattr(W, "BOX_ROWS", 16)
    schema = "a long, b long, s double, t string"
    for x, y in ((old, new), (old, []), ([], new)):
        got = W.replacing_upsert(spark.createDataFrame(x, schema), spark.createDataFrame(y, schema), ["a", "b"])
        keys = {row[:2] for row in y if None not in row[:2]}
        exp = y + [row for row in x if row[:2] not in keys]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, exp))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "rows" in plan
