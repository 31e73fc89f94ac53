import zlib

from pyspark.sql import functions as F

from linkrec.llm.sharding import assign_shards, shard_documents, shard_slots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)


def test_few_records_move_and_weights_hold(spark):
    keys = spark.range(20000).select(F.col("id").alias("doc_id"))
    rows = assign_shards(keys, [1.0, 2.0, 1.0], grown=("grown", 1.0)).collect()
    counts = [sum(r.shard == s for r in rows) for s in range(3)]
    assert abs(counts[1] - 10000) < 400 and abs(counts[0] - 5000) < 300
    moved = [r for r in rows if r.grown != r.shard]
    assert all(r.grown == 3 for r in moved) and abs(len(moved) - 4000) < 300


def test_slots_gapless_over_ranges(spark):
    keys = assign_shards(spark.range(3000).select(F.col("id").alias("doc_id")), [1.0, 1.0])
    from linkrec.llm.common import hash52, rank_by_hash
    got = rank_by_hash(keys.withColumn("_h", hash52("doc_id")), ["shard"], "_h", ["doc_id"], "slot", per_task=100)
    by = {}
    for r in got.collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    same = {(r.doc_id, r.slot) for r in shard_slots(keys).collect()}
    assert same == {(r.doc_id, r.slot) for r in got.collect()}


def test_nulls_repeats_empty(spark):
    got = shard_documents(docs(spark, [(1, "é x"), (1, "é x"), (2, None), (None, "a"), (None, None), (3, ""),
                                       (4, "z" * 300000)]).withColumn("shard", F.lit("clash"))).collect()
    assert len(got) == 7
    by = {(r.doc_id, r.size): r for r in got}
    assert by[(1, 5)].text_crc32 == zlib.crc32("é x".encode()) and by[(2, 1)].text_crc32 == 0
    assert {r.shard for r in got if r.doc_id is None}.__len__() == 1
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shard_documents(docs(spark, [])).count() == 0
