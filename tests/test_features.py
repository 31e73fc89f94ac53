"""The positional content matrix against its definition."""

import numpy as np
import pytest

from linkrec.operators import features as FT
from linkrec.operators.hybrid import content_rows, content_topk
from linkrec.plans.similarity_job import run_similarity

USERS = [(1, 10, 5, True, False), (2, 30, 1, False, True), (3, 20, 3, None, None), (4, None, 2, False, False)]
LISTS = [(1, [7, 2, 9]), (2, []), (3, None), (4, [5, None, 0, 4]), (8, [3])]       # 8 has no user row


def _tables(spark):
    users = spark.createDataFrame(USERS, "new_id long, views long, days long, partner boolean, mature boolean")
    return users, spark.createDataFrame(LISTS, "new_id long, features array<long>")


def _dense(rows, width):
    out = {}
    for r in rows:
        m = np.zeros(width)
        m[r.slot_idx] = r.slot_val
        out[r.new_id] = m.tolist()
    return out


def test_positional_matrix(spark):
    fm = FT.positional_matrix(*_tables(spark))
    rows = fm.collect()
    assert {r.n_slots for r in rows} == {8} and len(rows) == len(LISTS)
    assert _dense(rows, 8) == {1: [0.0, 1.0, 1, 0, 7, 2, 9, 0], 2: [1.0, 0.0, 0, 1, 0, 0, 0, 0],
                               3: [0.5, 0.5, 0, 0, 0, 0, 0, 0], 4: [0.0, 0.25, 0, 0, 5, 0, 0, 4],
                               8: [0.0, 0.0, 0, 0, 3, 0, 0, 0]}
    assert all(len(r.slot_idx) <= 8 and 0.0 not in r.slot_val[4:] for r in rows)        # no padding is kept


def test_positional_matrix_of_empty_tables(spark):
    users, lists = _tables(spark)
    assert FT.positional_matrix(users, lists.limit(0)).count() == 0
    assert [r.slot_val for r in FT.positional_matrix(users.limit(0), lists.where("new_id = 8")).collect()] \
        == [[0.0, 0.0, 0.0, 0.0, 3.0]]


def test_content_topk_on_positional_rows(spark):
    fm = FT.positional_matrix(*_tables(spark))
    m = _dense(fm.collect(), 8)
    unit = {u: np.array(v) / (np.linalg.norm(v) or 1.0) for u, v in m.items()}
    got = {}
    for r in sorted(content_topk(*content_rows(fm), k=2, block_size=2).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.user_id, []).append(r.recommended_user)
    for u in m:
        assert got[u] == sorted((v for v in m if v != u), key=lambda v: (-round(unit[u] @ unit[v], 12), v))[:2]


def test_similarity_job_names_its_encodings(spark):
    with pytest.raises(ValueError, match="unknown encoding"):
        run_similarity(spark, None, None, None, encoding="one_hot")
