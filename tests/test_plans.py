"""Physical-plan assertions: the scalable plans stay scalable."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # run once so AQE settles
    return _plan(df)


@pytest.mark.parametrize("name", ["batch_jaccard", "batch_cosine", "node_similarity", "clustering",
                                  "edge_split", "pair_features", "spot_check", "ranking_metrics"])
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, p


def test_topk_uses_window_group_limit(spark):
    p = _plan(E.queries()["node_similarity"](spark, SF001))
    assert "WindowGroupLimit" in p


def test_global_top_n_is_take_ordered(spark):
    p = _plan(E.queries()["strong_similar_top"](spark, SF001))
    assert "TakeOrderedAndProject" in p


def test_filter_pushed_to_scan(spark):
    from linkrec.sources.tables import Tables
    p = _plan(Tables(spark, SF001).follows())
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in p


def test_link_prediction_joins_its_input_tables_once(spark):
    """Follows and games come from joins of the order lines: before, every step that reads them joined again."""
    from linkrec.plans.link_prediction import LinkPrediction
    from linkrec.sources.tables import Tables
    t = Tables(spark, SF001)
    lp = LinkPrediction(spark, t.users(), t.user_games(), t.follows())
    assert "Join" in _plan(t.follows()) and "Join" in _plan(t.user_games())
    for mine, given in ((lp.follows, t.follows()), (lp.user_games, t.user_games())):
        assert "Join" not in _plan(mine)
        assert sorted(mine.collect()) == sorted(given.collect())
    assert lp.follows is lp.follows
