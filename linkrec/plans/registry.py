"""Registered queries (``__spark_entry__.queries``) and their DuckDB oracles.

Every query reads the given tables through ``Tables`` and runs over them
whole.  Floating columns are rounded to 6 places on both sides, arrays are
compared as comma-joined text, "now" columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrec.functions.exprs import rnd
from linkrec.operators import interactions as I
from linkrec.operators import similarity as S
from linkrec.operators import writes as W
from linkrec.plans import daily
from linkrec.plans.oracle_sql import sql
from linkrec.session import materialize
from linkrec.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _scores(t: Tables, follow_only: bool = False) -> DataFrame:
    ev = t.events()
    if follow_only:
        ev = ev.where(F.col("action").isin("follow", "unfollow"))
    return I.interaction_scores(ev)


# ---------------------------------------------------------------- interactions
@query("action_weights", sql(["wev"], "select event_id, user_id, target_user_id, action, weight from wev"))
def q_action_weights(spark, sf):
    return I.weighted_events(Tables(spark, sf).events()).select(
        "event_id", "user_id", "target_user_id", "action", "weight")


@query("interaction_scores", sql(["inter"], "select user_id, target_user_id, interaction_score from inter"))
def q_interaction_scores(spark, sf):
    return _scores(Tables(spark, sf)).select("user_id", "target_user_id", "interaction_score")


@query("ingest_counts", sql(["inter"], """select count(*) interaction_count,
    count(distinct user_id) unique_users from inter"""))
def q_ingest_counts(spark, sf):
    return I.ingest_counts(_scores(Tables(spark, sf)))


@query("interaction_sets", sql(["sets"], """select user_id,
    array_to_string(list_sort(targets), ',') targets, len(targets) n_targets from sets"""))
def q_interaction_sets(spark, sf):
    s = I.interaction_sets(_scores(Tables(spark, sf)))
    return s.select("user_id", F.array_join("targets", ",").alias("targets"),
                    F.size("targets").cast("bigint").alias("n_targets"))


@query("interactions_upsert", sql(["inter"], "select user_id, target_user_id, interaction_score from inter"))
def q_interactions_upsert(spark, sf):
    """follow/unfollow scores upserted additively with the rest = all."""
    t = Tables(spark, sf)
    ev = t.events()
    first = I.interaction_scores(ev.where(F.col("action").isin("follow", "unfollow")))
    rest = I.interaction_scores(ev.where(~F.col("action").isin("follow", "unfollow")))
    return I.additive_upsert(first, rest).select("user_id", "target_user_id", "interaction_score")


# ------------------------------------------------------------------ similarity
@query("batch_jaccard", sql(["jac"], """select user_a, user_b, round(jaccard_score, 6) jaccard_score
    from jac where jaccard_score is not null"""))
def q_batch_jaccard(spark, sf):
    j = S.batch_jaccard(_scores(Tables(spark, sf)))
    return j.select("user_a", "user_b", rnd(F.col("jaccard_score")).alias("jaccard_score"))


@query("batch_jaccard_follow", sql(["jac_follow"], """select user_a, user_b,
    round(jaccard_score, 6) jaccard_score from jac_follow where jaccard_score is not null"""))
def q_batch_jaccard_follow(spark, sf):
    j = S.batch_jaccard(_scores(Tables(spark, sf), follow_only=True))
    return j.select("user_a", "user_b", rnd(F.col("jaccard_score")).alias("jaccard_score"))


@query("batch_jaccard_salted", sql(["jac"], """select user_a, user_b, round(jaccard_score, 6) jaccard_score
    from jac where jaccard_score is not null"""))
def q_batch_jaccard_salted(spark, sf):
    """H1 with every item salted (hot-group size 8): the skew path gives the same pairs."""
    j = S.batch_jaccard(_scores(Tables(spark, sf)), hot_group=8)
    return j.select("user_a", "user_b", rnd(F.col("jaccard_score")).alias("jaccard_score"))


@query("batch_cosine", sql(["inter"], """select a.user_id user_a, b.user_id user_b,
    round(sum(a.interaction_score * b.interaction_score) / (na.nrm * nb.nrm), 6) cosine_score
    from nz a join nz b on a.target_user_id = b.target_user_id and a.user_id < b.user_id
    join norms na on na.user_id = a.user_id join norms nb on nb.user_id = b.user_id
    group by a.user_id, b.user_id, na.nrm, nb.nrm""", extra={
    "nz": "select * from inter where interaction_score <> 0",
    "norms": "select user_id, sqrt(sum(interaction_score * interaction_score)) nrm from nz group by user_id"}))
def q_batch_cosine(spark, sf):
    c = S.batch_cosine(_scores(Tables(spark, sf)))
    return c.select("user_a", "user_b", rnd(F.col("cosine_score")).alias("cosine_score"))


@query("strong_similar_pairs", sql(["strong"], """select user_a, user_b,
    round(jaccard_score, 6) jaccard_score from strong"""))
def q_strong(spark, sf):
    s = S.strong_jaccard(_scores(Tables(spark, sf)))
    return s.select("user_a", "user_b", rnd(F.col("jaccard_score")).alias("jaccard_score"))


# ------------------------------------------------------------- daily batch (M2)
_SPOT = ", ".join(str(u) for u in daily.SPOT_CHECK_USERS)


@query("strong_similar_top", sql(["strong"], """select user_a, user_b, round(jaccard_score, 6) jaccard_score
    from strong order by strong.jaccard_score desc, user_a, user_b limit 10000"""))
def q_strong_top(spark, sf):
    """The 10,000 best pairs above the threshold (the limit is the feature)."""
    s = S.strong_jaccard(_scores(Tables(spark, sf)), limit=10000)
    return s.select("user_a", "user_b", rnd(F.col("jaccard_score")).alias("jaccard_score"))


@query("spot_check", sql(["strong"], """select s.user_id, r.recommended_user,
    round(r.score, 6) score, cast(r.rk as integer) as rank from sample s left join r
    on s.user_id = r.user_id and r.rk <= 5""", extra={
    "sample": f"select cast(unnest([{_SPOT}]) as bigint) user_id",
    "r": """select user_a user_id, user_b recommended_user, jaccard_score score,
        row_number() over (partition by user_a order by jaccard_score desc, user_b) rk from strong"""}))
def q_spot_check(spark, sf):
    run = daily.run_daily(spark, _scores(Tables(spark, sf)))
    return run.spot_check.select("user_id", "recommended_user", rnd(F.col("score")).alias("score"), "rank")


@query("run_summary", sql(["inter", "strong"], """select 1 run_id,
    cast((select count(*) from inter) as integer) interaction_count,
    cast((select count(distinct user_id) from inter) as integer) unique_users,
    cast((select count(*) from strong) as integer) edges_refreshed"""))
def q_run_summary(spark, sf):
    run = daily.run_daily(spark, _scores(Tables(spark, sf)))
    return run.run_log.select("run_id", "interaction_count", "unique_users", "edges_refreshed")


@query("similarity_upsert", sql(["jac", "jac_follow"], """select user_a, user_b, round(jaccard_score, 6) jaccard_score
    from (select * from jac union all
          select * from jac_follow f where not exists
            (select 1 from jac n where n.user_a = f.user_a and n.user_b = f.user_b and n.jaccard_score is not null))
    where jaccard_score is not null"""))
def q_similarity_upsert(spark, sf):
    """The follow-only scores are the stored table, the full run upserts them."""
    t = Tables(spark, sf)
    old = S.batch_jaccard(_scores(t, follow_only=True))
    new = S.batch_jaccard(_scores(t))
    out = W.replacing_upsert(old, new, ["user_a", "user_b"])
    return out.select("user_a", "user_b", rnd(F.col("jaccard_score")).alias("jaccard_score"))


@query("similar_edges_refresh", sql(["strong", "strong_follow"], """select src, dst, round(jaccard_score, 6) jaccard_score
    from (select user_a src, user_b dst, jaccard_score from strong union all
          select user_a, user_b, jaccard_score from strong_follow f where not exists
            (select 1 from strong n where n.user_a = f.user_a and n.user_b = f.user_b))"""))
def q_similar_edges_refresh(spark, sf):
    """yesterday's SIMILAR_TO edges (follow-only run) refreshed by today's."""
    t = Tables(spark, sf)
    old = daily.similar_edges(S.strong_similar_pairs(S.batch_jaccard(_scores(t, follow_only=True))))
    # written once: its rows are returned and its keys are looked up
    new = materialize(daily.similar_edges(S.strong_similar_pairs(S.batch_jaccard(_scores(t)))), "similar-edges",
                      **daily.as_pairs("src", "dst"))
    out = W.replacing_upsert(old, new, ["src", "dst"])
    return out.select("src", "dst", rnd(F.col("jaccard_score")).alias("jaccard_score"))


# ---------------------------------------------------------------------- graph
from linkrec.operators import graph as G  # noqa: E402
from linkrec.operators import features as FT  # noqa: E402
from linkrec.operators import writes as WR  # noqa: E402,F811


def _vertices(t: Tables) -> DataFrame:
    return t.users().select(F.col("new_id").alias("id"))


@query("graph_project", sql(["gedges"], "select src, dst from gedges"))
def q_graph_project(spark, sf):
    return G.graph_project(Tables(spark, sf).follows())


@query("edges_known_users", sql(["follows", "users"], """select src, dst from follows
    where src in (select new_id from users) and dst in (select new_id from users)"""))
def q_edges_known_users(spark, sf):
    t = Tables(spark, sf)
    return G.known_edges(t.follows(), _vertices(t)).select("src", "dst")


@query("undirected_edges", sql(["und"], "select src, dst from und"))
def q_undirected_edges(spark, sf):
    t = Tables(spark, sf)
    return G.undirected(G.directed_graph(t.follows(), _vertices(t)))


@query("degrees", sql(["vtx", "kedges"], """select id,
    coalesce((select count(*) from kedges where dst = id), 0) in_degree,
    coalesce((select count(*) from kedges where src = id), 0) out_degree from vtx"""))
def q_degrees(spark, sf):
    t = Tables(spark, sf)
    v = _vertices(t)
    return G.degrees(G.directed_graph(t.follows(), v), v)


@query("undirected_degree", sql(["vtx", "nbr"], """select id, coalesce(n_nbrs, 0) n_nbrs,
    cast(coalesce(degree, 0) as bigint) degree from vtx left join nbr using (id)"""))
def q_undirected_degree(spark, sf):
    t = Tables(spark, sf)
    v = _vertices(t)
    return G.undirected_degree(G.undirected(G.directed_graph(t.follows(), v)), v)


@query("clustering", sql(["vtx", "und"], """select id, round(case when coalesce(d, 0) >= 2
    then 2.0 * coalesce(t, 0) / (d * (d - 1)) else 0.0 end, 6) clustering
    from vtx left join deg on deg.v = id left join tri on tri.v = id""", extra={
    "s": "select src, dst from und where src <> dst",
    "deg": "select src v, count(*) d from s group by src",
    "tri": """select e1.src v, count(*) t from s e1 join s e2 on e1.src = e2.src and e1.dst < e2.dst
        join s e3 on e3.src = e1.dst and e3.dst = e2.dst group by e1.src"""}))
def q_clustering(spark, sf):
    t = Tables(spark, sf)
    v = _vertices(t)
    c = G.clustering(G.undirected(G.directed_graph(t.follows(), v)), v)
    return c.select("id", rnd(F.col("clustering")).alias("clustering"))


@query("adjacency", sql(["follows"], """select src, count(*) n_list, count(distinct dst) n_set
    from follows group by src"""))
def q_adjacency(spark, sf):
    return G.adjacency_sizes(Tables(spark, sf).follows())


@query("node_similarity", sql(["nsim_top"], "select node1, node2, round(similarity, 6) similarity from nsim_top"))
def q_node_similarity(spark, sf):
    s = S.node_similarity(Tables(spark, sf).follows())
    return s.select("node1", "node2", rnd(F.col("similarity")).alias("similarity"))


@query("node_similarity_recs", sql(["nsim_top", "gedges"], """select node1 user_id, node2 recommended_user,
    round(similarity, 6) similarity, cast(r as integer) as rank from (select *, row_number() over
    (partition by node1 order by similarity desc, node2) r from nsim_top n
    where not exists (select 1 from gedges g where g.src = n.node1 and g.dst = n.node2)) where r <= 10"""))
def q_node_similarity_recs(spark, sf):
    r = S.node_similarity_recs(Tables(spark, sf).follows())
    return r.select("user_id", "recommended_user", rnd(F.col("similarity")).alias("similarity"), "rank")


@query("nodes_from_edges", sql(["follows", "users"], """select distinct new_id from
    (select src new_id from follows union all select dst from follows)
    where new_id not in (select new_id from users)"""))
def q_nodes_from_edges(spark, sf):
    t = Tables(spark, sf)
    return WR.nodes_from_edges(t.follows(), t.users())


# ------------------------------------------------------------------- features
@query("users_features", sql(["users", "user_games"], """select u.new_id, views, days, partner, mature,
    array_to_string(list_sort(list(game)), ',') features from users u join user_games g using (new_id)
    group by u.new_id, views, days, partner, mature"""))
def q_users_features(spark, sf):
    t = Tables(spark, sf)
    j = FT.users_with_features(t.users(), t.user_features())
    return j.select("new_id", "views", "days", "partner", "mature",
                    F.array_join("features", ",").alias("features"))


@query("minmax_scaled", sql(["base"], 'select new_id, round(views, 6) views, round(days, 6) as "days" from base'))
def q_minmax_scaled(spark, sf):
    t = Tables(spark, sf)
    u = t.users().join(t.user_games().select("new_id").distinct(), "new_id", "left_semi")
    b = FT.base_columns(u)
    return b.select("new_id", rnd(F.col("views")).alias("views"), rnd(F.col("days")).alias("days"))


@query("game_vocabulary", sql(["vocab"], "select game, game_idx from vocab"))
def q_game_vocabulary(spark, sf):
    return FT.game_vocabulary(Tables(spark, sf).user_games())


@query("multi_hot", sql(["hot"], "select new_id, game, game_idx from hot"))
def q_multi_hot(spark, sf):
    return FT.multi_hot(Tables(spark, sf).user_games()).select("new_id", "game", "game_idx")


@query("positional_features", sql(["user_games"], """select new_id, pos, coalesce(games[pos + 1], 0) value
    from (select new_id, list_sort(list(game)) games from user_games group by new_id) l,
    range(0, (select max(c) from (select count(*) c from user_games group by new_id))) r(pos)"""))
def q_positional_features(spark, sf):
    return FT.positional(Tables(spark, sf).user_features())


@query("feature_matrix", sql(["base", "hot"], """select h.new_id, round(coalesce(b.views, 0), 6) views,
    round(coalesce(b.days, 0), 6) as "days", cast(coalesce(b.partner, 0) as double) partner,
    cast(coalesce(b.mature, 0) as double) mature,
    array_to_string(list_sort(list(h.game_idx)), ',') games,
    cast((select count(*) from vocab) + 4 as integer) n_slots
    from hot h left join base b using (new_id)
    group by h.new_id, b.views, b.days, b.partner, b.mature"""))
def q_feature_matrix(spark, sf):
    t = Tables(spark, sf)
    fm = FT.feature_matrix(t.users(), t.user_games())
    return fm.select("new_id", rnd(F.col("views")).alias("views"), rnd(F.col("days")).alias("days"),
                     "partner", "mature", F.array_join("games", ",").alias("games"), "n_slots")


# ------------------------------------------------------------ sampling
from linkrec.operators import sampling as SM  # noqa: E402
from linkrec.operators import metrics as MT  # noqa: E402
from linkrec.operators import pairs as PF  # noqa: E402
from linkrec.plans.oracle_sql import h as _h, pair_topology_sql  # noqa: E402


@query("edge_split", sql(["split"], "select src, dst, is_test from split"))
def q_edge_split(spark, sf):
    return SM.edge_split(Tables(spark, sf).follows())


@query("edge_split_salted", sql(["split"], "select src, dst, is_test from split"))
def q_edge_split_salted(spark, sf):
    """I1 with hash-range buckets of 4 rows: the skew path gives the same split."""
    return SM.edge_split(Tables(spark, sf).follows(), hot=4)


def _known(t: Tables) -> DataFrame:
    return G.known_edges(t.follows(), _vertices(t))


@query("positive_samples", sql(["pos"], "select src, dst from pos"))
def q_positive_samples(spark, sf):
    return SM.positive_samples(_known(Tables(spark, sf)))


@query("negative_samples", sql(["neg"], "select draw, src, dst from neg"))
def q_negative_samples(spark, sf):
    t = Tables(spark, sf)
    return SM.negative_samples(spark, t.users(), t.follows())


# One block holds ceil(1024 / p) indices and its round 1024 + 12 * 32 + 32 draws (p = 0.001).
@query("bernoulli_pairs", sql(["vtx"], """select i pair_idx, a.id src, b.id dst from drawn
    join dx a on a.pos = drawn.i // (select n from sz) join dx b on b.pos = drawn.i % (select n from sz)
    where a.pos <> b.pos""", extra={
    "dx": "select id, row_number() over (order by id) - 1 pos from (select distinct id from vtx)",
    "sz": "select count(*) n from dx",
    "gaps": """select block, k, 1 + floor(ln((('0x' || substr(md5(block || '|' || k || '|42'), 1, 15))::BIGINT + 0.5)
        / 1152921504606846976.0::double) / ln(0.999::double)) gap
        from range(0, (select (n * n + 1023999) // 1024000 from sz)) b(block), range(0, 1440) r(k)""",
    "places": "select block, cast(sum(gap) over (partition by block order by k) as bigint) - 1 as place from gaps",
    "drawn": """select block * 1024000 + place i from places where place < 1024000
        and block * 1024000 + place < (select n * n from sz)"""}))
def q_bernoulli_pairs(spark, sf):
    """I7 over all ordered pairs of users, p = 0.001."""
    t = Tables(spark, sf)
    return SM.bernoulli_pairs(spark, t.users())


def _dataset(spark, t: Tables) -> DataFrame:
    """Labelled sample pairs (I2 + I3), written once and reused."""
    from linkrec.session import materialize as _mat
    pos = SM.positive_samples(_known(t)).select(F.col("src").alias("u"), F.col("dst").alias("v"),
                                                F.lit(1).alias("label"))
    neg = SM.negative_samples(spark, t.users(), t.follows()).select(
        F.col("src").alias("u"), F.col("dst").alias("v"), F.lit(0).alias("label"))
    return _mat(pos.unionByName(neg), "pair-sample")


@query("stratified_split", sql(["dataset"], f"""select u, v, label, rn <= ceil(0.2 * n) is_test from
    (select u, v, label, count(*) over (partition by label) n, row_number() over (partition by label
     order by {_h("u || '|' || v || '|42'")}, u || '|' || v) rn from dataset)"""))
def q_stratified_split(spark, sf):
    t = Tables(spark, sf)
    return SM.stratified_split(_dataset(spark, t), "label", ["u", "v"]).select("u", "v", "label", "is_test")


@query("candidates", sql(["cands"], "select user_id, candidate, j from cands"))
def q_candidates(spark, sf):
    return SM.candidates(Tables(spark, sf).users()).withColumn("j", F.col("j").cast("bigint"))


@query("exclude_followed", sql(["cands", "follows"], """select user_id, candidate from cands c
    where user_id <> candidate and not exists
      (select 1 from follows f where f.src = c.user_id and f.dst = c.candidate)"""))
def q_exclude_followed(spark, sf):
    t = Tables(spark, sf)
    return SM.exclude_followed(SM.candidates(t.users()), t.follows()).select("user_id", "candidate")


_RANKING_SQL = sql(["split"], f"""select round(avg(hits / 10.0), 6) precision_at_k,
    round(avg(case when n_rel > 0 then hits / n_rel else 0.0 end), 6) recall_at_k,
    round(avg(case when idcg > 0 then dcg / idcg else 0.0 end), 6) ndcg_at_k,
    round(avg(case when hits > 0 then 1.0 else 0.0 end), 6) hit_rate_at_k,
    count(*) users_evaluated from per""", extra={
    "trd": "select distinct src, dst from split where not is_test",
    "te": "select src user_id, dst item from split where is_test",
    "tsz": "select src, count(*) n from trd group by src",
    "nsim": """select node1, node2, c / (s1.n + s2.n - c) sim from
        (select a.src node1, b.src node2, count(*) c from trd a join trd b on a.dst = b.dst and a.src <> b.src
         group by a.src, b.src) p join tsz s1 on s1.src = p.node1 join tsz s2 on s2.src = p.node2""",
    "top": """select * from (select *, row_number() over (partition by node1 order by sim desc, node2) r
        from nsim) where r <= 10""",
    "recs": """select node1 user_id, node2 rec, row_number() over (partition by node1 order by sim desc, node2) rank
        from top t where not exists (select 1 from trd g where g.src = t.node1 and g.dst = t.node2)""",
    "eu": "select distinct user_id from te",
    "per": """select eu.user_id,
        (select count(*) from te where te.user_id = eu.user_id) n_rel,
        (select count(*) from recs r where r.user_id = eu.user_id and r.rank <= 10
            and r.rec in (select item from te where te.user_id = eu.user_id)) hits,
        (select coalesce(sum(1 / log2(r.rank + 1)), 0) from recs r where r.user_id = eu.user_id and r.rank <= 10
            and r.rec in (select item from te where te.user_id = eu.user_id)) dcg,
        (select coalesce(sum(1 / log2(i + 1)), 0) from range(1, least(10,
            (select count(*) from te where te.user_id = eu.user_id)) + 1) t(i)) idcg
        from eu"""})


@query("ranking_metrics", _RANKING_SQL)
def q_ranking_metrics(spark, sf):
    """K1-K5: node-similarity recommendations from the train edges, judged on
    the held-out edges of all test users, k = 10."""
    t = Tables(spark, sf)
    sp = SM.edge_split(t.follows())
    train = sp.where(~F.col("is_test")).select("src", "dst")
    test = sp.where(F.col("is_test")).select(F.col("src").alias("user_id"), F.col("dst").alias("item"))
    recs = S.node_similarity_recs(train)
    users = SM.sample_users(test, "user_id")
    m = MT.ranking_metrics(recs, test, users, k=10)
    return m.select(*[rnd(F.col(c)).alias(c) for c in ("precision_at_k", "recall_at_k", "ndcg_at_k", "hit_rate_at_k")],
                    "users_evaluated")


def _directed_graph(t: Tables):
    """The feature-matrix users and their follow edges, written once: the features read them many times over."""
    fm_users = t.users().join(t.user_games().select("new_id").distinct(), "new_id", "left_semi")
    v = materialize(fm_users.select(F.col("new_id").alias("id")), "pair-users")
    return v, materialize(G.directed_graph(t.follows(), v), "pair-directed")


def _pair_graph(t: Tables):
    v, directed = _directed_graph(t)
    return _pair_neighbours(v, directed)


def _pair_neighbours(v: DataFrame, directed: DataFrame):
    und = materialize(G.undirected(directed), "pair-und")
    return v, und, G.undirected_degree(und, v)


@query("binary_metrics", sql(["dataset", "fund", "fnbr"], """select
    round((select sum(pos * (coalesce(below, 0) + 0.5 * neg)) from asc_s) / ((select sum(pos) from bs) * (select sum(neg) from bs)), 6) auc,
    round((select sum(pos / (select sum(pos) from bs) * cp / (cp + cn)) from desc_s), 6) average_precision,
    round((select 2.0 * sum(case when score > 0.5 and label = 1 then 1 else 0 end) /
        (2 * sum(case when score > 0.5 and label = 1 then 1 else 0 end)
         + sum(case when score > 0.5 and label = 0 then 1 else 0 end)
         + sum(case when score <= 0.5 and label = 1 then 1 else 0 end)) from scored), 6) f1""", extra={
    "topo": pair_topology_sql("dataset"),
    "scored": "select d.label, t.jaccard score from dataset d join topo t on t.u = d.u and t.v = d.v",
    "bs": "select score s, sum(label) pos, sum(1 - label) neg from scored group by score",
    "asc_s": """select pos, neg, sum(neg) over (order by s rows between unbounded preceding and 1 preceding) below
        from bs""",
    "desc_s": """select pos, sum(pos) over (order by s desc rows between unbounded preceding and current row) cp,
        sum(neg) over (order by s desc rows between unbounded preceding and current row) cn from bs"""}))
def q_binary_metrics(spark, sf):
    """J7-J9 for the neighbour-Jaccard link predictor on the pair dataset."""
    t = Tables(spark, sf)
    v, und, udeg = _pair_graph(t)
    ds = _dataset(spark, t)
    topo = PF.topology(ds, und, udeg)
    scored = ds.join(topo, ["u", "v"]).select("label", F.col("jaccard").alias("score"))
    m = MT.binary_metrics(scored)
    return m.select(*[rnd(F.col(c)).alias(c) for c in ("auc", "average_precision", "f1")])


_PF13 = ["common_neighbors", "jaccard", "adamic_adar", "content_cosine",
         "in_degree_u", "in_degree_v", "in_degree_diff", "out_degree_u", "out_degree_v", "out_degree_diff",
         "clustering_u", "clustering_v", "clustering_diff"]


@query("pair_features", sql(["dataset", "fund", "fnbr", "fvec", "fkedges", "fusers"], """select d.u, d.v, d.label,
    cast(t.common_neighbors as double) common_neighbors, round(t.jaccard, 6) jaccard,
    round(t.adamic_adar, 6) adamic_adar, round(cc.content_cosine, 6) content_cosine,
    cast(coalesce(iu.ind, 0) as double) in_degree_u, cast(coalesce(iv.ind, 0) as double) in_degree_v,
    cast(abs(coalesce(iu.ind, 0) - coalesce(iv.ind, 0)) as double) in_degree_diff,
    cast(coalesce(ou.outd, 0) as double) out_degree_u, cast(coalesce(ov.outd, 0) as double) out_degree_v,
    cast(abs(coalesce(ou.outd, 0) - coalesce(ov.outd, 0)) as double) out_degree_diff,
    round(coalesce(cu.cl, 0), 6) clustering_u, round(coalesce(cv.cl, 0), 6) clustering_v,
    round(abs(coalesce(cu.cl, 0) - coalesce(cv.cl, 0)), 6) clustering_diff
    from dataset d
    join (select new_id from fusers) ku on ku.new_id = d.u join (select new_id from fusers) kv on kv.new_id = d.v
    join topo t on t.u = d.u and t.v = d.v
    join cc on cc.u = d.u and cc.v = d.v
    left join (select dst id, count(*) ind from fkedges group by dst) iu on iu.id = d.u
    left join (select dst id, count(*) ind from fkedges group by dst) iv on iv.id = d.v
    left join (select src id, count(*) outd from fkedges group by src) ou on ou.id = d.u
    left join (select src id, count(*) outd from fkedges group by src) ov on ov.id = d.v
    left join clus cu on cu.id = d.u left join clus cv on cv.id = d.v""", extra={
    "topo": pair_topology_sql("dataset"),
    "cc": """select p.u, p.v, case when a.nrm * b.nrm > 0 then
        (a.views * b.views + a.days * b.days + a.partner * b.partner + a.mature * b.mature
         + len(list_intersect(a.games, b.games))) / (a.nrm * b.nrm) else 0.0 end content_cosine
        from (select distinct u, v from dataset) p join fvec a on a.new_id = p.u join fvec b on b.new_id = p.v""",
    "s": "select src, dst from fund where src <> dst",
    "sdeg": "select src v, count(*) d from s group by src",
    "tri": """select e1.src v, count(*) t from s e1 join s e2 on e1.src = e2.src and e1.dst < e2.dst
        join s e3 on e3.src = e1.dst and e3.dst = e2.dst group by e1.src""",
    "clus": """select sdeg.v id, case when d >= 2 then 2.0 * coalesce(t, 0) / (d * (d - 1)) else 0.0 end cl
        from sdeg left join tri using (v)"""}))
def q_pair_features(spark, sf):
    """G13-G16 without the svd / PageRank / community columns (those have golden tests)."""
    t = Tables(spark, sf)
    _, directed = graph = _directed_graph(t)
    v, und, udeg = _pair_neighbours(*graph)
    nodes = G.degrees(directed, v).join(G.clustering(und, v), "id").withColumn(
        "pagerank", F.lit(0.0)).withColumn("community", F.lit(None).cast("long"))
    fm = materialize(FT.feature_matrix(t.users(), t.user_games()), "pair-features")
    pf = PF.pair_features(_dataset(spark, t), und, udeg, nodes, fm=fm)
    return pf.select("u", "v", "label", "common_neighbors",
                     *[rnd(F.col(c)).alias(c) for c in ("jaccard", "adamic_adar", "content_cosine")],
                     "in_degree_u", "in_degree_v", "in_degree_diff", "out_degree_u", "out_degree_v",
                     "out_degree_diff",
                     *[rnd(F.col(c)).alias(c) for c in ("clustering_u", "clustering_v", "clustering_diff")])


@query("pair_content_cosine", sql(["dataset", "fvec"], """select p.u, p.v, round(case when a.nrm * b.nrm > 0 then
    (a.views * b.views + a.days * b.days + a.partner * b.partner + a.mature * b.mature
     + len(list_intersect(a.games, b.games))) / (a.nrm * b.nrm) else 0.0 end, 6) content_cosine
    from (select distinct u, v from dataset) p join fvec a on a.new_id = p.u join fvec b on b.new_id = p.v"""))
def q_pair_content_cosine(spark, sf):
    t = Tables(spark, sf)
    fm = FT.feature_matrix(t.users(), t.user_games())
    c = PF.pair_content_cosine(_dataset(spark, t), fm)
    return c.select("u", "v", rnd(F.col("content_cosine")).alias("content_cosine"))


# ------------------------------------------------------ PageRank, communities
from linkrec.operators import pagerank as PRK  # noqa: E402
from linkrec.operators import communities as CM  # noqa: E402


def _graph(t: Tables):
    v = _vertices(t)
    d = G.directed_graph(t.follows(), v)
    return v, d


@query("pagerank_unnormalised", sql(["vtx", "kedges"], """select id, round(r, 6) pagerank from pr where it = 20""",
                                    extra={}).replace("with ", "with recursive ", 1).replace(
    "\nselect id, round(r, 6) pagerank from pr where it = 20", """,
od as (select src, count(*) d from kedges group by src),
pr(id, r, it) as (
  select id, 0.15::double, 0 from vtx
  union all
  select vtx.id, 0.15 + 0.85 * coalesce(sum(z.c), 0), (select max(it) from pr) + 1
  from vtx left join (select kedges.dst, p.r / od.d c from pr p join kedges on kedges.src = p.id
                      join od on od.src = p.id) z on z.dst = vtx.id
  where (select max(it) from pr) < 20
  group by vtx.id)
select id, round(r, 6) pagerank from pr where it = 20"""))
def q_pagerank_unnormalised(spark, sf):
    v, d = _graph(Tables(spark, sf))
    pr = PRK.pagerank_unnormalised(v, d)
    return pr.select("id", rnd(F.col("pagerank")).alias("pagerank"))


@query("pagerank_normalised")
def q_pagerank_normalised(spark, sf):
    v, d = _graph(Tables(spark, sf))
    return PRK.pagerank_normalised(v, d)


@query("communities")
def q_communities(spark, sf):
    """G8 Louvain on the undirected user graph (labels are arbitrary ids)."""
    v, d = _graph(Tables(spark, sf))
    return CM.louvain(v, G.undirected(d))


@query("communities_lpa")
def q_communities_lpa(spark, sf):
    v, d = _graph(Tables(spark, sf))
    return CM.label_propagation(v, G.undirected(d))


@query("community_sizes")
def q_community_sizes(spark, sf):
    v, d = _graph(Tables(spark, sf))
    return CM.community_sizes(CM.louvain(v, G.undirected(d)))


@query("modularity")
def q_modularity(spark, sf):
    v, d = _graph(Tables(spark, sf))
    und = materialize(G.undirected(d), "und")               # read by Louvain and twice by the modularity
    return CM.modularity(und, CM.louvain(v, und))


# ------------------------------------------------------------------ streaming
from linkrec.session import scratch_path  # noqa: E402
from linkrec.streaming import scores as ST  # noqa: E402


def _stream_run(spark, sf, with_users: bool):
    """Write the events table as JSON-lines files (4 of them -> 4 micro-batches),
    run the scoring stream to completion, return the sink."""
    t = Tables(spark, sf)
    src = scratch_path(spark, "events-json")
    ST.events_as_json(t.events()).repartition(4).write.mode("overwrite").text(src)
    raw = ST.json_file_source(spark, src, files_per_trigger=1)
    out = scratch_path(spark, "stream-out")
    sink, _ = ST.run_score_stream(spark, raw, out, scratch_path(spark, "stream-ckpt"),
                                  users=t.users() if with_users else None)
    return sink


@query("stream_decode", sql(["ev"], "select user_id, action, target_user_id from ev"))
def q_stream_decode(spark, sf):
    t = Tables(spark, sf)
    src = scratch_path(spark, "events-json")
    ST.events_as_json(t.events()).repartition(4).write.mode("overwrite").text(src)
    out = scratch_path(spark, "decoded")
    q = (ST.decode(ST.json_file_source(spark, src)).where(~F.col("_bad"))
         .select("user_id", "action", "target_user_id")
         .writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "decode-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@query("stream_interaction_scores", sql(["inter"], "select user_id, target_user_id, interaction_score from inter"))
def q_stream_interaction_scores(spark, sf):
    sink = _stream_run(spark, sf, with_users=False)
    return sink.scores.current().select("user_id", "target_user_id", "interaction_score")


@query("interaction_edges", sql(["inter", "users"], """select user_id src, target_user_id dst, interaction_score weight
    from inter where user_id in (select new_id from users) and target_user_id in (select new_id from users)"""))
def q_interaction_edges(spark, sf):
    sink = _stream_run(spark, sf, with_users=True)
    return sink.edges.current().select("src", "dst", "weight")


# ------------------------------------------- content, SVD, hybrid
from linkrec.operators import hybrid as HY  # noqa: E402
from linkrec.operators import factorize as FZ  # noqa: E402
from linkrec.plans.oracle_sql import hybrid_sql  # noqa: E402


def _fm_users(t: Tables) -> DataFrame:
    return t.users().join(t.user_games().select("new_id").distinct(), "new_id", "left_semi")


def _content(t: Tables, games: DataFrame | None = None):
    # read several times each: written once instead of joined from the order lines again
    games = materialize(t.user_games(), "games") if games is None else games
    return HY.content_rows(materialize(FT.feature_matrix(t.users(), games), "feature-matrix"))


def _train_edges(t: Tables) -> DataFrame:
    return SM.edge_split(t.follows()).where(~F.col("is_test")).select("src", "dst")


@query("content_topk", sql(["fcos"], """select u user_id, v recommended_user, round(c, 6) score, cast(rk as integer) as rank from
    (select u, v, c, row_number() over (partition by u order by c desc, v) rk from fcos where u <> v)
    where rk <= 10"""))
def q_content_topk(spark, sf):
    c, width = _content(Tables(spark, sf))
    r = HY.content_topk(c, width, k=10)
    return r.select("user_id", "recommended_user", rnd(F.col("score")).alias("score"), "rank")


@query("content_topk_positional", sql(["pcos"], """select u user_id, v recommended_user, round(c, 6) score,
    cast(rk as integer) as rank from
    (select u, v, c, row_number() over (partition by u order by c desc, v) rk from pcos where u <> v)
    where rk <= 10"""))
def q_content_topk_positional(spark, sf):
    """H4 on the positional matrix (H3): best 10 users by the cosine of base columns and game lists as magnitudes."""
    t = Tables(spark, sf)
    c, width = HY.content_rows(FT.positional_matrix(t.users(), t.user_features()))
    r = HY.content_topk(c, width, k=10)
    return r.select("user_id", "recommended_user", rnd(F.col("score")).alias("score"), "rank")


@query("content_recs", sql(["fcos", "trn"], """select u user_id, v recommended_user, round(c, 6) score, cast(rk as integer) as rank from
    (select u, v, c, row_number() over (partition by u order by c desc, v) rk from fcos f
     where u <> v and not exists (select 1 from trn t where t.src = f.u and t.dst = f.v))
    where rk <= 10"""))
def q_content_recs(spark, sf):
    t = Tables(spark, sf)
    c, width = _content(t)
    r = HY.content_topk(c, width, k=10, exclude=_train_edges(t))
    return r.select("user_id", "recommended_user", rnd(F.col("score")).alias("score"), "rank")


def _stand_in(t: Tables, train: DataFrame):
    games = materialize(t.user_games(), "games")
    c, width = _content(t, games)
    users = t.users().join(games.select("new_id").distinct(), "new_id", "left_semi")
    rows, fw = HY.common_follow_rows(train, users)
    return c, width, materialize(rows, "follow-rows"), fw


@query("hybrid_scores", sql(["allp", "umm", "trn"], """select u user_id, v recommended_user, round(score, 6) score,
    cast(rk as integer) as rank from h where rk <= 10""", extra={"h": hybrid_sql("[0.5]")}))
def q_hybrid_scores(spark, sf):
    """H11 with the multi-hot cosine and the untruncated A Aᵀ (common follows)
    as the two scores, alpha = 0.5, train follows excluded."""
    t = Tables(spark, sf)
    train = materialize(_train_edges(t), "train")
    c, width, rows, fw = _stand_in(t, train)
    r = HY.hybrid_recs(c, width, rows, rows, fw, alphas=(0.5,), k=10, exclude=train)
    return r.select("user_id", "recommended_user", rnd(F.col("score")).alias("score"), "rank")


@query("recs_save", sql(["allp", "umm", "trn"], """select u user_id, v recommended_user, cast(rk as integer) as rank
    from h where rk <= 10""", extra={"h": hybrid_sql("[0.0]")}))
def q_recs_save(spark, sf):
    """H13 + A14: recommendations for every user (alpha 0), saved one row per
    (user, recommended user) with its rank."""
    t = Tables(spark, sf)
    train = materialize(_train_edges(t), "train")
    c, width, rows, fw = _stand_in(t, train)
    r = HY.hybrid_recs(c, width, rows, rows, fw, alphas=(0.0,), k=10, exclude=train)
    saved = WR.truncate_and_load(r.select("user_id", "recommended_user", "rank"),
                                 ["user_id", "recommended_user"], [F.col("rank")])
    return saved


@query("alpha_sweep", sql(["allp", "umm", "trn", "split"], """select alpha,
    round(avg(hits / 10.0), 6) precision_at_k,
    round(avg(case when n_rel > 0 then hits / n_rel else 0.0 end), 6) recall_at_k,
    round(avg(case when idcg > 0 then dcg / idcg else 0.0 end), 6) ndcg_at_k,
    round(avg(case when hits > 0 then 1.0 else 0.0 end), 6) hit_rate_at_k,
    count(*) users_evaluated
    from (select a.alpha, eu.user_id,
            (select count(*) from te where te.user_id = eu.user_id) n_rel,
            (select count(*) from h where h.alpha = a.alpha and h.u = eu.user_id and h.rk <= 10
                and h.v in (select item from te where te.user_id = eu.user_id)) hits,
            (select coalesce(sum(1 / log2(h.rk + 1)), 0) from h where h.alpha = a.alpha and h.u = eu.user_id
                and h.rk <= 10 and h.v in (select item from te where te.user_id = eu.user_id)) dcg,
            (select coalesce(sum(1 / log2(i + 1)), 0) from range(1, least(10,
                (select count(*) from te where te.user_id = eu.user_id)) + 1) t(i)) idcg
          from eu cross join (select unnest(cast([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0] as double[])) alpha) a)
    group by alpha""", extra={
    "te": "select src user_id, dst item from split where is_test",
    "eu": "select distinct user_id from te",
    "h": hybrid_sql("[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]")}))
def q_alpha_sweep(spark, sf):
    """H12 + K5: 11 alphas scored in one block pass for all test users, each evaluated with
    precision / recall / NDCG / hit rate at 10."""
    t = Tables(spark, sf)
    sp = materialize(SM.edge_split(t.follows()), "split")
    test = sp.where(F.col("is_test")).select(F.col("src").alias("user_id"), F.col("dst").alias("item"))
    train = sp.where(~F.col("is_test")).select("src", "dst")
    c, width, rows, fw = _stand_in(t, train)
    m = HY.alpha_sweep(c, width, rows, rows, fw, test, train)
    return m.select("alpha", *[rnd(F.col(c)).alias(c) for c in ("precision_at_k", "recall_at_k", "ndcg_at_k",
                                                              "hit_rate_at_k")], "users_evaluated")


@query("svd_embeddings")
def q_svd_embeddings(spark, sf):
    """H7 (link-prediction form): 32 factors of the full known follow graph; U Σ rows."""
    t = Tables(spark, sf)
    users = _fm_users(t)
    f = HY.svd_factors(t.follows(), users, k=32)
    return f.left.select(F.col("id").alias("new_id"), F.col("f_val").alias("embedding"))


@query("svd_scores")
def q_svd_scores(spark, sf):
    """H8: per user the 10 largest entries of the reconstructed row (U Σ Vᵀ)[u]."""
    t = Tables(spark, sf)
    c, width = _content(t)
    f = HY.svd_factors(_train_edges(t), _fm_users(t), k=HY.N_FACTORS)
    return HY.svd_recs(c, width, f, k=10)


@query("svd_recs")
def q_svd_recs(spark, sf):
    """H9: SVD recommendations, self and train follows skipped."""
    t = Tables(spark, sf)
    c, width = _content(t)
    tr = _train_edges(t)
    f = HY.svd_factors(tr, _fm_users(t), k=HY.N_FACTORS)
    return HY.svd_recs(c, width, f, k=10, exclude=tr)


@query("hybrid_recs")
def q_hybrid_recs(spark, sf):
    """H11/H13 as in the similarity job: content + SVD, alpha = 0."""
    t = Tables(spark, sf)
    c, width = _content(t)
    tr = _train_edges(t)
    f = HY.svd_factors(tr, _fm_users(t), k=HY.N_FACTORS)
    r = HY.hybrid_recs(c, width, f.left, f.right, f.width, alphas=(0.0,), k=10, exclude=tr)
    return r.select("user_id", "recommended_user", "score", "rank")


@query("pair_svd_dot")
def q_pair_svd_dot(spark, sf):
    """Dot of the two users' U Σ rows for the pair dataset."""
    t = Tables(spark, sf)
    f = HY.svd_factors(t.follows(), _fm_users(t), k=32)
    emb = f.left.select("id", F.col("f_val").alias("emb"))
    ds = _dataset(spark, t).select("u", "v").distinct()
    eu = emb.select(F.col("id").alias("u"), F.col("emb").alias("_eu"))
    ev = emb.select(F.col("id").alias("v"), F.col("emb").alias("_ev"))
    return ds.join(eu, "u").join(ev, "v").select("u", "v", PF.dense_dot(F.col("_eu"), F.col("_ev")).alias("svd_dot"))


# ------------------------------------------------------- models
from linkrec.operators import models as MD  # noqa: E402
from linkrec.plans.link_prediction import LinkPrediction  # noqa: E402


def _lp(spark, sf, **kw) -> LinkPrediction:
    t = Tables(spark, sf)
    return LinkPrediction(spark, t.users(), t.user_games(), t.follows(), **kw)


@query("pair_dataset")
def q_pair_dataset(spark, sf):
    """5,000 positive + 5,000 negative pairs with all 18 features."""
    lp = _lp(spark, sf)
    return lp.dataset.select("u", "v", "label", "is_test", *PF.FEATURE_NAMES)


_TOPO3 = ["common_neighbors", "jaccard", "adamic_adar"]


@query("standardised", sql(["dataset", "fund", "fnbr"], f"""select u, v, label, is_test,
    round((common_neighbors - (select avg(common_neighbors) from tr)) /
          coalesce(nullif((select stddev_pop(common_neighbors) from tr), 0), 1), 6) common_neighbors,
    round((jaccard - (select avg(jaccard) from tr)) /
          coalesce(nullif((select stddev_pop(jaccard) from tr), 0), 1), 6) jaccard,
    round((adamic_adar - (select avg(adamic_adar) from tr)) /
          coalesce(nullif((select stddev_pop(adamic_adar) from tr), 0), 1), 6) adamic_adar
    from sp""", extra={
    "topo": pair_topology_sql("dataset"),
    "feat": """select d.u, d.v, d.label, cast(t.common_neighbors as double) common_neighbors, t.jaccard, t.adamic_adar
        from dataset d join topo t on t.u = d.u and t.v = d.v""",
    "sp": f"""select *, rn <= ceil(0.2 * n) is_test from (select *, count(*) over (partition by label) n,
        row_number() over (partition by label order by {_h("u || '|' || v || '|42'")}, u || '|' || v) rn from feat)""",
    "tr": "select * from sp where not is_test"}))
def q_standardised(spark, sf):
    """Topology features standardised with the train split's mean and
    population sd, applied to both splits."""
    t = Tables(spark, sf)
    v, und, udeg = _pair_graph(t)
    ds = _dataset(spark, t)
    feat = ds.join(PF.topology(ds, und, udeg), ["u", "v"]).withColumn(
        "common_neighbors", F.col("common_neighbors").cast("double"))
    sp = SM.stratified_split(feat, "label", ["u", "v"])
    tr, (te,) = MD.standardise(sp.where(~F.col("is_test")), [sp.where(F.col("is_test"))], _TOPO3)
    out = tr.unionByName(te)
    return out.select("u", "v", "label", "is_test", *[rnd(F.col(c)).alias(c) for c in _TOPO3])


@query("link_lr")
def q_link_lr(spark, sf):
    return _lp(spark, sf).logistic[1]


@query("link_gbt")
def q_link_gbt(spark, sf):
    return _lp(spark, sf).boosted[1]


@query("link_sage")
def q_link_sage(spark, sf):
    return _lp(spark, sf).sage[1]


@query("best_model")
def q_best_model(spark, sf):
    return _lp(spark, sf).best()


@query("ml_recs")
def q_ml_recs(spark, sf):
    """H14 for every user: 200 candidates, boosted-tree scores, top 10, saved."""
    return _lp(spark, sf).saved_recommendations()


@query("sage_mean_agg", sql(["base", "fkedges"], """select id, cast(pos as bigint) pos, round(value, 6) value from (
    select new_id id, 0 pos, views value from base union all select new_id, 1, days from base
    union all select new_id, 2, partner from base union all select new_id, 3, mature from base
    union all select b.new_id, 4, coalesce(m.v0, 0) from base b left join m on m.dst = b.new_id
    union all select b.new_id, 5, coalesce(m.v1, 0) from base b left join m on m.dst = b.new_id
    union all select b.new_id, 6, coalesce(m.v2, 0) from base b left join m on m.dst = b.new_id
    union all select b.new_id, 7, coalesce(m.v3, 0) from base b left join m on m.dst = b.new_id)""", extra={
    "m": """select e.dst, avg(s.views) v0, avg(s.days) v1, avg(s.partner) v2, avg(s.mature) v3
        from fkedges e join base s on s.new_id = e.src group by e.dst"""}))
def q_sage_mean_agg(spark, sf):
    """J6, one hop: base features concatenated with the mean over in-neighbours."""
    t = Tables(spark, sf)
    fm = FT.feature_matrix(t.users(), t.user_games())
    v = fm.select(F.col("new_id").alias("id"))
    d = G.directed_graph(t.follows(), v)
    z0 = fm.select(F.col("new_id").alias("id"), F.array("views", "days", "partner", "mature").alias("z"))
    z = MD.sage_mean_aggregate(z0, d, hops=1)
    return z.select("id", F.posexplode("z").alias("pos", "value")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), rnd(F.col("value")).alias("value"))


# ------------------------------------------------ sources and keyed writes (A, B)
from linkrec.functions.exprs import parse_int_list  # noqa: E402
from linkrec.sources import files as FS  # noqa: E402


def _users_csv_text(t: Tables) -> DataFrame:
    """users as the loaders' CSV text, with mixed-case boolean spellings."""
    c = t.raw("customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").cast("string").alias("days"),
        F.when(F.col("c_acctbal") < 0, F.lit("True")).otherwise(F.lit("false")).alias("mature"),
        F.floor("c_acctbal").cast("string").alias("views"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("TRUE")).otherwise(F.lit("False")).alias("partner"),
        F.col("c_custkey").cast("string").alias("new_id"))


_USERS_SCAN_SQL = """select c_custkey new_id, c_custkey ids, c_nationkey as "days", c_acctbal < 0 mature,
    cast(floor(c_acctbal) as integer) views, c_mktsegment = 'BUILDING' partner from customer"""


@query("users_scan", _USERS_SCAN_SQL)
def q_users_scan(spark, sf):
    """A2 + B1/B3: CSV written from customer, read back with the strict rules."""
    t = Tables(spark, sf)
    p = scratch_path(spark, "users-csv")
    _users_csv_text(t).write.option("header", True).csv(p)
    return FS.read_users_csv(spark, p)


@query("users_scan_lenient", _USERS_SCAN_SQL)
def q_users_scan_lenient(spark, sf):
    """A2 + B2/B4: the graph loader's lenient parse of the same CSV."""
    t = Tables(spark, sf)
    p = scratch_path(spark, "users-csv")
    _users_csv_text(t).write.option("header", True).csv(p)
    return FS.read_users_csv(spark, p, lenient=True)


@query("edges_scan", sql(["follows"], "select src, dst from follows"))
def q_edges_scan(spark, sf):
    """A3: follow edges written as header CSV ``from,to`` and read back."""
    t = Tables(spark, sf)
    p = scratch_path(spark, "edges-csv")
    t.follows().select(F.col("src").cast("string").alias("from"), F.col("dst").cast("string").alias("to")) \
        .write.option("header", True).csv(p)
    return FS.read_edges_csv(spark, p)


@query("features_scan", sql(["user_games"], "select new_id, game from user_games"))
def q_features_scan(spark, sf):
    """A1 (splittable JSON-lines form): feature lists written as JSON, read back long."""
    t = Tables(spark, sf)
    p = scratch_path(spark, "features-json")
    t.user_features().write.json(p)
    return FS.read_feature_lines(spark, p)


@query("feature_map_scan", sql(["user_games"], "select new_id, game from user_games"))
def q_feature_map_scan(spark, sf):
    """A1 (the loader's own form): one JSON object of all feature lists, read in many tasks."""
    p = scratch_path(spark, "feature-map")
    FS.write_feature_map(Tables(spark, sf).user_features(), p)
    return FS.read_feature_map(spark, p)


@query("json_roundtrip", sql(["user_games"], """select new_id, cast(to_json(list_sort(list(game))) as varchar) features_json,
    len(list(game)) n_features from user_games group by new_id"""))
def q_json_roundtrip(spark, sf):
    """B6 + B7: lists encoded as JSON text and decoded again (NULL / bad -> [])."""
    j = FS.features_to_json(Tables(spark, sf).user_features())
    return j.select("new_id", "features_json",
                    F.size(parse_int_list(F.col("features_json"))).cast("bigint").alias("n_features"))


@query("pk_violations", sql(["follows"], "select src, dst, count(*) n from follows group by src, dst having count(*) > 1"))
def q_pk_violations(spark, sf):
    """Keys of the follow list that occur more than once."""
    return WR.pk_violations(Tables(spark, sf).follows(), ["src", "dst"])


@query("insert_first_wins", sql(["users"], """select new_id, views from users where partner
    union all select new_id, views from users where not partner"""))
def q_insert_first_wins(spark, sf):
    """The BUILDING users are already stored; every user row arrives twice
    (original, then with views + 1): the stored row and the first copy win."""
    t = Tables(spark, sf)
    u = t.users().select("new_id", "views", "partner")
    target = u.where("partner").select("new_id", "views")
    new = (u.select("new_id", "views", F.lit(0).alias("_ord"))
           .unionByName(u.select("new_id", (F.col("views") + 1).alias("views"), F.lit(1).alias("_ord"))))
    return W.insert_first_wins(target, new, ["new_id"], "_ord")


@query("upsert_last_wins", sql(["users", "follows"], """select coalesce(n.new_id, u.new_id) new_id,
    u.views + 1 views, u."days" as "days" from (select distinct new_id from
      (select src new_id from follows union all select dst from follows)) n
    full outer join users u on u.new_id = n.new_id"""))
def q_upsert_last_wins(spark, sf):
    """Nodes created from edge endpoints (no properties) are MERGEd with
    the user rows; each user arrives twice and the last copy (views + 1) wins."""
    t = Tables(spark, sf)
    ends = WR.nodes_from_edges(t.follows(), t.users().limit(0).select("new_id"))
    target = ends.select("new_id", F.lit(None).cast("double").alias("views"), F.lit(None).cast("bigint").alias("days"))
    u = t.users().select("new_id", "views", "days")
    new = (u.withColumn("_ord", F.lit(0))
           .unionByName(u.withColumn("views", F.col("views") + 1).withColumn("_ord", F.lit(1))))
    return W.upsert_last_wins(target, new, ["new_id"], "_ord", ["views", "days"])


# --------------------------------------------------------- similarity job (M3)
from linkrec.plans.similarity_job import run_similarity  # noqa: E402


@query("similarity_eval")
def q_similarity_eval(spark, sf):
    """M3 / K5: hybrid (content + SVD, alpha 0) recommendations evaluated on
    all test users at k = 10."""
    t = Tables(spark, sf)
    run = run_similarity(spark, t.users(), t.user_games(), t.follows())
    return run.metrics


@query("similarity_recs_saved")
def q_similarity_recs_saved(spark, sf):
    """The saved hybrid recommendation table for every user."""
    t = Tables(spark, sf)
    return run_similarity(spark, t.users(), t.user_games(), t.follows()).recommendations
