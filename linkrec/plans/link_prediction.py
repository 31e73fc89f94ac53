"""M4: the link-prediction job -- graph features, pair dataset, three models,
comparison and scored recommendations for all users.  Built as one object so
the expensive node features are computed once (written to the shared
checkpoint folder) and reused by every step."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrec.operators import communities as CM
from linkrec.operators import features as FT
from linkrec.operators import graph as G
from linkrec.operators import hybrid as HY
from linkrec.operators import models as MD
from linkrec.operators import pagerank as PR
from linkrec.operators import pairs as PF
from linkrec.operators import sampling as SM
from linkrec.operators import writes as WR
from linkrec.operators.metrics import best_model
from linkrec.operators.topk import top_k_per
from linkrec.session import materialize

N_SAMPLES = 5000
N_FACTORS = 32
TOP_K = 10
CANDIDATE_POOL = 200


class LinkPrediction:
    def __init__(self, spark: SparkSession, users: DataFrame, user_games: DataFrame, follows: DataFrame,
                 n_trees: int = 300, pagerank_mode: str = "unnormalised", community_mode: str = "louvain"):
        self.spark = spark
        self.users = users
        self._user_games = user_games
        self._follows = follows
        self.n_trees = n_trees
        self.pagerank_mode = pagerank_mode
        self.community_mode = community_mode

    # ------------------------------------------------------------ graph side
    # both come from joins of large tables and are read many times
    @cached_property
    def user_games(self) -> DataFrame:
        return materialize(self._user_games, "lp-games")

    @cached_property
    def follows(self) -> DataFrame:
        return materialize(self._follows, "lp-follows")

    @cached_property
    def fm(self) -> DataFrame:
        return materialize(FT.feature_matrix(self.users, self.user_games), "lp-fm")

    @cached_property
    def vertices(self) -> DataFrame:
        return self.fm.select(F.col("new_id").alias("id"))

    @cached_property
    def directed(self) -> DataFrame:
        return materialize(G.directed_graph(self.follows, self.vertices), "lp-directed")

    @cached_property
    def und(self) -> DataFrame:
        return materialize(G.undirected(self.directed), "lp-und")

    @cached_property
    def nodes(self) -> DataFrame:
        """Per-user graph features: PageRank, degrees, clustering, community."""
        v = self.vertices
        pr = (PR.pagerank_unnormalised(v, self.directed) if self.pagerank_mode == "unnormalised"
              else PR.pagerank_normalised(v, self.directed))
        com = (CM.louvain(v, self.und) if self.community_mode == "louvain"
               else CM.label_propagation(v, self.und))
        n = (G.degrees(self.directed, v).join(G.clustering(self.und, v), "id")
             .join(pr, "id", "left").join(com, "id", "left"))
        return materialize(n, "lp-nodes")

    @cached_property
    def udeg(self) -> DataFrame:
        return materialize(G.undirected_degree(self.und, self.vertices), "lp-udeg")

    @cached_property
    def embeddings(self) -> DataFrame:
        """U Σ rows (id, emb) of the SVD of the full known follow graph."""
        f = HY.svd_factors(self.follows, self.fm.select("new_id"), k=N_FACTORS)
        return materialize(f.left.select("id", F.col("f_val").alias("emb")), "lp-emb")

    # ---------------------------------------------------------------- dataset
    def features_for(self, pairs: DataFrame) -> DataFrame:
        return PF.pair_features(pairs, self.und, self.udeg, self.nodes, fm=self.fm, emb=self.embeddings)

    @cached_property
    def dataset(self) -> DataFrame:
        """Positives then negatives with the 18 features; pair features
        see the full graph (as the reference)."""
        known = G.known_edges(self.follows, self.vertices)
        pos = SM.positive_samples(known, N_SAMPLES).select(F.col("src").alias("u"), F.col("dst").alias("v"),
                                                           F.lit(1).alias("label"))
        neg = SM.negative_samples(self.spark, self.fm.select("new_id"), self.follows, N_SAMPLES).select(
            F.col("src").alias("u"), F.col("dst").alias("v"), F.lit(0).alias("label"))
        ds = self.features_for(pos.unionByName(neg))
        return materialize(SM.stratified_split(ds, "label", ["u", "v"]), "lp-dataset")

    def _split(self):
        ds = MD.assemble(self.dataset)
        return ds.where(~F.col("is_test")), ds.where(F.col("is_test"))

    # ----------------------------------------------------------------- models
    @cached_property
    def logistic(self):
        train, test = self._split()
        cols = PF.FEATURE_NAMES
        tr, (te,) = MD.standardise(self.dataset.where(~F.col("is_test")), [self.dataset.where(F.col("is_test"))], cols)
        tr, te = MD.assemble(tr), MD.assemble(te)
        model = MD.fit_logistic(tr)
        return model, MD.evaluate("logistic_regression", MD.score(model, te))

    @cached_property
    def boosted(self):
        train, test = self._split()
        model = MD.fit_gbt(train, n_trees=self.n_trees)
        return model, MD.evaluate("boosted_trees", MD.score(model, test))

    @cached_property
    def sage(self):
        """Three mean-aggregation hops over [SVD U Σ (+) views, days,
        partner, mature], Hadamard pair features, logistic head."""
        base = (self.fm.select(F.col("new_id").alias("id"),
                               F.array("views", "days", "partner", "mature").alias("_b"))
                .join(self.embeddings, "id", "left")
                .select("id", F.concat(F.coalesce("emb", F.array_repeat(F.lit(0.0), N_FACTORS)), "_b").alias("z")))
        z = MD.sage_mean_aggregate(base, self.directed, hops=3)
        ds = self.dataset.select("u", "v", "label", "is_test")
        h = MD.hadamard_pairs(ds, z)
        model = MD.fit_logistic(h.where(~F.col("is_test")))
        return model, MD.evaluate("mean_aggregation_encoder", MD.score(model, h.where(F.col("is_test"))))

    def comparison(self) -> DataFrame:
        """One row per model with AUC, AP and F1."""
        return self.logistic[1].unionByName(self.boosted[1]).unionByName(self.sage[1])

    def best(self) -> DataFrame:
        return best_model(self.comparison(), "auc")

    # -------------------------------------------------------- recommendations
    def recommendations(self, pool: int = CANDIDATE_POOL, k: int = TOP_K) -> DataFrame:
        """H14 for all users: ``pool`` random candidates each, minus self and
        followed, scored with the boosted trees, best k with rank and score."""
        users = self.fm.select("new_id")
        cands = SM.exclude_followed(SM.candidates(users, pool), self.follows)
        pairs = cands.select(F.col("user_id").alias("u"), F.col("candidate").alias("v")).distinct()
        feats = MD.assemble(self.features_for(pairs))
        scored = MD.score(self.boosted[0], feats)
        top = top_k_per(scored, "u", [F.col("score").desc(), F.col("v")], k)
        return top.select(F.col("u").alias("user_id"), F.col("v").alias("recommended_user"), "rank", "score")

    def saved_recommendations(self, pool: int = CANDIDATE_POOL, k: int = TOP_K) -> DataFrame:
        """A14 for H14: the table of saved recommendations, one row per (user, recommended user)."""
        return WR.truncate_and_load(self.recommendations(pool, k), ["user_id", "recommended_user"], [F.col("rank")])
