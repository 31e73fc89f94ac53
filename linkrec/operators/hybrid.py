"""Content, factor and hybrid recommendations for all users (H4-H5, H7-H9,
H11-H13) on the blocked scorer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrec.operators import blocked as B
from linkrec.operators import factorize as FZ
from linkrec.operators.features import dense_index, l2_normalised
from linkrec.operators.metrics import ranking_metrics
from linkrec.session import materialize

# Fixed values of the reference's similarity job.
TOP_K = 10
N_FACTORS = 50
ALPHAS = [round(0.1 * i, 1) for i in range(11)]     # 0.0, 0.1, ..., 1.0


def content_rows(fm: DataFrame) -> tuple[DataFrame, int]:
    """Unit-length sparse feature rows ``(id, c_idx, c_val)`` and their width."""
    n = l2_normalised(fm)
    width = fm.agg(F.max("n_slots")).first()[0]
    return n.select(F.col("new_id").alias("id"), F.col("slot_idx").alias("c_idx"),
                    F.col("slot_val").alias("c_val")), int(width)


@dataclass
class Factors:
    left: DataFrame      # (id, f_idx, f_val): rows of U Σ
    right: DataFrame     # (id, f_idx, f_val): rows of V
    width: int
    singular_values: list


def svd_factors(train_edges: DataFrame, users: DataFrame, k: int = N_FACTORS) -> Factors:
    """H7: truncated SVD of the (train) follow matrix over ``users(new_id)``;
    k = min(k, n - 1) as in the reference."""
    idx = dense_index(users.select("new_id"), "new_id", "pos")
    n = idx.count()
    k = max(1, min(k, n - 1))
    A = FZ.adjacency(train_edges, idx)
    U, s, V = FZ.randomized_svd(A, k)
    back = idx.select(F.col("pos").alias("id"), F.col("new_id"))
    zero = F.array_repeat(F.lit(0.0), len(s))
    # every user gets a row; users without edges have zero factor rows
    emb = back.join(FZ.embeddings(U, s), "id", "left").select(
        F.col("new_id").alias("id"), F.coalesce("vec", zero).alias("vec"))
    vv = back.join(V, "id", "left").select(F.col("new_id").alias("id"), F.coalesce("vec", zero).alias("vec"))
    return Factors(FZ.as_sparse_rows(emb), FZ.as_sparse_rows(vv), len(s), [float(x) for x in s])


def content_topk(content: DataFrame, width: int, k: int = TOP_K, exclude: DataFrame | None = None,
                 block_size: int = 2048) -> DataFrame:
    """H4 (exclude=None) / H5: best k users by content cosine, self excluded."""
    left, _ = B.score_rows(content, None, None)
    rows = materialize(left, "content-rows")               # left and right alike
    r = B.blocked_topk(rows, B.packed_blocks(rows, block_size), width, k, [1.0], block_size=block_size,
                       exclude=exclude, mode="content")
    return r.select("user_id", "recommended_user", F.col("content").alias("score"), "rank")


def svd_recs(content: DataFrame, width: int, factors: Factors, k: int = TOP_K,
             exclude: DataFrame | None = None, block_size: int = 2048) -> DataFrame:
    """H8 + H9: best k by the reconstructed row (U Σ Vᵀ)[u], self and
    followed skipped."""
    left, right = B.score_rows(content, factors.left, factors.right)
    left, right = (materialize(x, "factor-rows") for x in (left, right))
    r = B.blocked_topk(left, B.packed_blocks(right, block_size), width, k, [0.0], block_size=block_size,
                       exclude=exclude, mode="factor")
    return r.select("user_id", "recommended_user", F.col("factor").alias("score"), "rank")


def hybrid_recs(content: DataFrame, width: int, factor_left: DataFrame | None, factor_right: DataFrame | None,
                factor_width: int, alphas=(0.0,), k: int = TOP_K, exclude: DataFrame | None = None,
                block_size: int = 2048) -> DataFrame:
    """Alpha * minmax(content) + (1 - alpha) * minmax(factor).

    Content min-max over all candidates except self, factor min-max over all
    users (self included), both before removing followed users; a missing
    factor row scores 0; then followed and self are removed and the best k
    kept.  Several alphas are scored in the same block pass (H12)."""
    left, right = B.score_rows(content, factor_left, factor_right)
    return _hybrid(left, right, width, alphas, k, exclude, block_size)


def _hybrid(left: DataFrame, right: DataFrame, width: int, alphas, k: int, exclude: DataFrame | None,
            block_size: int) -> DataFrame:
    # both passes read the rows: written once, in proportion to the users
    left, right = (materialize(x, "hybrid-rows") for x in (left, right))
    blocks = B.packed_blocks(right, block_size)
    mm = materialize(B.user_minmax(B.packed_blocks(left, block_size), blocks, width), "hybrid-minmax")
    return B.blocked_topk(left, blocks, width, k, list(alphas), block_size=block_size, exclude=exclude,
                          minmax=mm, mode="hybrid")


def alpha_sweep(content: DataFrame, width: int, factor_left: DataFrame, factor_right: DataFrame, factor_width: int,
                test: DataFrame, exclude: DataFrame, alphas=tuple(ALPHAS), k: int = TOP_K,
                users: DataFrame | None = None, block_size: int = 2048) -> DataFrame:
    """H12 + K5: every alpha judged on all users of ``test(user_id, item)``, or on ``users(user_id)``.

    Only the judged users are scored, against all candidates, all alphas in one block pass;
    the metrics of all alphas come from one aggregation.  Output ``alpha`` and the columns of ``ranking_metrics``."""
    users = (test if users is None else users).select("user_id").distinct()
    left, _ = B.score_rows(content.join(users.withColumnRenamed("user_id", "id"), "id", "left_semi"),
                           factor_left, factor_right)
    _, right = B.score_rows(content, factor_left, factor_right)
    recs = _hybrid(left, right, width, alphas, k, exclude, block_size)
    judged = users.select(F.explode(F.array(*[F.lit(a) for a in alphas])).alias("alpha"), "user_id")
    return ranking_metrics(recs, test, judged, k, by=("alpha",))


def common_follow_rows(edges: DataFrame, users: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the follow matrix itself as sparse factor rows: with them the
    factor score is the untruncated A Aᵀ (number of commonly followed users)."""
    idx = dense_index(users.select("new_id"), "new_id", "pos")
    width = idx.count()
    A = FZ.adjacency(edges, idx)
    back = idx.select(F.col("pos").alias("i"), F.col("new_id").alias("id"))
    rows = (A.join(back, "i").groupBy("id")
            .agg(F.sort_array(F.collect_list(F.struct("j", "a"))).alias("_e"))
            .select("id", F.col("_e.j").cast("array<int>").alias("f_idx"), F.col("_e.a").alias("f_val")))
    return rows, int(width)
