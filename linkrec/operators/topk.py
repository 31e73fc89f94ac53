"""Sorts, limits and per-key top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per(df: DataFrame, part: str | list[str], order: list[Column], k: int,
              rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per ``part`` with a 1-based rank.

    ``row_number() <= k`` lets Spark plan a ``WindowGroupLimit`` before the
    shuffle (partial top-k per task), so only k rows per key and task move.
    Ties are broken by the caller's full ``order`` list.
    """
    parts = [part] if isinstance(part, str) else list(part)
    w = Window.partitionBy(*parts).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k))


def global_top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n -> TakeOrderedAndProject (per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)


def per_key_minmax_scale(df: DataFrame, part: str, col: str, out: str, eps: float = 1e-9) -> DataFrame:
    """(s - min) / (max - min + eps) over the key's own rows."""
    w = Window.partitionBy(part)
    mn, mx = F.min(col).over(w), F.max(col).over(w)
    return df.withColumn(out, (F.col(col) - mn) / (mx - mn + F.lit(eps)))
