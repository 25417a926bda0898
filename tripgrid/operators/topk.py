"""Deterministic top-k.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only k x tasks rows reach the final merge, so the
ranking never shuffles the full input. Ties are broken by the key columns
ascending, so the answer does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranking_order_sql(metric: str, keys: Sequence[str]) -> list[str]:
    return [f"{metric} DESC NULLS LAST", *[f"{k} ASC NULLS LAST" for k in keys]]


def ranking_order(metric: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(metric).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]]


def top_k(
    df: DataFrame,
    metric: str,
    keys: Sequence[str],
    k: int = 10,
    with_rank: bool = True,
    rank_col: str = "rank",
) -> DataFrame:
    """The ``k`` rows with the largest ``metric`` (NULLs last), ties by ``keys``.

    With ``with_rank`` a 0-based ``rank`` column comes first; it is numbered
    over the k surviving rows only (a window over at most k rows).
    """
    top = df.orderBy(*ranking_order(metric, keys)).limit(k)
    if not with_rank:
        return top
    order = ", ".join(ranking_order_sql(metric, keys))
    rank = f"CAST(row_number() OVER (ORDER BY {order}) - 1 AS INT) AS {rank_col}"
    return top.selectExpr(rank, *top.columns)
