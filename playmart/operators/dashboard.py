"""Thin reads behind the dashboard charts: top-k games by playtime and the
positive/negative review share per genre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_games_by_playtime(fact: DataFrame, metric: str = "sum_total_playtime", k: int = 10) -> DataFrame:
    """The k games with the largest playtime metric (ties by game id).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, only those reach the final merge.
    """
    return (
        fact.select("game_id", "game_name", "genre", metric)
        .orderBy(F.col(metric).desc_nulls_last(), F.col("game_id").asc())
        .limit(k)
    )


def genre_review_share(genre_ratio: DataFrame) -> DataFrame:
    total = F.col("total_positive_cnt") + F.col("total_negative_cnt")
    return genre_ratio.select(
        "genre",
        "game_cnt",
        F.try_divide(F.col("total_positive_cnt").cast("double"), total.cast("double")).alias("positive_share"),
        F.try_divide(F.col("total_negative_cnt").cast("double"), total.cast("double")).alias("negative_share"),
    )
