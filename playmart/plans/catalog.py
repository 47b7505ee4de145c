"""Name the tables and models as temporary views, so they can be queried
with ``spark.sql`` under the names a SQL user knows (raw tables, source
models, the fact and the analytics tables).

Views are lazy: registering costs no job; each query plans over the current
inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playmart.operators import dashboard, models, quality


def model_frames(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All models over the three raw tables (game_info, game_status,
    comment_data), keyed by view name."""
    gi, gs, cm = tables["game_info"], tables["game_status"], tables["comment_data"]
    src = {
        "src_game_info": models.src_game_info(gi),
        "src_game_status": models.src_game_status(gs),
        "src_comment_data": models.src_comment_data(cm),
    }
    # the fact reads the raw catalogue; the analytics read the source models
    fact = models.fact_game_playtime(src["src_comment_data"], gi)
    sgi, sgs, scm = src["src_game_info"], src["src_game_status"], src["src_comment_data"]
    ratio = models.analytics_genre_comment_ratio(sgi)
    return {
        **tables,
        **src,
        "fact_game_playtime": fact,
        "analytics_genre_comment_ratio": ratio,
        "analytics_genre_playtime": models.analytics_genre_playtime(fact),
        "analytics_release_date": models.analytics_release_date(sgi, scm, sgs),
        "analytics_usercnt_price": models.analytics_usercnt_price(sgi, sgs),
        "daily_user_login_cnt_diff_top15": models.daily_user_login_cnt_diff_top15(sgs, sgi),
        "daily_user_review_cnt_diff_top15": models.daily_user_review_cnt_diff_top15(sgs, sgi),
        "genre_review_share": dashboard.genre_review_share(ratio),
        "dq_test_results": quality.test_results(
            {"game_info": sgi, "game_status": sgs, "comment_data": scm}
        ),
    }


def register_views(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Register every table and model as a temp view; returns the names."""
    names = []
    for name, df in model_frames(tables).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
