"""The source, fact and analytics models (M1-M10) as pure DataFrame functions.

Inputs are the three raw tables; every function returns a lazily evaluated
DataFrame and leaves physical choices (broadcast or sort-merge, partial
aggregation, group limits) to Catalyst and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart import schemas
from playmart.functions.sqltext import literal

# --------------------------------------------------------------------------
# M1-M3: source models, an explicit projection of each raw table
# --------------------------------------------------------------------------


def src_game_info(game_info: DataFrame) -> DataFrame:
    return game_info.select(*schemas.COLUMNS["game_info"])


def src_game_status(game_status: DataFrame) -> DataFrame:
    return game_status.select(*schemas.COLUMNS["game_status"])


def src_comment_data(comment_data: DataFrame) -> DataFrame:
    return comment_data.select(*schemas.COLUMNS["comment_data"])


def _ratio(num: Column, den: Column) -> Column:
    """Division in DOUBLE that yields NULL instead of failing on zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


# --------------------------------------------------------------------------
# M4: playtime fact = per-game aggregate of comments joined to game info
# --------------------------------------------------------------------------


def playtime_per_game(comment_data: DataFrame) -> DataFrame:
    return comment_data.groupBy("game_id").agg(
        F.count("game_id").alias("count_game_id"),
        F.sum("total_playtime").alias("sum_total_playtime"),
        F.sum("last_two_weeks_playtime").alias("sum_last_two_weeks_playtime"),
        F.avg("total_playtime").alias("avg_total_playtime"),
        F.avg("last_two_weeks_playtime").alias("avg_last_two_weeks_playtime"),
    )


def fact_game_playtime(comment_data: DataFrame, game_info: DataFrame) -> DataFrame:
    """One row per game having both comments and catalogue info.

    The comment side is reduced to one row per game before the join (partial
    then final aggregate), so the join sees games, not comments.
    """
    return playtime_fact(playtime_per_game(comment_data), game_info)


def playtime_fact(av: DataFrame, game_info: DataFrame) -> DataFrame:
    """The fact from per-game playtime aggregates (also kept ones)."""
    info = game_info.select("game_id", "game_name", "genre")
    return av.join(info, "game_id", "inner").select(*schemas.FACT_GAME_PLAYTIME.fieldNames())


# --------------------------------------------------------------------------
# M5: review totals per genre label (global aggregate, one row per label)
# --------------------------------------------------------------------------


def _contains(match: str | None) -> str:
    return "true" if match is None else f"contains(genre, {literal(match)})"


def _inline_sql(rows: list[str]) -> str:
    """One output row per struct: inline(array(struct(...), ...))."""
    return f"inline(array({', '.join(rows)}))"


def analytics_genre_comment_ratio(game_info: DataFrame, labels=None) -> DataFrame:
    """Sum of positive/negative counts and game count of games whose genre
    contains each label. A label that matches no game keeps its row with NULL
    sums and a zero count, as a global aggregate does.

    Single pass: all labels are conditional aggregates of one scan, reduced
    map-side to one row per partition; ``inline`` then yields one row per label.
    """
    labels = labels or schemas.REVIEW_GENRE_LABELS
    aggs, rows = [], []
    for i, (label, match) in enumerate(labels):
        hit = _contains(match)
        aggs += [
            f"sum(CASE WHEN {hit} THEN positive_cnt END) AS p{i}",
            f"sum(CASE WHEN {hit} THEN negative_cnt END) AS n{i}",
            f"count(CASE WHEN {hit} THEN 1 END) AS c{i}",
        ]
        rows.append(
            f"struct({literal(label)} AS genre, p{i} AS total_positive_cnt, n{i} AS total_negative_cnt, c{i} AS game_cnt)"
        )
    # a projection of aggregate expressions is a global aggregate
    return game_info.selectExpr(*aggs).selectExpr(_inline_sql(rows))


# --------------------------------------------------------------------------
# M6: mean playtime per review per genre label
# --------------------------------------------------------------------------


def _playtime_labels(labels, filter_first_label: bool):
    labels = list(labels or schemas.PLAYTIME_GENRE_LABELS)
    if filter_first_label and labels[0][1] is None:
        labels[0] = (labels[0][0], labels[0][0])
    return labels


def analytics_genre_playtime(fact: DataFrame, labels=None, filter_first_label: bool = False) -> DataFrame:
    """Per label: sum of playtime sums / sum of review counts over the fact.

    Grouped by the constant label, so a label with no matching game gives no
    row. The first label has no filter unless ``filter_first_label``.
    Single pass with conditional aggregates, as in the review-total model.
    """
    labels = _playtime_labels(labels, filter_first_label)
    aggs, rows = [], []
    for i, (label, match) in enumerate(labels):
        hit = _contains(match)
        aggs += [
            f"sum(CASE WHEN {hit} THEN sum_total_playtime END) AS t{i}",
            f"sum(CASE WHEN {hit} THEN sum_last_two_weeks_playtime END) AS w{i}",
            f"sum(CASE WHEN {hit} THEN count_game_id END) AS c{i}",
            f"count(CASE WHEN {hit} THEN 1 END) AS g{i}",
        ]
        rows.append(
            f"struct({literal(label)} AS gen, "
            f"try_divide(CAST(t{i} AS DOUBLE), CAST(c{i} AS DOUBLE)) AS sum_total_playtime, "
            f"try_divide(CAST(w{i} AS DOUBLE), CAST(c{i} AS DOUBLE)) AS sum_last_two_weeks_playtime, "
            f"g{i} AS n_games)"
        )
    return fact.selectExpr(*aggs).selectExpr(_inline_sql(rows)).filter("n_games > 0").drop("n_games")


# --------------------------------------------------------------------------
# M7: popularity by release month (mean of per-game means)
# --------------------------------------------------------------------------


def analytics_release_date(game_info: DataFrame, comment_data: DataFrame, game_status: DataFrame) -> DataFrame:
    """Per release month: rounded means over games of per-game means, and
    the game count. Both per-game averages are computed before the joins, so
    every join is game-to-game; the month filter sits on the catalogue scan.
    """
    cm = comment_data.groupBy("game_id").agg(
        F.expr("avg(total_playtime)").alias("total_playtime"),
        F.expr("avg(last_two_weeks_playtime)").alias("last_two_weeks_playtime"),
    )
    gs = game_status.groupBy("game_id").agg(
        F.expr("avg(user_cnt)").alias("user_cnt"),
        F.expr("avg(review_cnt)").alias("review_cnt"),
    )
    return release_months(game_info, cm, gs)


def release_months(game_info: DataFrame, cm: DataFrame, gs: DataFrame) -> DataFrame:
    """The release-month model from per-game means of comments and snapshots
    (also kept ones)."""
    gi = game_info.select("game_id", "release_date", "negative_cnt", "positive_cnt").filter("length(release_date) = 7")
    joined = gi.join(cm, "game_id", "inner").join(gs, "game_id", "inner")
    return joined.groupBy(F.expr("substring(release_date, 6, 2)").alias("month")).agg(
        F.expr("round(avg(total_playtime))").alias("total_playtime_avg"),
        F.expr("round(avg(last_two_weeks_playtime))").alias("last_two_weeks_playtime_avg"),
        F.expr("round(avg(positive_cnt))").alias("positive_cnt_avg"),
        F.expr("round(avg(negative_cnt))").alias("negative_cnt_avg"),
        F.expr("round(avg(user_cnt))").alias("current_user_cnt_avg"),
        F.expr("round(avg(review_cnt))").alias("review_cnt_avg"),
        F.expr("count(1)").alias("game_cnt"),
    )


# --------------------------------------------------------------------------
# M8: price versus the latest player count
# --------------------------------------------------------------------------


def latest_status(game_status: DataFrame) -> DataFrame:
    """Rows of each game on its latest day; tied rows on that day all stay.

    Aggregate-and-join rather than a window per game: the max is a partial
    aggregate (a hot game costs one row per map partition) and the join
    hashes on (game, day), so one game's history spreads over many tasks.
    """
    latest = game_status.groupBy(F.col("game_id").alias("ls_game_id")).agg(F.expr("max(create_dt)").alias("max_datetime"))
    return game_status.join(
        latest, F.expr("game_id = ls_game_id AND create_dt = max_datetime"), "inner"
    ).select("game_id", "create_dt", "user_cnt")


def analytics_usercnt_price(game_info: DataFrame, game_status: DataFrame) -> DataFrame:
    """Games with reviews and a known price, with the players of their latest
    snapshot. A full discount gives a NULL undiscounted price."""
    a = game_info.select(
        "game_id", "game_name", "price", "discount_percentage", "negative_cnt", "positive_cnt"
    ).filter("negative_cnt + positive_cnt > 0 AND price != -1")
    b = latest_status(game_status).select("game_id", "user_cnt")
    return a.join(b, "game_id", "inner").selectExpr(
        "game_id",
        "game_name",
        "try_divide(CAST(price AS DOUBLE), CAST(100 - discount_percentage AS DOUBLE)) * 100 AS original_price",
        "price",
        "discount_percentage",
        "negative_cnt",
        "positive_cnt",
        "round(try_divide(CAST(negative_cnt AS DOUBLE), CAST(negative_cnt + positive_cnt AS DOUBLE)) * 100, 2) AS n_ratio",
        "user_cnt",
    )


# --------------------------------------------------------------------------
# Daily top movers
# --------------------------------------------------------------------------


def _mover_info(game_info: DataFrame) -> DataFrame:
    return game_info.select("game_id", "game_name", "genre", "price", "discount_percentage", "thumbnail_path")


def _extremes(game_status: DataFrame, metric: str, k: int) -> DataFrame:
    """Of the snapshots of each (game, day) the k lowest, k highest and k
    without the metric: what a top-k difference in either direction can
    use. All snapshots of a day that is not repeated stay.

    Partitioned by (game, day), which the end side of the pairs joins on.
    """
    rank = f"row_number() OVER (PARTITION BY game_id, create_dt, {metric} IS NULL ORDER BY {metric} {{}})"
    dated = game_status.filter("create_dt IS NOT NULL").repartition("game_id", "create_dt")
    ranked = dated.selectExpr("*", f"{rank.format('ASC')} AS _low", f"{rank.format('DESC')} AS _high")
    return ranked.filter(f"_low <= {int(k)} OR _high <= {int(k)}").drop("_low", "_high")


def next_day_pairs(
    game_status: DataFrame,
    game_info: DataFrame,
    metric: str | None = None,
    k: int = schemas.DAILY_TOP_K,
) -> DataFrame:
    """Snapshot pairs (day d, day d+1) of the same game, with game info.

    An equi-join on (game_id, day + 1): a day without a snapshot yields no
    pair. A (game, day) repeated N times before one repeated M times yields
    N * M pairs, as in the join form of the model; so without ``metric`` the
    result grows with the square of repetitions.

    With ``metric`` (``user_cnt`` or ``review_cnt``) the pairs are those that
    can reach the top k of its difference, in either direction: every pair
    left out is outranked, or tied with an identical output row, by k pairs
    kept. A repeated day then yields a bounded number of pairs.
    """
    status = game_status if metric is None else _extremes(game_status, metric, k)
    a = status.selectExpr(
        "game_id", "create_dt AS start_dt", "date_add(create_dt, 1) AS next_dt",
        "user_cnt AS a_user_cnt", "review_cnt AS a_review_cnt",
    )
    b = status.selectExpr(
        "game_id AS b_game_id", "create_dt AS end_dt", "user_cnt AS b_user_cnt", "review_cnt AS b_review_cnt"
    )
    pairs = a.join(b, F.expr("game_id = b_game_id AND next_dt = end_dt"), "inner")
    return pairs.join(_mover_info(game_info), "game_id", "inner").selectExpr(
        "game_id",
        "game_name",
        "start_dt",
        "end_dt",
        "b_user_cnt - a_user_cnt AS user_diff",
        "b_review_cnt - a_review_cnt AS review_diff",
        "genre",
        "price",
        "discount_percentage",
        "thumbnail_path",
    )


def top_k_per_day(pairs: DataFrame, metric: str, ascending: bool, k: int = schemas.DAILY_TOP_K) -> DataFrame:
    """row_number() per start day, ties broken by game id; keep rn <= k.

    NULL metrics sort as the largest value (last ascending, first
    descending). Catalyst turns ``rn <= k`` into a partial group limit before
    the shuffle and a final one after it, so each map task sends at most k
    rows per day, however many games a day holds.
    """
    order = f"{metric} ASC NULLS LAST" if ascending else f"{metric} DESC NULLS FIRST"
    rn = F.expr(f"CAST(row_number() OVER (PARTITION BY start_dt ORDER BY {order}, game_id ASC) AS BIGINT)")
    return pairs.withColumn("rn", rn).filter(f"rn <= {int(k)}")


MOVER_COLUMNS = ["game_id", "game_name", "start_dt", "end_dt", None, "rn", "genre", "price", "discount_percentage", "thumbnail_path"]


def _mover_columns(metric: str) -> list[str]:
    return [metric if c is None else c for c in MOVER_COLUMNS]


def daily_user_login_cnt_diff_top15(game_status: DataFrame, game_info: DataFrame, k: int = schemas.DAILY_TOP_K) -> DataFrame:
    """Per start day, the k largest player-count drops (DECREASE) and rises
    (INCREASE) to the next day, ordered by (gubun, start_dt, rn).

    The pairs are built once; each enters both directions, which are ranked
    by one group-limited window.
    """
    pairs = next_day_pairs(game_status, game_info, "user_cnt", k=k)
    # a NULL difference is the last decrease and the first increase
    directions = pairs.selectExpr(
        "*",
        "inline(array("
        "struct('DECREASE' AS gubun, int(user_diff IS NULL) AS _null, user_diff AS _order), "
        "struct('INCREASE' AS gubun, int(user_diff IS NOT NULL) AS _null, -user_diff AS _order)))",
    )
    rank = F.expr("CAST(row_number() OVER (PARTITION BY gubun, start_dt ORDER BY _null, _order, game_id) AS BIGINT)")
    top = directions.withColumn("rn", rank).filter(f"rn <= {int(k)}")
    return top.select(*_mover_columns("user_diff"), "gubun").orderBy("gubun", "start_dt", "rn")


def daily_user_review_cnt_diff_top15(game_status: DataFrame, game_info: DataFrame, k: int = schemas.DAILY_TOP_K) -> DataFrame:
    """Per start day, the k largest review-count rises to the next day."""
    pairs = next_day_pairs(game_status, game_info, "review_cnt", k=k)
    top = top_k_per_day(pairs, "review_diff", False, k).select(*_mover_columns("review_diff"))
    return top.orderBy("start_dt", "rn")
