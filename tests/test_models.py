"""Hand-made edge cases for the source, fact and analytics models."""

import datetime as dt

import pytest

from playmart import schemas
import union_models
from playmart.operators import models

D = dt.date


def info_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.GAME_INFO)


def status_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.GAME_STATUS)


def comment_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.COMMENT_DATA)


def gi(game_id, genre="액션", price=1000, discount=0, release="2023-05", neg=1, pos=3, name=None):
    return (game_id, name or f"g{game_id}", price, discount, release, f"img/{game_id}.jpg", genre, neg, pos)


def cm(cid, game_id, total, recent, lang="KOR"):
    return (cid, game_id, "u", total, recent, "text", lang)


def test_genre_comment_ratio_keeps_empty_label_and_multi_membership(spark):
    info = info_rows(spark, [gi(1, "액션 RPG", neg=2, pos=5), gi(2, "RPG", neg=1, pos=1), gi(3, None, neg=9, pos=9)])
    out = {r["genre"]: r for r in models.analytics_genre_comment_ratio(info).collect()}
    assert len(out) == 10
    assert (out["액션"]["total_positive_cnt"], out["액션"]["total_negative_cnt"], out["액션"]["game_cnt"]) == (5, 2, 1)
    assert (out["RPG"]["total_positive_cnt"], out["RPG"]["game_cnt"]) == (6, 2)
    empty = out["레이싱"]
    assert (empty["total_positive_cnt"], empty["total_negative_cnt"], empty["game_cnt"]) == (None, None, 0)


def test_genre_comment_ratio_single_pass_equals_union(spark):
    info = info_rows(spark, [gi(i, g) for i, g in enumerate(["액션 RPG", "인디", "전략 스포츠", None, "캐주얼"])])
    a = sorted(models.analytics_genre_comment_ratio(info).collect())
    b = sorted(union_models.analytics_genre_comment_ratio_union(info).collect())
    assert a == b


def test_genre_playtime_first_label_unfiltered_and_empty_label_dropped(spark):
    fact = spark.createDataFrame(
        [
            (1, 1, "a", 100, 10, 100.0, 10.0, "RPG"),
            (2, 3, "b", 600, 30, 200.0, 10.0, None),  # NULL genre: only the unfiltered branch
        ],
        schemas.FACT_GAME_PLAYTIME,
    )
    out = {r["gen"]: r for r in models.analytics_genre_playtime(fact).collect()}
    assert set(out) == {"액션", "RPG"}
    # weighted by review count: (100 + 600) / (1 + 3)
    assert out["액션"]["sum_total_playtime"] == pytest.approx(175.0)
    assert out["RPG"]["sum_last_two_weeks_playtime"] == pytest.approx(10.0)
    filtered = {r["gen"] for r in models.analytics_genre_playtime(fact, filter_first_label=True).collect()}
    assert filtered == {"RPG"}
    union = sorted(union_models.analytics_genre_playtime_union(fact).collect())
    assert union == sorted(models.analytics_genre_playtime(fact).collect())


def test_genre_playtime_empty_fact_gives_no_rows(spark):
    fact = spark.createDataFrame([], schemas.FACT_GAME_PLAYTIME)
    assert models.analytics_genre_playtime(fact).count() == 0


def test_genre_playtime_multi_label_renamed(spark):
    fact = spark.createDataFrame([(1, 2, "a", 10, 4, 5.0, 2.0, "대규모멀티플레이어")], schemas.FACT_GAME_PLAYTIME)
    gens = {r["gen"] for r in models.analytics_genre_playtime(fact).collect()}
    assert gens == {"액션", "MULTI"}


def test_fact_counts_sums_and_means(spark):
    info = info_rows(spark, [gi(1), gi(2)])
    comments = comment_rows(spark, [cm("a", 1, 10, 1), cm("b", 1, 30, None), cm("c", 3, 5, 5)])
    rows = models.fact_game_playtime(comments, info).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["game_id"], r["count_game_id"], r["sum_total_playtime"], r["sum_last_two_weeks_playtime"]) == (1, 2, 40, 1)
    assert r["avg_total_playtime"] == 20.0 and r["avg_last_two_weeks_playtime"] == 1.0


def test_release_date_mean_of_means_and_short_dates(spark):
    info = info_rows(
        spark,
        [gi(1, release="2023-05", pos=10), gi(2, release="2021-05", pos=20), gi(3, release="2023"), gi(4, release=None)],
    )
    comments = comment_rows(
        spark,
        [cm("a", 1, 10, 0), cm("b", 2, 20, 0), cm("c", 2, 20, 0), cm("d", 2, 50, 0), cm("e", 3, 1, 1), cm("f", 4, 1, 1)],
    )
    status = status_rows(spark, [(i, D(2024, 1, 1), 10 * i, 1) for i in (1, 2, 3, 4)])
    rows = models.analytics_release_date(info, comments, status).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["month"] == "05" and r["game_cnt"] == 2
    # unweighted: mean(10, 30) = 20, not (10 + 90) / 4
    assert r["total_playtime_avg"] == 20.0
    assert r["positive_cnt_avg"] == 15.0
    assert r["current_user_cnt_avg"] == 15.0


def test_release_date_round_half_away_from_zero(spark):
    info = info_rows(spark, [gi(1, pos=2), gi(2, pos=3)])
    comments = comment_rows(spark, [cm("a", 1, 1, 0), cm("b", 2, 2, 0)])
    status = status_rows(spark, [(1, D(2024, 1, 1), 1, 1), (2, D(2024, 1, 1), 2, 1)])
    r = models.analytics_release_date(info, comments, status).collect()[0]
    assert r["positive_cnt_avg"] == 3.0  # 2.5 -> 3
    assert r["total_playtime_avg"] == 2.0  # 1.5 -> 2


def test_usercnt_price_full_discount_unknown_price_and_ties(spark):
    info = info_rows(
        spark,
        [
            gi(1, price=0, discount=100, neg=1, pos=1),
            gi(2, price=-1, neg=1, pos=1),
            gi(3, price=900, discount=10, neg=0, pos=0),
            gi(4, price=800, discount=20, neg=1, pos=3),
            gi(5, price=None, neg=1, pos=1),
        ],
    )
    status = status_rows(
        spark,
        [
            (1, D(2024, 1, 1), 5, 0),
            (2, D(2024, 1, 1), 5, 0),
            (3, D(2024, 1, 1), 5, 0),
            (4, D(2024, 1, 1), 1, 0),
            (4, D(2024, 1, 2), 7, 0),
            (4, D(2024, 1, 2), 8, 0),  # tied latest rows: both kept
            (5, D(2024, 1, 2), 8, 0),
        ],
    )
    rows = models.analytics_usercnt_price(info, status).collect()
    by_game = {}
    for r in rows:
        by_game.setdefault(r["game_id"], []).append(r)
    assert set(by_game) == {1, 4}
    assert by_game[1][0]["original_price"] is None
    assert sorted(r["user_cnt"] for r in by_game[4]) == [7, 8]
    r4 = by_game[4][0]
    assert r4["original_price"] == pytest.approx(1000.0)
    assert r4["n_ratio"] == 25.0


def _movers_status(spark):
    rows = []
    # 20 games with equal diffs on day 1 -> 2
    for g in range(1, 21):
        rows += [(g, D(2024, 1, 1), 100, 10), (g, D(2024, 1, 2), 110, 12)]
    # gap day: 30 has day 1 and day 3 only
    rows += [(30, D(2024, 1, 1), 1, 1), (30, D(2024, 1, 3), 500, 1)]
    # repeated snapshot: 31 twice on day 1
    rows += [(31, D(2024, 1, 1), 5, 0), (31, D(2024, 1, 1), 6, 0), (31, D(2024, 1, 2), 1000, 0)]
    # NULL count on day 2
    rows += [(32, D(2024, 1, 1), 50, 0), (32, D(2024, 1, 2), None, 0)]
    return status_rows(spark, rows)


def test_next_day_pairs_gap_and_repeats(spark):
    info = info_rows(spark, [gi(g) for g in list(range(1, 21)) + [30, 31, 32]])
    pairs = models.next_day_pairs(_movers_status(spark), info)
    assert pairs.filter("game_id = 30").count() == 0
    assert sorted(r["user_diff"] for r in pairs.filter("game_id = 31").collect()) == [994, 995]


def test_login_diff_top15_order_ties_and_nulls(spark):
    info = info_rows(spark, [gi(g) for g in list(range(1, 21)) + [30, 31, 32]])
    out = models.daily_user_login_cnt_diff_top15(_movers_status(spark), info).collect()
    inc = [r for r in out if r["gubun"] == "INCREASE" and r["start_dt"] == D(2024, 1, 1)]
    dec = [r for r in out if r["gubun"] == "DECREASE" and r["start_dt"] == D(2024, 1, 1)]
    assert len(inc) == 15 and len(dec) == 15
    assert [r["rn"] for r in inc] == list(range(1, 16))
    # DESC: NULL first, then the repeated-snapshot game, then ties by game id
    assert inc[0]["game_id"] == 32 and inc[0]["user_diff"] is None
    assert [r["game_id"] for r in inc[1:3]] == [31, 31]
    assert [r["game_id"] for r in inc[3:6]] == [1, 2, 3]
    # ASC: NULL last, so the 15 smallest are the equal-diff games 1..15
    assert [r["game_id"] for r in dec] == list(range(1, 16))
    # final order: gubun, start_dt, rn
    keys = [(r["gubun"], r["start_dt"], r["rn"]) for r in out]
    assert keys == sorted(keys)


def test_review_diff_top15(spark):
    info = info_rows(spark, [gi(g) for g in range(1, 21)])
    out = models.daily_user_review_cnt_diff_top15(_movers_status(spark), info).collect()
    assert len(out) == 15
    assert all(r["review_diff"] == 2 for r in out)
    assert [r["game_id"] for r in out] == list(range(1, 16))
    assert out[0].asDict().keys() >= {"game_id", "game_name", "start_dt", "end_dt", "review_diff", "rn", "thumbnail_path"}


def test_source_models_project_explicit_columns(spark):
    from pyspark.sql import functions as F

    info = info_rows(spark, [gi(1)]).withColumn("extra", F.lit(1))
    assert models.src_game_info(info).columns == schemas.COLUMNS["game_info"]


def _brute_top(pairs, metric, ascending, k=15):
    """Top k per start day by sorting all pairs in Python (small fixture)."""
    by_day = {}
    for r in pairs:
        by_day.setdefault(r["start_dt"], []).append(r)
    out = []
    for day, rows in by_day.items():
        def key(r):
            v = r[metric]
            null_rank = (v is None) if ascending else (v is not None)
            vv = 0 if v is None else (v if ascending else -v)
            return (null_rank, vv, r["game_id"])
        rows.sort(key=key)
        out += [(day, r["game_id"], r[metric]) for r in rows[:k]]
    return sorted(out, key=repr)


def test_hot_repeated_snapshots_bounded_and_exact(spark):
    import random

    rnd = random.Random(7)
    rows = []
    # game 1 repeats 200 times a day (a hot key); games 2..25 once a day
    for day in (1, 2, 3):
        for _ in range(200):
            rows.append((1, D(2024, 1, day), rnd.choice([None] + list(range(50))), rnd.randrange(100)))
        for g in range(2, 26):
            rows.append((g, D(2024, 1, day), rnd.randrange(60), rnd.randrange(100)))
    status = status_rows(spark, rows)
    info = info_rows(spark, [gi(g) for g in range(1, 26)])
    full = models.next_day_pairs(status, info).collect()
    assert sum(1 for r in full if r["game_id"] == 1) == 2 * 200 * 200
    for metric in ("user_cnt", "review_cnt"):
        limited = models.next_day_pairs(status, info, metric)
        # the 15 lowest and highest, with and without the metric, on either side
        assert limited.filter("game_id = 1").count() <= 2 * 60 * 60
    out = models.daily_user_login_cnt_diff_top15(status, info).collect()
    got_inc = sorted([(r["start_dt"], r["game_id"], r["user_diff"]) for r in out if r["gubun"] == "INCREASE"], key=repr)
    got_dec = sorted([(r["start_dt"], r["game_id"], r["user_diff"]) for r in out if r["gubun"] == "DECREASE"], key=repr)
    assert got_inc == _brute_top(full, "user_diff", ascending=False)
    assert got_dec == _brute_top(full, "user_diff", ascending=True)
    rev = models.daily_user_review_cnt_diff_top15(status, info).collect()
    assert sorted([(r["start_dt"], r["game_id"], r["review_diff"]) for r in rev], key=repr) == _brute_top(
        full, "review_diff", ascending=False
    )


def test_latest_rows_of_a_hot_game_are_all_kept(spark):
    """One game holds most snapshot rows, thousands tied on its latest day:
    all tied rows come back (results are never capped to escape skew)."""
    hot = [(1, D(2024, 1, 2), i, 0) for i in range(3000)] + [(1, D(2024, 1, 1), 5, 0)] * 500
    rest = [(g, D(2024, 1, 2), g, 0) for g in range(2, 50)]
    status = status_rows(spark, hot + rest)
    info = info_rows(spark, [gi(g, neg=1, pos=1) for g in range(1, 50)])
    out = models.analytics_usercnt_price(info, status)
    counts = {r["game_id"]: r["n"] for r in out.groupBy("game_id").count().withColumnRenamed("count", "n").collect()}
    assert counts[1] == 3000 and all(counts[g] == 1 for g in range(2, 50))
