"""Logical schemas of the three raw tables, the fact table and the landed
JSON documents, plus the fixed genre label lists.

Every schema is explicit: nothing in this package infers a schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Raw tables
# --------------------------------------------------------------------------

GAME_INFO = T.StructType(
    [
        T.StructField("game_id", T.LongType(), False),
        T.StructField("game_name", T.StringType(), True),
        T.StructField("price", T.IntegerType(), True),
        T.StructField("discount_percentage", T.IntegerType(), True),
        T.StructField("release_date", T.StringType(), True),
        T.StructField("thumbnail_path", T.StringType(), True),
        T.StructField("genre", T.StringType(), True),
        T.StructField("negative_cnt", T.LongType(), True),
        T.StructField("positive_cnt", T.LongType(), True),
    ]
)

GAME_STATUS = T.StructType(
    [
        T.StructField("game_id", T.LongType(), False),
        T.StructField("create_dt", T.DateType(), True),
        T.StructField("user_cnt", T.LongType(), True),
        T.StructField("review_cnt", T.LongType(), True),
    ]
)

COMMENT_DATA = T.StructType(
    [
        T.StructField("comment_id", T.StringType(), False),
        T.StructField("game_id", T.LongType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("total_playtime", T.LongType(), True),
        T.StructField("last_two_weeks_playtime", T.LongType(), True),
        T.StructField("comment_content", T.StringType(), True),
        T.StructField("language", T.StringType(), True),
    ]
)

FACT_GAME_PLAYTIME = T.StructType(
    [
        T.StructField("game_id", T.LongType(), True),
        T.StructField("count_game_id", T.LongType(), False),
        T.StructField("game_name", T.StringType(), True),
        T.StructField("sum_total_playtime", T.LongType(), True),
        T.StructField("sum_last_two_weeks_playtime", T.LongType(), True),
        T.StructField("avg_total_playtime", T.DoubleType(), True),
        T.StructField("avg_last_two_weeks_playtime", T.DoubleType(), True),
        T.StructField("genre", T.StringType(), True),
    ]
)

COLUMNS = {
    "game_info": GAME_INFO.fieldNames(),
    "game_status": GAME_STATUS.fieldNames(),
    "comment_data": COMMENT_DATA.fieldNames(),
}

# --------------------------------------------------------------------------
# Landed documents: every landed input is a table (game_id, ..., body STRING)
# whose body is parsed with one of these schemas.
# The JSON field names below are those of the source
# documents and must match them exactly. Numbers are declared STRING and cast
# afterwards: the source writes some of them as JSON strings.
# --------------------------------------------------------------------------

APP_DETAILS_ENTRY = T.StructType(
    [
        T.StructField("success", T.BooleanType(), True),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("type", T.StringType(), True),
                    T.StructField("name", T.StringType(), True),
                    T.StructField("is_free", T.BooleanType(), True),
                    T.StructField(
                        "price_overview",
                        T.StructType(
                            [
                                T.StructField("final_formatted", T.StringType(), True),
                                T.StructField("discount_percent", T.StringType(), True),
                            ]
                        ),
                        True,
                    ),
                    T.StructField(
                        "release_date",
                        T.StructType(
                            [
                                T.StructField("coming_soon", T.BooleanType(), True),
                                T.StructField("date", T.StringType(), True),
                            ]
                        ),
                        True,
                    ),
                    T.StructField("capsule_image", T.StringType(), True),
                    T.StructField(
                        "genres",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("id", T.StringType(), True),
                                    T.StructField("description", T.StringType(), True),
                                ]
                            )
                        ),
                        True,
                    ),
                ]
            ),
            True,
        ),
    ]
)

# The details document is keyed by the game id as a string.
APP_DETAILS_BODY = T.MapType(T.StringType(), APP_DETAILS_ENTRY)

REVIEW_SUMMARY_BODY = T.StructType(
    [
        T.StructField("appid", T.StringType(), True),
        T.StructField("positive", T.StringType(), True),
        T.StructField("negative", T.StringType(), True),
    ]
)

PLAYER_COUNT_BODY = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType([T.StructField("player_count", T.StringType(), True)]),
            True,
        )
    ]
)

REVIEW_PAGE_BODY = T.StructType(
    [
        T.StructField(
            "reviews",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("recommendationid", T.StringType(), True),
                        T.StructField(
                            "author",
                            T.StructType(
                                [
                                    T.StructField("steamid", T.StringType(), True),
                                    T.StructField("playtime_forever", T.StringType(), True),
                                    T.StructField("playtime_last_two_weeks", T.StringType(), True),
                                ]
                            ),
                            True,
                        ),
                        T.StructField("review", T.StringType(), True),
                    ]
                )
            ),
            True,
        )
    ]
)

# The popular-ids document maps an id (string key) to an info struct.
POPULAR_BODY = T.MapType(
    T.StringType(),
    T.StructType([T.StructField("appid", T.StringType(), True), T.StructField("name", T.StringType(), True)]),
)

# --------------------------------------------------------------------------
# Fixed values (must equal the source models' literals)
# --------------------------------------------------------------------------

# Genre labels of the review-total model: (output label, matched substring),
# in the order the model lists them.
REVIEW_GENRE_LABELS = [
    ("액션", "액션"),
    ("어드벤처", "어드벤처"),
    ("대규모멀티플레이어", "대규모멀티플레이어"),
    ("RPG", "RPG"),
    ("캐주얼", "캐주얼"),
    ("인디", "인디"),
    ("전략", "전략"),
    ("시뮬레이션", "시뮬레이션"),
    ("스포츠", "스포츠"),
    ("레이싱", "레이싱"),
]

# Genre labels of the playtime model: (output label, matched substring).
# The first branch of that model has no filter at all (match None = every
# row); the massively-multiplayer label is renamed MULTI.
PLAYTIME_GENRE_LABELS = [
    ("액션", None),
    ("어드벤처", "어드벤처"),
    ("MULTI", "대규모멀티플레이어"),
    ("RPG", "RPG"),
    ("캐주얼", "캐주얼"),
    ("인디", "인디"),
    ("전략", "전략"),
    ("시뮬레이션", "시뮬레이션"),
    ("스포츠", "스포츠"),
    ("레이싱", "레이싱"),
]

# Review page languages, in fetch order.
LANGUAGES = ["KOR", "ENG"]

# Top-k of the daily mover models.
DAILY_TOP_K = 15

# Date patterns of the localized store release date: full date first, then
# year-month.
RELEASE_DATE_PATTERNS = ["yyyy년 M월 d일", "yyyy년 M월"]
