"""Driver tables and the adapter views that turn them into the three raw
tables (``game_info``, ``game_status``, ``comment_data``).

Each view is a pure DataFrame function. Only the columns a view needs are
selected, so the parquet scans read just those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.sqltext import literal

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the driver tables read here: reading with a schema
# skips the footer-inference job that a schema-less read launches.
DRIVER_SCHEMAS = {
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, with its declared schema where there is one. Files are
    listed by every call, so a query sees what is under the path now."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = DRIVER_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


# Fixed values of the adapter (FIXTURES.md §3): genre words chosen by part
# type, and a second word chosen by the last word of the part name.
TYPE_GENRE = [
    ("ECONOMY", "액션 "),
    ("LARGE", "어드벤처 "),
    ("MEDIUM", "대규모멀티플레이어 "),
    ("PROMO", "RPG "),
    ("SMALL", "캐주얼 "),
]
TYPE_GENRE_DEFAULT = "인디 "
NAME_SUFFIX_GENRE = [
    ("anvil", "전략 "),
    ("bolt", "시뮬레이션 "),
    ("gear", "스포츠 "),
    ("gizmo", "인디 "),
]


def _case(subject_test: str, pairs, default: str) -> str:
    """CASE WHEN <test(key)> THEN 'value' ... ELSE 'default' END."""
    whens = " ".join(f"WHEN {subject_test.format(key=literal(k))} THEN {literal(v)}" for k, v in pairs)
    return f"CASE {whens} ELSE {literal(default)} END"


# Column expressions of the adapter views, as SQL text: one parse in the
# JVM per column instead of one Python-to-JVM call per sub-expression.
GAME_INFO_EXPRS = [
    "p_partkey AS game_id",
    "p_name AS game_name",
    "CASE WHEN p_partkey % 37 = 0 THEN -1 WHEN p_partkey % 11 = 0 THEN 0 "
    "ELSE CAST(floor(p_retailprice) AS INT) * 10 END AS price",
    "CASE WHEN p_partkey % 37 = 0 OR p_partkey % 11 = 0 THEN 0 WHEN p_partkey % 83 = 0 THEN 100 "
    "ELSE CAST((p_partkey % 5) * 15 AS INT) END "
    "AS discount_percentage",
    "CASE WHEN p_partkey % 23 = 0 THEN CAST(NULL AS STRING) WHEN p_partkey % 29 = 0 THEN '2023' "
    "ELSE concat('20', lpad(CAST(10 + p_partkey % 14 AS STRING), 2, '0'), '-', "
    "lpad(CAST(1 + p_size % 12 AS STRING), 2, '0')) END AS release_date",
    "concat('img/', CAST(p_partkey AS STRING), '.jpg') AS thumbnail_path",
    "CASE WHEN p_partkey % 41 = 0 THEN CAST(NULL AS STRING) ELSE concat("
    + _case("p_type = {key}", TYPE_GENRE, TYPE_GENRE_DEFAULT)
    + ", "
    + _case("endswith(p_name, {key})", NAME_SUFFIX_GENRE, "")
    + ") END AS genre",
    "CASE WHEN p_partkey % 43 = 0 THEN 0L ELSE coalesce(neg, 0L) END AS negative_cnt",
    "CASE WHEN p_partkey % 43 = 0 THEN 0L ELSE coalesce(pos, 0L) END AS positive_cnt",
]

COMMENT_DATA_EXPRS = [
    "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS comment_id",
    "l_partkey AS game_id",
    "CAST(l_suppkey AS STRING) AS user_id",
    "CAST(floor(l_extendedprice) AS BIGINT) AS total_playtime",
    "CAST(floor(l_quantity) AS BIGINT) AS last_two_weeks_playtime",
    "concat(l_returnflag, ' ', l_linestatus) AS comment_content",
    "CASE WHEN l_linestatus = 'O' THEN 'KOR' ELSE 'ENG' END AS language",
]


def review_counts(lineitem: DataFrame) -> DataFrame:
    """Per part: negative (returned) and positive line counts.

    A partial aggregate runs before the shuffle, so a hot part key sends one
    row per map partition.
    """
    return lineitem.groupBy(F.expr("l_partkey AS game_id")).agg(
        F.expr("CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT)").alias("neg"),
        F.expr("CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT)").alias("pos"),
    )


def game_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue view over part and lineitem."""
    # no explicit projection needed: Catalyst prunes both scans to the
    # columns the expressions use
    return game_info_from(read_table(spark, sf_dir, "part"), review_counts(read_table(spark, sf_dir, "lineitem")))


def game_info_from(part: DataFrame, counts: DataFrame) -> DataFrame:
    """Catalogue rows: one per part, review counts from its line items (a
    left join: a part without lines has 0/0)."""
    return part.join(counts, F.expr("p_partkey = game_id"), "left").selectExpr(*GAME_INFO_EXPRS)


def game_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily status view over events."""
    return game_status_from(read_table(spark, sf_dir, "events"))


def game_status_from(events: DataFrame) -> DataFrame:
    """One snapshot per (game, day): players = sum of whole event values.

    Some games have each snapshot twice, with one player more (repeated and
    tied days); some have no date on the first of a month.
    """
    per_day = events.groupBy(F.expr("user_id AS game_id"), F.expr("CAST(ts AS DATE) AS day")).agg(
        F.expr("sum(CAST(floor(value) AS BIGINT))").alias("players"),
        F.expr("count(1)").alias("review_cnt"),
    )
    return per_day.selectExpr(
        "game_id",
        "CASE WHEN game_id % 97 = 0 AND day(day) = 1 THEN CAST(NULL AS DATE) ELSE day END AS create_dt",
        "explode(CASE WHEN game_id % 89 = 0 THEN array(players, players + 1) ELSE array(players) END) AS user_cnt",
        "review_cnt",
    )


def comment_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review view over lineitem."""
    return comment_data_from(read_table(spark, sf_dir, "lineitem"))


def comment_data_from(lineitem: DataFrame) -> DataFrame:
    """One review per line item; the id repeats across lines on purpose."""
    return lineitem.selectExpr(*COMMENT_DATA_EXPRS)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "game_info": game_info(spark, sf_dir),
        "game_status": game_status(spark, sf_dir),
        "comment_data": comment_data(spark, sf_dir),
    }
