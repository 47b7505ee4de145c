"""Landed documents derived from the driver tables.

The store and player-count services are not reachable here; their documents
are produced by Spark from the driver tables so that the ingest operators
parse inputs whose size grows with the data. Each builder emits one bounded
document per key (a game, or a bounded page of a game's reviews), never a
whole group in one row.

Games of chosen id residues get the documents the ingest rules are about:
bodies that are not JSON, text after a valid document, entries under another
id, missing pages, a second count document, numbers written as strings.

Readers for landed documents written by someone else are at the bottom:
they expect a parquet or JSON-lines table with a ``body`` string column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.sources import driver

# Reviews on one page, on average, of a game and language with more of them.
REVIEW_PAGE_ROWS = 1000

# Apps on one popular-games document, at most.
POPULAR_PAGE_IDS = 500

NOT_JSON = "<html>busy</html>"

# Genre descriptions as the store writes them (with spaces),
# by part type and by the last word of the part name.
TYPE_GENRE_DESCRIPTION = [
    ("ECONOMY", "액션"),
    ("LARGE", "어드벤처"),
    ("MEDIUM", "대규모 멀티플레이어"),
    ("PROMO", "RPG"),
    ("SMALL", "캐주얼"),
]
TYPE_GENRE_DESCRIPTION_DEFAULT = "인디"
NAME_SUFFIX_GENRE_DESCRIPTION = [
    ("anvil", "전략"),
    ("bolt", "시뮬레이션"),
    ("gear", "스포츠"),
    ("gizmo", "인디"),
]


def _genre_struct(gid: str, desc) -> F.Column:
    return F.struct(F.lit(gid).alias("id"), desc.alias("description"))


def _case(pairs, test, default):
    expr = None
    for key, value in pairs:
        expr = F.when(test(key), F.lit(value)) if expr is None else expr.when(test(key), F.lit(value))
    return expr.otherwise(F.lit(default) if default is not None else F.lit(None).cast("string"))


def app_details_docs(part: DataFrame) -> DataFrame:
    """One app-details document per part, keyed by the id as a string.

    Document variants (by key residue): unsuccessful, not a game, free, no
    price overview, no discount, price without a space, coming soon, empty
    date, year-month date, no genres key, empty genres list.
    """
    pk = F.col("p_partkey")
    year = (2010 + pk % 14).cast("string")
    month = (1 + F.col("p_size") % 12).cast("string")
    day = (1 + pk % 28).cast("string")
    date_text = (
        F.when(pk % 23 == 0, F.lit(""))
        .when(pk % 29 == 0, F.concat(year, F.lit("년 "), month, F.lit("월")))
        .otherwise(F.concat(year, F.lit("년 "), month, F.lit("월 "), day, F.lit("일")))
    )
    amount = F.format_number(F.floor("p_retailprice") * 10, 0)
    formatted = F.when(pk % 59 == 0, F.concat(F.lit("₩"), amount)).otherwise(F.concat(F.lit("₩ "), amount))
    price_overview = F.when(pk % 37 == 0, F.lit(None)).otherwise(
        F.struct(
            formatted.alias("final_formatted"),
            F.when(pk % 31 == 0, F.lit(None).cast("string"))
            .when(pk % 83 == 0, F.lit("100"))
            .otherwise(((pk % 5) * 15).cast("string"))
            .alias("discount_percent"),
        )
    )
    first = _case(TYPE_GENRE_DESCRIPTION, lambda t: F.col("p_type") == t, TYPE_GENRE_DESCRIPTION_DEFAULT)
    second = _case(NAME_SUFFIX_GENRE_DESCRIPTION, lambda s: F.col("p_name").endswith(s), None)
    genres = (
        F.when(pk % 41 == 0, F.lit(None))
        .when(pk % 61 == 0, F.array().cast("array<struct<id:string,description:string>>"))
        .otherwise(
            F.filter(
                F.array(_genre_struct("1", first), _genre_struct("2", second)),
                lambda g: g["description"].isNotNull(),
            )
        )
    )
    data = F.struct(
        F.when(pk % 47 == 0, F.lit("dlc")).otherwise(F.lit("game")).alias("type"),
        F.concat(F.col("p_name"), F.lit(", "), F.col("p_brand")).alias("name"),
        (pk % 11 == 0).alias("is_free"),
        price_overview.alias("price_overview"),
        F.struct((pk % 19 == 0).alias("coming_soon"), date_text.alias("date")).alias("release_date"),
        F.concat(F.lit("img/"), pk.cast("string"), F.lit(".jpg")).alias("capsule_image"),
        genres.alias("genres"),
    )
    entry = F.struct((pk % 53 != 0).alias("success"), data.alias("data"))
    key = F.when(pk % 73 == 0, (pk + 1).cast("string")).otherwise(pk.cast("string"))
    text = F.to_json(F.create_map(key, entry))
    # two of three documents write the discount as a number
    number = F.regexp_replace(text, r'"discount_percent":"(\d+)"', r'"discount_percent":$1')
    body = (
        F.when((pk % 67 == 0) & (pk % 2 == 0), F.lit(NOT_JSON))
        .when(pk % 67 == 0, F.translate(text, '"', "'"))
        .when((pk % 71 == 0) & (pk % 2 == 0), F.concat(text, F.lit(" <html>")))
        .when(pk % 71 == 0, F.concat(text, F.lit("] <html>")))
        .when(pk % 3 == 0, text)
        .otherwise(number)
    )
    return part.select(pk.alias("game_id"), body.alias("body"))


def review_summary_docs(lineitem: DataFrame) -> DataFrame:
    """One review-summary document per part with line counts. Some write the
    counts as strings, some lack the id."""
    counts = driver.review_counts(lineitem)
    summary = F.struct(
        F.when(F.col("game_id") % 101 != 0, F.col("game_id")).alias("appid"),
        F.col("pos").cast("string").alias("positive"),
        F.col("neg").alias("negative"),
    )
    return counts.select("game_id", F.to_json(summary).alias("body"))


def player_count_docs(events: DataFrame) -> DataFrame:
    """Current-player documents: the sum of whole event values of a game.

    Some games answer without a count, some with text that is not JSON (also
    a document in single quotes, or one followed by text), and some have a
    second document with one player less.
    """
    per_game = events.filter("user_id IS NOT NULL").groupBy(F.col("user_id").alias("game_id")).agg(
        F.sum(F.floor("value").cast("bigint")).alias("n")
    )
    # a NULL field is left out of the JSON text: {"response": {}}
    document = "to_json(struct(struct(CASE WHEN game_id % 7 <> 0 THEN {n} END AS player_count) AS response))"
    bad = (
        f"CASE game_id % 3 WHEN 0 THEN '{NOT_JSON}' WHEN 1 THEN translate({document.format(n='n + 1')}, '\"', '\\'') "
        f"ELSE concat({document.format(n='n + 1')}, '] <html>') END"
    )
    first = f"CASE WHEN game_id % 13 = 0 THEN {bad} ELSE {document.format(n='n')} END"
    second = document.format(n="CAST(n - 1 AS STRING)")
    return per_game.selectExpr(
        "game_id", f"explode(CASE WHEN game_id % 9 = 0 THEN array({first}, {second}) ELSE array({first}) END) AS body"
    )


def review_page_docs(lineitem: DataFrame) -> DataFrame:
    """Review pages per (game, language, page): each line item is a review.

    A game's reviews in a language are dealt over as many pages as they fill,
    by a hash of the review and its row (stable on recomputation of a file
    scan), so a page stays bounded, however many reviews or copies of one
    review a game has. A language without reviews has an empty page, except
    for games that lack their English pages altogether; some games have a
    page that is not JSON or has text after its document. Review text
    carries a newline or a comma between its two words.
    """
    li = lineitem.select(
        F.col("l_partkey").alias("game_id"),
        F.expr("CASE WHEN l_linestatus = 'O' THEN 'KOR' ELSE 'ENG' END").alias("language"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus",
        F.xxhash64("l_orderkey", "l_linenumber", F.monotonically_increasing_id()).alias("deal"),
    )
    sizes = li.groupBy("game_id", "language").agg(F.expr(f"ceil(count(1) / {REVIEW_PAGE_ROWS})").alias("pages"))
    sep = F.when(F.col("l_linenumber") % 2 == 0, F.lit("\n")).otherwise(F.lit(","))
    review = F.struct(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("recommendationid"),
        F.struct(
            F.col("l_suppkey").cast("string").alias("steamid"),
            F.floor("l_extendedprice").cast("string").alias("playtime_forever"),
            F.floor("l_quantity").cast("bigint").alias("playtime_last_two_weeks"),
        ).alias("author"),
        F.concat(F.col("l_returnflag"), sep, F.col("l_linestatus")).alias("review"),
    )
    pages = (
        li.join(sizes, ["game_id", "language"])
        .groupBy("game_id", "language", F.pmod("deal", "pages").alias("page_no"))
        .agg(F.collect_list(review).alias("reviews"))
        .select("game_id", "language", "page_no", F.to_json(F.struct("reviews")).alias("body"))
    )
    empty = '{"reviews":[]}'
    extra = sizes.groupBy("game_id").agg(F.collect_set("language").alias("have"))  # at most both languages
    extra = extra.selectExpr(
        "game_id",
        "inline(concat("
        f"transform(array_except(array('KOR', 'ENG'), have), l -> struct(l AS language, -1L AS page_no, '{empty}' AS body)), "
        f"CASE WHEN game_id % 71 = 0 THEN array(struct('KOR' AS language, -2L AS page_no, "
        f"if(game_id % 2 = 0, '{NOT_JSON}', '{{\\'reviews\\':[]}}') AS body)) ELSE array() END, "
        f"CASE WHEN game_id % 73 = 0 THEN array(struct('ENG' AS language, -2L AS page_no, "
        f"concat('{empty}', if(game_id % 2 = 0, '', ']'), ' <html>') AS body)) ELSE array() END))",
    )
    return pages.unionByName(extra).filter("NOT (game_id % 67 = 0 AND language = 'ENG')")


def popular_docs(events: DataFrame) -> DataFrame:
    """Popular-games documents: every app active on a day, as {"<id>":
    {"appid": id, "name": ...}}, with id = 17 * user id, so some ids are new
    to the catalogue. A day's apps are cut into documents of at most
    POPULAR_PAGE_IDS entries by their ids. Odd ids are written as strings."""
    per_app = events.filter("user_id IS NOT NULL").select(F.expr("CAST(ts AS DATE) AS day"), "user_id").distinct()
    entry = F.expr(
        "struct(CAST(user_id * 17 AS STRING) AS key, named_struct('appid', CAST(user_id * 17 AS STRING), "
        "'name', concat('app ', CAST(user_id AS STRING))) AS value)"
    )
    text = F.to_json(F.map_from_entries("entries"))
    return (
        per_app.groupBy("day", F.expr(f"user_id DIV {POPULAR_PAGE_IDS}").alias("page"))
        .agg(F.collect_list(entry).alias("entries"))
        .select(F.regexp_replace(text, r'"appid":"(\d*[02468])"', r'"appid":$1').alias("body"))
    )


# Which builder makes each landed input, from which driver table.
BUILDERS = {
    "app_details": (app_details_docs, "part"),
    "review_summary": (review_summary_docs, "lineitem"),
    "player_counts": (player_count_docs, "events"),
    "review_pages": (review_page_docs, "lineitem"),
    "popular": (popular_docs, "events"),
}


def spread(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` over at least as many tasks as there are cores: the reader
    gives a small file to one task, and documents cost far more to make and
    parse than the bytes they are made from."""
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One landed input derived from the driver tables."""
    build, table = BUILDERS[name]
    rows = driver.read_table(spark, sf_dir, table)
    return build(spread(spark, rows) if table == "part" else rows)


def landed_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: landed(spark, sf_dir, name) for name in BUILDERS}


# --------------------------------------------------------------------------
# Readers of landed documents
# --------------------------------------------------------------------------


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        # JSON lines with a game_id and the raw document as a string
        return spark.read.schema("game_id BIGINT, language STRING, page_no BIGINT, body STRING").json(path)
    raise ValueError(fmt)
