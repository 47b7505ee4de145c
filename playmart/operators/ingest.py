"""Ingest operators: landed JSON documents -> typed raw-table batches.

Every landed input is a table of (game_id, ..., body STRING). Bodies are
parsed once with ``from_json`` and an explicit schema, inside a generator, so
that later rules work on the parsed value; records are flattened with
built-in functions. A body that is not exactly one JSON document counts as a
fetch error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart import schemas
from playmart.functions import scalars
from playmart.functions.sqltext import date_text


# Follows the body in its wrapper; a body that holds it is no document.
_END = "end of the wrapped body"


def document_sql(schema: T.DataType) -> str:
    """SQL of an array: the parsed ``body``, or empty if the body is not
    exactly one JSON document (also when text follows a valid one, or when
    strings stand in single quotes; ``NaN`` is a number, as in the decoder
    the documents were made for).

    The body stands in an array of one element, and a second field follows
    the array: a bracket in the body that closes the wrapper early hides that
    field.
    """
    wrapper = f"struct<doc: array<{schema.simpleString()}>, `{_END}`: boolean>"
    wrapped = f"""concat('{{"doc":[', body, '],"{_END}":true}}')"""
    parsed = f"from_json({wrapped}, '{wrapper}', map('allowSingleQuotes', 'false'))"
    whole = f"w.`{_END}` AND size(w.doc) = 1 AND w.doc[0] IS NOT NULL AND NOT contains(body, '{_END}')"
    return f"flatten(transform(filter(array({parsed}), w -> {whole}), w -> w.doc))"


def documents(docs: DataFrame, schema: T.DataType, *columns: str) -> DataFrame:
    """``columns`` and the parsed ``doc`` of the valid documents."""
    return docs.select(*columns, F.explode(F.expr(document_sql(schema))).alias("doc"))


def checked_documents(docs: DataFrame, schema: T.DataType, *columns: str) -> DataFrame:
    """``columns``, whether the body is ``valid``, and the parsed ``doc``
    (NULL if it is not); one row per document."""
    row = f"transform(array({document_sql(schema)}), a -> struct(size(a) = 1 AS valid, get(a, 0) AS doc))"
    return docs.select(*columns, F.explode(F.expr(row)).alias("r")).select(*columns, "r.valid", "r.doc")


def integer(text: Column | str) -> Column:
    """BIGINT of a JSON number or of a JSON string holding one."""
    return F.expr(scalars.integer_sql(text))


# --------------------------------------------------------------------------
# Candidate ids = known ids + popular ids not yet known
# --------------------------------------------------------------------------


def popular_ids(popular_docs: DataFrame) -> DataFrame:
    """Ids listed as map values of the popular-games documents.

    Keys and ``appid`` values may be strings or numbers in the source; both
    are normalised to BIGINT so the anti-join compares like with like.
    """
    infos = documents(popular_docs, schemas.POPULAR_BODY).select(F.explode(F.map_values("doc")).alias("info"))
    return infos.select(integer("info.appid").alias("game_id")).filter(F.col("game_id").isNotNull()).distinct()


def game_candidates(known_ids: DataFrame, popular_docs: DataFrame) -> DataFrame:
    known = known_ids.select(F.col("game_id").cast("bigint").alias("game_id"))
    new = popular_ids(popular_docs).join(known, "game_id", "left_anti")
    return known.unionByName(new)


# --------------------------------------------------------------------------
# Ids with their total review count
# --------------------------------------------------------------------------


def game_review_totals(game_info: DataFrame) -> DataFrame:
    return game_info.select("game_id", (F.col("positive_cnt") + F.col("negative_cnt")).alias("review_cnt"))


# --------------------------------------------------------------------------
# game_info batch from app details (S1) and review summaries
# --------------------------------------------------------------------------


def parse_review_summaries(summary_docs: DataFrame) -> DataFrame:
    """(game_id, body) -> (requested_id, game_id, positive_cnt, negative_cnt).

    ``requested_id`` is the id the document was fetched for; ``game_id`` is
    the id the summary reports, which is the id the catalogue record gets. A
    summary without an id is dropped.
    """
    found = documents(summary_docs, schemas.REVIEW_SUMMARY_BODY, "game_id")
    return found.select(
        F.col("game_id").alias("requested_id"),
        integer("doc.appid").alias("game_id"),
        integer("doc.positive").alias("positive_cnt"),
        integer("doc.negative").alias("negative_cnt"),
    ).filter(F.col("game_id").isNotNull())


def parse_app_details(details_docs: DataFrame) -> DataFrame:
    """(game_id, body) -> flattened game records (without review counts).

    Rules: keep a document only if it is JSON, has an entry under its own id,
    ``success`` and ``type == 'game'``. A game still coming soon keeps only
    its id (all detail columns NULL). A released game without a ``genres``
    key is dropped; an empty list gives ''. Price: free -> 0/0; missing
    price or discount -> -1/0; otherwise the parsed price and the discount.
    """
    recs = (
        documents(details_docs, schemas.APP_DETAILS_BODY, "game_id")
        .select("game_id", F.explode("doc").alias("key", "e"))
        .filter("key = CAST(game_id AS STRING)")
        .selectExpr(
            "game_id",
            "e.data AS d",
            "coalesce(e.success, false) AS success",
            "coalesce(e.data.release_date.coming_soon, false) AS coming_soon",
        )
        .filter("success AND d.type = 'game' AND (coming_soon OR d.genres IS NOT NULL)")
    )
    free = "coalesce(d.is_free, false)"
    missing = "(d.is_free IS NULL OR d.price_overview.final_formatted IS NULL OR d.price_overview.discount_percent IS NULL)"
    price = (
        f"CASE WHEN {free} THEN 0 WHEN {missing} THEN -1 "
        f"ELSE {scalars.parse_price_sql('d.price_overview.final_formatted')} END"
    )
    discount = (
        f"CASE WHEN {free} OR {missing} THEN 0 ELSE {scalars.integer_sql('d.price_overview.discount_percent', 'INT')} END"
    )

    def detail(expr: str, name: str) -> str:
        return f"CASE WHEN coming_soon THEN NULL ELSE {expr} END AS {name}"

    return recs.selectExpr(
        "game_id",
        detail(scalars.clean_game_name_sql("d.name"), "game_name"),
        detail(price, "price"),
        detail(discount, "discount_percentage"),
        detail(scalars.parse_release_month_sql("d.release_date.date"), "release_date"),
        detail("d.capsule_image", "thumbnail_path"),
        detail(scalars.fold_genres_sql("d.genres"), "genre"),
    )


def ingest_game_info(candidates: DataFrame, details_docs: DataFrame, summary_docs: DataFrame) -> DataFrame:
    """Candidates joined with their parsed details and review summaries.

    All three inputs hold about one row per game, so the joins are game-to-
    game; which side is broadcast is left to AQE's measured sizes.
    """
    details = parse_app_details(details_docs.join(candidates.select("game_id"), "game_id", "left_semi"))
    summary = parse_review_summaries(summary_docs).withColumnRenamed("game_id", "summary_id")
    joined = details.join(summary, details["game_id"] == summary["requested_id"], "inner")
    return joined.drop("game_id").withColumnRenamed("summary_id", "game_id").select(*schemas.COLUMNS["game_info"])


# --------------------------------------------------------------------------
# One status slice per run date from player-count documents (S3)
# --------------------------------------------------------------------------


def parse_player_counts(count_docs: DataFrame, *keys: str) -> DataFrame:
    """(game_id, body) -> (game_id, player_count), one row per game (and
    further ``keys``): the largest count of its documents. A game whose
    documents lack the count, or are not JSON, reports 0; documents without
    a game id are dropped."""
    found = checked_documents(count_docs, schemas.PLAYER_COUNT_BODY, "game_id", *keys).filter("game_id IS NOT NULL")
    count = integer("doc.response.player_count")
    return found.groupBy("game_id", *keys).agg(F.coalesce(F.max(count), F.lit(0).cast("bigint")).alias("player_count"))


def _status_rows(games: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    return games.join(counts, keys, "left").select(
        "game_id",
        "create_dt",
        F.coalesce("player_count", F.lit(0).cast("bigint")).alias("user_cnt"),
        F.col("review_cnt").cast("bigint").alias("review_cnt"),
    )


def ingest_game_status(review_totals: DataFrame, count_docs: DataFrame, as_of) -> DataFrame:
    """Every known game gets a row for ``as_of``; a game without a player
    count document gets 0 (left join, default 0)."""
    games = review_totals.withColumn("create_dt", F.lit(date_text(as_of)).cast("date"))
    return _status_rows(games, parse_player_counts(count_docs), ["game_id"])


def ingest_status_days(review_totals: DataFrame, count_docs: DataFrame, days: list[str]) -> DataFrame:
    """The slices of several days at once, from documents dated ``dt``."""
    every_day = F.array(*[F.lit(d).cast("date") for d in days])
    games = review_totals.withColumn("create_dt", F.explode(every_day))
    counts = parse_player_counts(count_docs, "dt").withColumnRenamed("dt", "create_dt")
    return _status_rows(games, counts, ["game_id", "create_dt"])


# --------------------------------------------------------------------------
# comment_data batch from review pages
# --------------------------------------------------------------------------


def parse_review_pages(review_pages: DataFrame) -> DataFrame:
    """(game_id, language, valid, reviews, bad_body) of every page, parsed
    once; ``bad_body`` is the body of a page that is not valid."""
    parsed = checked_documents(review_pages, schemas.REVIEW_PAGE_BODY, "game_id", "language", "body")
    bad = F.when(~F.col("valid"), F.col("body"))
    return parsed.select("game_id", "language", "valid", F.col("doc.reviews").alias("reviews"), bad.alias("bad_body"))


def usable_games(parsed_pages: DataFrame) -> DataFrame:
    """Games whose pages are all valid and which have pages in every fetched
    language; one partial count per game before the shuffle."""
    every = " AND ".join(f"bool_or(language = '{code}')" for code in schemas.LANGUAGES)
    per_game = parsed_pages.groupBy("game_id").agg(F.expr(f"bool_and(valid) AND {every}").alias("usable"))
    return per_game.filter("usable").select("game_id")


def ingest_comment_data(game_ids: DataFrame, parsed_pages: DataFrame) -> DataFrame:
    """Pages of ``parse_review_pages`` -> one row per review.

    The pages of a game are fetched together: a game is skipped entirely if
    one of its pages is not JSON or a language has no page. The check reads
    two small columns, so pass pages that were written once (the pipeline
    stages them); pages are filtered before they are exploded, so exploded
    reviews are never shuffled. A page that is JSON but not a review page
    contributes no reviews. Languages are concatenated as a bag: a review on
    both pages yields two rows.
    """
    pages = parsed_pages.join(game_ids.select("game_id"), "game_id", "left_semi")
    good = pages.join(usable_games(pages.select("game_id", "language", "valid")), "game_id", "left_semi")
    return good.select("game_id", "language", F.explode("reviews").alias("r")).select(
        F.col("r.recommendationid").alias("comment_id"),
        F.col("game_id").cast("bigint").alias("game_id"),
        F.col("r.author.steamid").alias("user_id"),
        integer("r.author.playtime_forever").alias("total_playtime"),
        integer("r.author.playtime_last_two_weeks").alias("last_two_weeks_playtime"),
        scalars.clean_review_text("r.review").alias("comment_content"),
        "language",
    )


# --------------------------------------------------------------------------
# Ingest report: counts of the documents each rule dropped or defaulted
# (the fields that became NULL or 0 instead of failing the batch)
# --------------------------------------------------------------------------


def _metric_rows(source: str, counts: DataFrame, metrics: list[str]) -> DataFrame:
    rows = ", ".join(f"struct('{source}' AS source, '{m}' AS metric, CAST({m} AS BIGINT) AS value)" for m in metrics)
    return counts.selectExpr(f"inline(array({rows}))")


def details_report(details_docs: DataFrame) -> DataFrame:
    """App-details documents: total, not JSON, no entry under their own id,
    rejected (not a successful game), coming soon (kept with id only),
    dropped for a missing genres key, unparsable price, unparsable date."""
    rules = details_rules(details_docs)
    counts = rules.selectExpr("count(1) AS documents", *[f"count_if({m}) AS {m}" for m in DETAILS_METRICS])
    return _metric_rows("app_details", counts, ["documents", *DETAILS_METRICS])


DETAILS_METRICS = ["not_json", "no_entry", "rejected", "coming_soon", "no_genres", "price_unparsed", "date_unparsed"]


def details_rules(details_docs: DataFrame) -> DataFrame:
    """(game_id, body) and one flag per metric of every app-details document."""
    parsed = checked_documents(details_docs, schemas.APP_DETAILS_BODY, "game_id", "body")
    flags = parsed.selectExpr("game_id", "body", "valid AS json", "doc[CAST(game_id AS STRING)] AS e").selectExpr(
        "game_id",
        "body",
        "json",
        "e IS NOT NULL AS has_entry",
        "e IS NOT NULL AND coalesce(e.success, false) AND coalesce(e.data.type = 'game', false) AS accepted",
        "coalesce(e.data.release_date.coming_soon, false) AS coming",
        "e.data AS d",
    )
    kept = "accepted AND (coming OR d.genres IS NOT NULL)"
    priced = (
        "NOT coalesce(d.is_free, false) AND d.is_free IS NOT NULL AND d.price_overview.final_formatted IS NOT NULL "
        "AND d.price_overview.discount_percent IS NOT NULL"
    )
    return flags.selectExpr(
        "game_id",
        "body",
        "NOT json AS not_json",
        "json AND NOT has_entry AS no_entry",
        "has_entry AND NOT accepted AS rejected",
        "accepted AND coming AS coming_soon",
        "accepted AND NOT coming AND d.genres IS NULL AS no_genres",
        f"{kept} AND NOT coming AND {priced} "
        f"AND {scalars.parse_price_sql('d.price_overview.final_formatted')} IS NULL AS price_unparsed",
        f"{kept} AND NOT coming AND coalesce(d.release_date.date, '') <> '' "
        f"AND {scalars.parse_release_month_sql('d.release_date.date')} IS NULL AS date_unparsed",
    )


def player_counts_report(count_docs: DataFrame) -> DataFrame:
    """Player-count documents: total, not JSON, JSON without a count (both
    give 0 players)."""
    rules = player_count_rules(count_docs)
    counts = rules.selectExpr("count(1) AS documents", "count_if(not_json) AS not_json", "count_if(no_count) AS no_count")
    return _metric_rows("player_counts", counts, ["documents", "not_json", "no_count"])


def player_count_rules(count_docs: DataFrame) -> DataFrame:
    """(game_id, body) and one flag per metric of every player-count document."""
    parsed = checked_documents(count_docs, schemas.PLAYER_COUNT_BODY, "game_id", "body")
    n = integer("doc.response.player_count")
    return parsed.select("game_id", "body", (~F.col("valid")).alias("not_json"), (F.col("valid") & n.isNull()).alias("no_count"))


def review_pages_report(parsed_pages: DataFrame) -> DataFrame:
    """Parsed review pages: games with pages, pages that are not JSON, and
    games dropped for such a page or for a language without a page (a partial
    count per game before the shuffle)."""
    every = " AND ".join(f"bool_or(language = '{code}')" for code in schemas.LANGUAGES)
    per_game = parsed_pages.groupBy("game_id").agg(
        F.expr("count_if(NOT valid)").alias("bad"), F.expr(f"bool_and(valid) AND {every}").alias("usable")
    )
    counts = per_game.selectExpr(
        "count(1) AS games", "coalesce(sum(bad), 0) AS not_json", "count_if(NOT usable) AS games_dropped"
    )
    return _metric_rows("review_pages", counts, ["games", "not_json", "games_dropped"])


def ingest_report(details_docs: DataFrame, count_docs: DataFrame, parsed_pages: DataFrame) -> DataFrame:
    """(source, metric, value) rows for the three document sources."""
    return (
        details_report(details_docs)
        .unionByName(player_counts_report(count_docs))
        .unionByName(review_pages_report(parsed_pages))
    )
