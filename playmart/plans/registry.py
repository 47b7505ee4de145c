"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the oracle
SQL for each name. Every query reads the driver tables of ``sf_dir`` whole
(through the adapter views), never a subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart import schemas
from playmart.functions import scalars
from playmart.operators import dashboard, ingest, models, quality
from playmart.plans import incremental, oracle, pipeline
from playmart.session import scratch_path
from playmart.sources import driver, landing, warehouse

# Run date of the registered ingest queries (a parameter of the daily run,
# inside the span of the driver's event table).
AS_OF = "2024-01-15"

# Names with line breaks, quotes and commas for the CSV round trip.
CSV_NAME = (
    "CASE game_id % 4 WHEN 0 THEN game_name WHEN 1 THEN concat(game_name, '\\n', 'two') "
    "WHEN 2 THEN concat(game_name, '\\r', ', \"b\"') ELSE concat('\\r\\n', game_name, ' ') END"
)

Query = Callable[[SparkSession, str], DataFrame]


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return models.fact_game_playtime(driver.comment_data(spark, sf), driver.game_info(spark, sf))


def _genre_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return models.analytics_genre_comment_ratio(driver.game_info(spark, sf))


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return driver.raw_tables(spark, sf)


_DQ = {
    "dq_unique_game_id": ("game_info", "game_id", "unique"),
    "dq_unique_comment_id": ("comment_data", "comment_id", "unique"),
    "dq_not_null_game_info_game_id": ("game_info", "game_id", "not_null"),
    "dq_not_null_game_status_game_id": ("game_status", "game_id", "not_null"),
    "dq_not_null_comment_data_comment_id": ("comment_data", "comment_id", "not_null"),
}


def _dq_query(table: str, column: str, kind: str) -> Query:
    """Failing rows of one column test over one adapter view."""
    test = quality.ColumnTest(f"{kind}_{table}_{column}", kind, table, column)
    reader = getattr(driver, table)
    return lambda spark, sf: quality.failures(test, {table: reader(spark, sf)})


def _dq_oracle(table: str, column: str, kind: str) -> str:
    return oracle.unique_sql(table, column) if kind == "unique" else oracle.not_null_sql(table, column)


def _landed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return landing.landed(spark, sf, name)


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.game_candidates(driver.game_info(spark, sf).select("game_id"), _landed(spark, sf, "popular"))


def _parse_game_details(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest_game_info(
        _candidates(spark, sf), _landed(spark, sf, "app_details"), _landed(spark, sf, "review_summary")
    )


def _status_batch(spark: SparkSession, sf: str) -> DataFrame:
    totals = ingest.game_review_totals(driver.game_info(spark, sf))
    return ingest.ingest_game_status(totals, _landed(spark, sf, "player_counts"), AS_OF)


def _parsed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Review pages landed and parsed once, as the pipeline stages them."""
    path = scratch_path(spark, "review-pages")
    ingest.parse_review_pages(_landed(spark, sf, "review_pages")).write.parquet(path)
    return spark.read.parquet(path)


def _parse_reviews(spark: SparkSession, sf: str) -> DataFrame:
    ids = driver.game_info(spark, sf).select("game_id")
    return ingest.ingest_comment_data(ids, _parsed_pages(spark, sf))


def _status_slice_replace(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.replace_slice(driver.game_status(spark, sf), _status_batch(spark, sf), AS_OF)


def _load_full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Two full refreshes, the second from the table itself -> read back."""
    root = scratch_path(spark, "warehouse")
    warehouse.full_refresh(spark, _parse_game_details(spark, sf), "game_info", root)
    warehouse.full_refresh(spark, warehouse.read_current(spark, "game_info", root), "game_info", root)
    return warehouse.read_current(spark, "game_info", root)


def _status_slice_storage(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table: all days, then the day's slice loaded twice."""
    path = scratch_path(spark, "game_status")
    warehouse.write_days(driver.game_status(spark, sf), path)
    staged = scratch_path(spark, "slice")
    _status_batch(spark, sf).write.parquet(staged)
    for _ in range(2):
        warehouse.write_slice(spark.read.schema(schemas.GAME_STATUS).parquet(staged), path, AS_OF)
    return warehouse.read_partitioned(spark, path, schemas.GAME_STATUS)


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """game_info, with line breaks in names -> the day's staged CSV key ->
    read by position."""
    stage = scratch_path(spark, "stage")
    names = driver.game_info(spark, sf).withColumn("game_name", F.expr(CSV_NAME))
    pipeline.write_staged_day({"game_info": names}, stage, AS_OF)
    return warehouse.read_staged_csv(spark, pipeline.staged_csv_key(stage, "game_info", AS_OF), schemas.GAME_INFO)


QUERIES: dict[str, Query] = {
    # M1-M3
    "src_game_info": lambda spark, sf: models.src_game_info(driver.game_info(spark, sf)),
    "src_game_status": lambda spark, sf: models.src_game_status(driver.game_status(spark, sf)),
    "src_comment_data": lambda spark, sf: models.src_comment_data(driver.comment_data(spark, sf)),
    # M4
    "fact_game_playtime": _fact,
    # M5
    "analytics_genre_comment_ratio": _genre_ratio,
    # M6
    "analytics_genre_playtime": lambda spark, sf: models.analytics_genre_playtime(_fact(spark, sf)),
    "analytics_genre_playtime_filtered": lambda spark, sf: models.analytics_genre_playtime(
        _fact(spark, sf), filter_first_label=True
    ),
    # M7
    "analytics_release_date": lambda spark, sf: models.analytics_release_date(
        driver.game_info(spark, sf), driver.comment_data(spark, sf), driver.game_status(spark, sf)
    ),
    # M8
    "analytics_usercnt_price": lambda spark, sf: models.analytics_usercnt_price(
        driver.game_info(spark, sf), driver.game_status(spark, sf)
    ),
    # Every snapshot row of each game's latest day (ties kept)
    "latest_status_rows": lambda spark, sf: models.latest_status(driver.game_status(spark, sf)),
    # All next-day pairs with both differences
    "next_day_pairs": lambda spark, sf: models.next_day_pairs(driver.game_status(spark, sf), driver.game_info(spark, sf)),
    # M9, M10
    "daily_user_login_cnt_diff_top15": lambda spark, sf: models.daily_user_login_cnt_diff_top15(
        driver.game_status(spark, sf), driver.game_info(spark, sf)
    ),
    "daily_user_review_cnt_diff_top15": lambda spark, sf: models.daily_user_review_cnt_diff_top15(
        driver.game_status(spark, sf), driver.game_info(spark, sf)
    ),
    # Q-U, Q-N, Q-G input
    **{name: _dq_query(*spec) for name, spec in _DQ.items()},
    "dq_test_results": lambda spark, sf: quality.test_results(_tables(spark, sf)),
    # D1, D2
    "top_games_by_playtime": lambda spark, sf: dashboard.top_games_by_playtime(_fact(spark, sf), "sum_total_playtime"),
    "top_games_by_recent_playtime": lambda spark, sf: dashboard.top_games_by_playtime(
        _fact(spark, sf), "sum_last_two_weeks_playtime"
    ),
    "genre_review_share": lambda spark, sf: dashboard.genre_review_share(_genre_ratio(spark, sf)),
    # S7, P5
    "game_review_totals": lambda spark, sf: ingest.game_review_totals(driver.game_info(spark, sf)),
    # X10
    "clean_review_text": lambda spark, sf: driver.read_table(spark, sf, "conversations").select(
        "conv_id", "turn", scalars.clean_review_text("text").alias("comment_content")
    ),
    # J6, U5, F10, K5
    "game_candidates": _candidates,
    # Ids listed on the popular-games documents
    "popular_ids": lambda spark, sf: ingest.popular_ids(_landed(spark, sf, "popular")),
    # App details alone
    "app_details": lambda spark, sf: ingest.parse_app_details(_landed(spark, sf, "app_details")),
    # Current-player documents, a missing count read as 0
    "player_counts": lambda spark, sf: ingest.parse_player_counts(_landed(spark, sf, "player_counts")),
    # Review summaries
    "review_summaries": lambda spark, sf: ingest.parse_review_summaries(_landed(spark, sf, "review_summary")),
    # I1 (S1, S2, F1-F4, F12, F13, X9, X11-X15, K1, K2, K4)
    "parse_game_details": _parse_game_details,
    # I2 (S3, J7, F11, P9)
    "parse_player_counts": _status_batch,
    # I3 (S4, F4, K3, X10, U4)
    "parse_reviews": _parse_reviews,
    # S12, F9
    "status_slice_replace": _status_slice_replace,
    "status_slice_storage": _status_slice_storage,
    # S11, S13
    "load_full_refresh": _load_full_refresh,
    # S8, S9
    "csv_round_trip": _csv_round_trip,
    # M4, A1 / M7, A2-A4 from kept per-game sums, after a slice was replaced
    "fact_incremental": incremental.fact_incremental,
    "release_date_incremental": lambda spark, sf: incremental.release_date_incremental(spark, sf, AS_OF),
    # M4 and M7 over tables bucketed by game
    "fact_aligned": incremental.fact_aligned,
    "release_date_aligned": incremental.release_date_aligned,
    # M9, M10 from kept partitions, after a day was replaced
    "movers_incremental": lambda spark, sf: incremental.movers_incremental(
        spark, sf, "daily_user_login_cnt_diff_top15", AS_OF
    ),
    "review_movers_incremental": lambda spark, sf: incremental.movers_incremental(
        spark, sf, "daily_user_review_cnt_diff_top15", AS_OF
    ),
    # Q-U, A9 against a stored key index: the whole table, and one batch
    "dq_unique_incremental": incremental.unique_incremental,
    "dq_unique_batch": incremental.unique_batch,
    # S12 by the manifest of staged files, with late files
    "status_manifest_load": incremental.status_manifest_load,
    # A whole run, published by one log entry
    "published_catalogue": lambda spark, sf: incremental.published_catalogue(spark, sf, AS_OF),
    # Q-G: the gate with a test that fails
    "dq_gate_verdict": incremental.gate_verdict,
    # The documents kept in quarantine, by source and rule
    "quarantine_counts": incremental.quarantine_counts,
    # Q12: counts of documents each ingest rule dropped or defaulted
    "ingest_report": lambda spark, sf: ingest.ingest_report(
        _landed(spark, sf, "app_details"), _landed(spark, sf, "player_counts"), _parsed_pages(spark, sf)
    ),
}

ORACLE: dict[str, str] = {
    "src_game_info": oracle.src_sql("game_info"),
    "src_game_status": oracle.src_sql("game_status"),
    "src_comment_data": oracle.src_sql("comment_data"),
    "fact_game_playtime": oracle.with_views("SELECT * FROM fact", "fact"),
    "analytics_genre_comment_ratio": oracle.genre_comment_ratio_sql(),
    "analytics_genre_playtime": oracle.genre_playtime_sql(),
    "analytics_genre_playtime_filtered": oracle.genre_playtime_sql(filter_first_label=True),
    "analytics_release_date": oracle.RELEASE_DATE_SQL,
    "analytics_usercnt_price": oracle.USERCNT_PRICE_SQL,
    "latest_status_rows": oracle.LATEST_STATUS_SQL,
    "next_day_pairs": oracle.with_views("SELECT * FROM pairs", "pairs"),
    "daily_user_login_cnt_diff_top15": oracle.LOGIN_DIFF_SQL,
    "daily_user_review_cnt_diff_top15": oracle.REVIEW_DIFF_SQL,
    **{name: _dq_oracle(*spec) for name, spec in _DQ.items()},
    "dq_test_results": oracle.dq_results_sql([(t.name, t.kind, t.model, t.column) for t in quality.SOURCE_TESTS]),
    "top_games_by_playtime": oracle.top_games_sql("sum_total_playtime", 10),
    "top_games_by_recent_playtime": oracle.top_games_sql("sum_last_two_weeks_playtime", 10),
    "genre_review_share": oracle.genre_review_share_sql(),
    "game_review_totals": oracle.GAME_REVIEW_TOTALS_SQL,
    "clean_review_text": oracle.CLEAN_REVIEW_TEXT_SQL,
    "game_candidates": oracle.GAME_CANDIDATES_SQL,
    "popular_ids": oracle.POPULAR_IDS_SQL,
    "app_details": oracle.APP_DETAILS_SQL,
    "player_counts": "WITH player_counts AS ("
    + oracle.PLAYER_COUNTS_VIEW
    + "\n)\nSELECT game_id, CAST(player_count AS BIGINT) AS player_count FROM player_counts",
    "review_summaries": oracle.REVIEW_SUMMARIES_SQL,
    "parse_game_details": oracle.PARSE_GAME_DETAILS_SQL,
    "parse_player_counts": oracle.parse_player_counts_sql(AS_OF),
    "parse_reviews": oracle.PARSE_REVIEWS_SQL,
    "status_slice_replace": oracle.status_slice_replace_sql(AS_OF),
    "status_slice_storage": oracle.status_slice_replace_sql(AS_OF),
    "load_full_refresh": oracle.PARSE_GAME_DETAILS_SQL,
    "csv_round_trip": oracle.CSV_ROUND_TRIP_SQL,
    "fact_incremental": oracle.with_views("SELECT * FROM fact", "fact"),
    "release_date_incremental": oracle.RELEASE_DATE_SQL,
    "fact_aligned": oracle.with_views("SELECT * FROM fact", "fact"),
    "release_date_aligned": oracle.RELEASE_DATE_SQL,
    "movers_incremental": oracle.LOGIN_DIFF_SQL,
    "review_movers_incremental": oracle.REVIEW_DIFF_SQL,
    "dq_unique_incremental": oracle.unique_sql("comment_data", "comment_id"),
    "dq_unique_batch": oracle.unique_batch_sql(incremental.BATCHES, 3),
    "status_manifest_load": oracle.src_sql("game_status"),
    "published_catalogue": oracle.published_catalogue_sql(),
    "dq_gate_verdict": oracle.GATE_VERDICT_SQL,
    "quarantine_counts": f"SELECT * FROM ({oracle.INGEST_REPORT_SQL}) WHERE value > 0 "
    "AND metric NOT IN ('documents', 'coming_soon', 'games')",
    "ingest_report": oracle.INGEST_REPORT_SQL,
}
