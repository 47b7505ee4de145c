"""Registered queries of the kept state: each brings its tables to a state by
loads and changes, as daily runs do, and reads the result, which must equal
the model computed from the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart import schemas
from playmart.operators import game_state, ingest, key_index, models, movers, quality, quarantine
from playmart.plans import pipeline
from playmart.session import scratch_path
from playmart.sources import aligned, driver, landing, manifest, warehouse
from playmart.streaming import status_loader

# Landed batches that the reviews of the driver tables are dealt to.
BATCHES = 8
BATCH = f"CAST(split(comment_id, '-')[0] AS BIGINT) % {BATCHES}"


def _comments(spark: SparkSession, sf: str) -> DataFrame:
    return driver.comment_data(spark, sf).withColumn("batch", F.expr(BATCH).cast("string"))


def _kept_comments(spark: SparkSession, sf: str) -> game_state.GameState:
    """All batches in one load, one of them with wrong values, which the batch
    landed again then puts right."""
    state = game_state.comment_state(spark, scratch_path(spark, "comment-state"))
    rows = _comments(spark, sf)
    wrong = F.when(F.col("batch") == "3", F.col("total_playtime") + 1).otherwise(F.col("total_playtime"))
    state.load(rows.withColumn("total_playtime", wrong).filter("batch <> '3' OR language = 'KOR'"), "batch")
    state.replace("3", rows.filter("batch = '3'"))
    return state


def _kept_status(spark: SparkSession, sf: str, day: str) -> game_state.GameState:
    state = game_state.status_state(spark, scratch_path(spark, "status-state"))
    rows = driver.game_status(spark, sf)
    state.load(rows.withColumn("user_cnt", F.expr(f"user_cnt + int(create_dt <=> DATE'{day}')")), "create_dt")
    state.replace(day, rows.filter(F.col("create_dt") == day))
    return state


def fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    totals = _kept_comments(spark, sf).totals()
    fact = models.playtime_fact(game_state.playtime_from(totals), driver.game_info(spark, sf))
    return fact.select(*schemas.FACT_GAME_PLAYTIME.fieldNames())


def release_date_incremental(spark: SparkSession, sf: str, day: str) -> DataFrame:
    comments = game_state.comment_means(_kept_comments(spark, sf).totals())
    status = game_state.status_means(_kept_status(spark, sf, day).totals())
    return models.release_months(driver.game_info(spark, sf), comments, status)


def movers_incremental(spark: SparkSession, sf: str, name: str, day: str) -> DataFrame:
    """Kept movers over all days but one with half of its games, after the
    whole day has replaced it."""
    path, folder = scratch_path(spark, "movers-status"), scratch_path(spark, "movers")
    status, info = driver.game_status(spark, sf), driver.game_info(spark, sf)
    warehouse.write_days(status.filter(f"NOT (create_dt <=> DATE'{day}') OR game_id % 2 = 0"), path)
    stored = warehouse.read_partitioned(spark, path, schemas.GAME_STATUS)
    movers.rebuild(stored, info, folder)
    warehouse.write_days(status.filter(F.col("create_dt") == day), path)
    stored = warehouse.read_partitioned(spark, path, schemas.GAME_STATUS)
    movers.refresh(stored, info, folder, manifest.days_of(stored.filter(F.col("create_dt") == day), "create_dt"))
    return movers.read(spark, name, folder, info)


def unique_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Failing comment ids, from an index that the reviews of both languages
    were added to one after the other."""
    index = key_index.KeyIndex(spark, scratch_path(spark, "keys"))
    for language in schemas.LANGUAGES:
        index.add(driver.comment_data(spark, sf).filter(F.col("language") == language), "comment_id")
    return index.all_failures("comment_id")


def unique_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Failing ids of one batch of reviews against all batches stored."""
    rows = _comments(spark, sf)
    index = key_index.KeyIndex(spark, scratch_path(spark, "keys"))
    index.add(rows.filter("batch <> '3'"), "comment_id")
    return index.failures(rows.filter("batch = '3'"), "comment_id")


def status_manifest_load(spark: SparkSession, sf: str) -> DataFrame:
    """Staged snapshots without every fifth game, then these as late files of
    the same days."""
    staged, noted, table = (scratch_path(spark, n) for n in ("staged", "manifest", "status"))
    status = driver.game_status(spark, sf)
    for epoch, part in enumerate(("game_id % 5 <> 0", "game_id % 5 = 0")):
        folder = f"{staged}/part={epoch}"
        status.filter(part).repartition("create_dt").write.parquet(folder)
        batch = spark.read.schema(schemas.GAME_STATUS).parquet(folder)
        status_loader.replace_days(manifest.with_file_columns(batch), epoch, noted, table)
    return warehouse.read_partitioned(spark, table, schemas.GAME_STATUS)


def published_catalogue(spark: SparkSession, sf: str, day: str) -> DataFrame:
    """The catalogue that a whole run of a day publishes."""
    landed, root = scratch_path(spark, "landing"), scratch_path(spark, "published")
    docs = {name: landing.landed(spark, sf, name) for name in pipeline.LANDED_INPUTS}
    pipeline.write_landed(docs, landed, day)
    pipeline.run_pipeline(spark, landed, root, day)
    return pipeline.Warehouse(spark, root).table("game_info")


def gate_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate says with a uniqueness test of the comment ids added:
    (test_name, failures) of the failing tests, none if it passes."""
    tests = [*quality.SOURCE_TESTS, quality.ColumnTest("unique_src_comment_data_comment_id", "unique", "comment_data", "comment_id")]
    try:
        quality.gate(driver.raw_tables(spark, sf), tests)
        failed = {}
    except quality.DataQualityError as e:
        failed = e.failed
    return spark.createDataFrame(list(failed.items()), "test_name STRING, failures BIGINT")


def quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the written quarantine by source and rule."""
    pages, path = scratch_path(spark, "review-pages"), scratch_path(spark, "quarantine")
    ingest.parse_review_pages(landing.landed(spark, sf, "review_pages")).write.parquet(pages)
    details, counts = (landing.landed(spark, sf, n) for n in ("app_details", "player_counts"))
    quarantine.write(details, counts, spark.read.parquet(pages), path)
    kept = quarantine.read(spark, path).groupBy("source", "rule").agg(F.count(F.lit(1)).alias("value"))
    return kept.select("source", F.col("rule").alias("metric"), "value")


def _aligned(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    tables = aligned.AlignedTables(spark, scratch_path(spark, "aligned"))
    for name in names:
        tables.write(name, getattr(driver, name)(spark, sf))
    return {name: tables.read(name) for name in names}


def fact_aligned(spark: SparkSession, sf: str) -> DataFrame:
    """The fact over tables bucketed by game."""
    return models.fact_game_playtime(**_aligned(spark, sf, "comment_data", "game_info"))


def release_date_aligned(spark: SparkSession, sf: str) -> DataFrame:
    return models.analytics_release_date(**_aligned(spark, sf, "game_info", "comment_data", "game_status"))
