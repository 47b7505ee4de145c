"""The daily movers (M9, M10) as maintained tables.

Both models are kept in partitions by start day. The rows of start day s
depend on the snapshots of s and s + 1 only, so replacing day d changes the
partitions d - 1 and d: ``refresh`` reads the snapshots of d - 1, d and d + 1
and rewrites these two partitions of both models, whatever the history holds.

Rows are kept as ranked keys (game, days, difference, rank); names and prices
are joined from the current catalogue on reading, so that a changed price
touches no partition. A game that enters or leaves the catalogue changes the
ranks of the days it has snapshots on: ``refresh_games`` finds these days and
refreshes them. Like the tests that gate the models, this takes catalogue ids
to be unique.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart import schemas
from playmart.functions.sqltext import date_text
from playmart.operators import models
from playmart.sources import files, manifest
from playmart.sources.warehouse import on_days, write_days

# Model name -> its function, its metric, and the final order.
MODELS = {
    "daily_user_login_cnt_diff_top15": (models.daily_user_login_cnt_diff_top15, "user_diff", ["gubun", "start_dt", "rn"]),
    "daily_user_review_cnt_diff_top15": (models.daily_user_review_cnt_diff_top15, "review_diff", ["start_dt", "rn"]),
}
ATTRIBUTES = ["game_id", "game_name", "genre", "price", "discount_percentage", "thumbnail_path"]


def _kept(metric: str, login: bool) -> str:
    return f"game_id BIGINT, end_dt DATE, {metric} BIGINT, rn BIGINT, {'gubun STRING, ' if login else ''}start_dt DATE"


def affected(days: list[_dt.date | None]) -> list[_dt.date]:
    """Start days whose rows depend on a day: the day and the one before.
    Snapshots without a day are in no pair."""
    one = _dt.timedelta(days=1)
    return sorted({s for d in days if d is not None for s in (d - one, d)})


def refresh(game_status: DataFrame, game_info: DataFrame, folder: str, days: list, k: int = schemas.DAILY_TOP_K) -> list[_dt.date]:
    """Recomputes the partitions that depend on the days (dates), for both
    models; returns their start days. ``game_status`` should be stored in
    partitions by day, so that only the days needed are read."""
    spark = game_status.sparkSession
    starts = affected(days)
    if not starts:
        return []
    needed = sorted({*starts, *[s + _dt.timedelta(days=1) for s in starts]})
    status = game_status.filter(on_days("create_dt", needed))
    for name, (model, metric, _) in MODELS.items():
        table = f"{folder.rstrip('/')}/{name}"
        login = name == "daily_user_login_cnt_diff_top15"
        columns = ["game_id", "end_dt", metric, "rn", *(["gubun"] if login else []), "start_dt"]
        rows = model(status, game_info, k).filter(on_days("start_dt", starts)).select(*columns)
        seen = Observation(f"days-{name}")
        write_days(rows.observe(seen, F.collect_set("start_dt").alias("days")), table, "start_dt")
        # a start day without pairs has no rows to replace its partition with
        for day in {date_text(s) for s in starts} - {date_text(d) for d in seen.get["days"] or []}:
            files.delete(spark, f"{table}/start_dt={day}")
    return starts


def rebuild(game_status: DataFrame, game_info: DataFrame, folder: str, k: int = schemas.DAILY_TOP_K) -> list[_dt.date]:
    """All partitions anew."""
    return refresh(game_status, game_info, folder, manifest.days_of(game_status, "create_dt"), k)


def refresh_games(
    game_status: DataFrame, game_info: DataFrame, changed_ids: DataFrame, folder: str, k: int = schemas.DAILY_TOP_K
) -> list[_dt.date]:
    """Refreshes what games that entered or left the catalogue change."""
    touched = game_status.join(changed_ids.select("game_id").distinct(), "game_id", "left_semi")
    days = manifest.days_of(touched, "create_dt")
    return refresh(game_status, game_info, folder, days, k)


def read(spark: SparkSession, name: str, folder: str, game_info: DataFrame) -> DataFrame:
    """A maintained model in the form of the model's own function."""
    _, metric, order = MODELS[name]
    login = "gubun" in order
    table = f"{folder.rstrip('/')}/{name}"
    schema = _kept(metric, login)
    kept = spark.read.schema(schema).parquet(table) if files.exists(spark, table) else spark.createDataFrame([], schema)
    rows = kept.join(game_info.select(*ATTRIBUTES), "game_id")
    return rows.select(*models._mover_columns(metric), *(["gubun"] if login else [])).orderBy(*order)
