"""The daily run, as plain functions over a landing folder and a
warehouse folder: write, test, publish.

Order: catalogue (full refresh) -> daily status slice (slice replace) ->
reviews (full refresh) -> source models + data-quality gate -> fact and
analytics tables. Every stage ends in written folders that no reader sees
yet; a lost executor costs a retry of tasks of the current stage only. After
the last stage one entry of the warehouse's log publishes all tables
together, so readers see one run's tables or another's, never a mixture, and
a failing test leaves everything at its old version.

Finished stages are noted in a ledger of the day. A run that died is taken up
at the stage it died in; one whose tests failed is closed, and the next call
starts anew.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart import schemas
from playmart.functions.sqltext import date_text
from playmart.operators import ingest, quality, quarantine
from playmart.plans import catalog
from playmart.sources import warehouse
from playmart.sources.commits import CommitLog

# Landed inputs of a run, one folder each under <landing>/<name>/dt=<as_of>.
LANDED_INPUTS = ("app_details", "review_summary", "player_counts", "review_pages", "popular")

ANALYTICS = (
    "analytics_genre_comment_ratio",
    "analytics_genre_playtime",
    "analytics_release_date",
    "analytics_usercnt_price",
    "daily_user_login_cnt_diff_top15",
    "daily_user_review_cnt_diff_top15",
)


@dataclass
class RunResult:
    as_of: str
    tables: dict[str, str] = field(default_factory=dict)
    checks: dict[str, int] = field(default_factory=dict)
    ingest_report: dict[str, int] = field(default_factory=dict)


def write_landed(docs: dict[str, DataFrame], landing_dir: str, as_of) -> dict[str, str]:
    """Store landed documents under their dated keys."""
    return {name: warehouse.land(df, landing_dir, name, as_of) for name, df in docs.items()}


def read_landed(spark: SparkSession, landing_dir: str, as_of) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(warehouse.landing_path(landing_dir, n, as_of)) for n in LANDED_INPUTS}


class Warehouse:
    """The tables of one warehouse folder. Every table is a set of folders
    that are never written twice; the last entry of the log names the current
    ones: a folder per full-refresh table, a version per day of the status
    table. Nothing depends on the session's catalog."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "pm_"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.log = CommitLog(spark, f"{self.root}/tables/{prefix}published")

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def published(self) -> dict:
        """{tables: {name: folder}, status: {day: version}} of the last entry."""
        return self.log.last() or {"seq": 0, "tables": {}, "status": {}}

    def exists(self, table: str) -> bool:
        return table in self.published()["tables"]

    def table(self, table: str) -> DataFrame:
        known = self.published()["tables"]
        if table not in known:
            raise ValueError(f"table {table} has not been loaded under {self.root}")
        return self.spark.read.parquet(known[table])

    def write(self, table: str, df: DataFrame, run_id: str) -> str:
        """Writes a version of a table that is not published yet. What a dead
        run left under the same name is replaced."""
        path = warehouse.version_path(self.name(table), f"{self.root}/tables", run_id)
        df.write.mode("overwrite").parquet(path)
        return path

    def replace(self, table: str, df: DataFrame, run_id: str) -> str:
        """Writes and publishes one table."""
        path = self.write(table, df, run_id)
        self.publish({table: path}, {})
        return path

    @property
    def status_path(self) -> str:
        return f"{self.root}/tables/game_status"

    def status(self, days: dict[str, str | None] | None = None) -> DataFrame:
        """The status table; with ``days`` as it is with these days' versions
        in place of the published ones."""
        current = self.published()["status"] | (days or {})
        folders = [f"{self.status_path}/version={v}/create_dt={d}" for d, v in sorted(current.items()) if v]
        if not folders:
            return self.spark.createDataFrame([], schemas.GAME_STATUS)
        reader = self.spark.read.schema(schemas.GAME_STATUS).option("basePath", self.status_path)
        return reader.parquet(*folders).select(*schemas.GAME_STATUS.fieldNames())

    def write_status(self, rows: DataFrame, version: str, days: list[str]) -> dict[str, str | None]:
        """Writes whole days of the status table, unpublished: the version of
        each of ``days`` and of every day with a row (None: no rows)."""
        path = f"{self.status_path}/version={version}"
        seen = Observation()
        found = rows.observe(seen, F.collect_set(F.coalesce(F.col("create_dt").cast("string"), F.lit(NO_DAY))).alias("days"))
        found.write.mode("overwrite").partitionBy("create_dt").parquet(path)
        there = seen.get["days"] or []
        return {d: None for d in days} | {d: version for d in there}

    def write_slice(self, batch: DataFrame, as_of: str, run_id: str) -> dict[str, str | None]:
        """The day's slice is replaced by the batch's rows of the day; its rows
        of other days are added to what these hold. Unpublished."""
        other = ~F.col("create_dt").eqNullSafe(F.lit(as_of).cast("date"))
        others = [r[0] for r in batch.filter(other).select("create_dt").distinct().collect()]
        rows = batch.select(*schemas.GAME_STATUS.fieldNames())
        if others:
            rows = rows.unionByName(self.status().filter(warehouse.on_days("create_dt", others)))
        return self.write_status(rows, run_id, [as_of])

    def publish(self, tables: dict[str, str], status: dict[str, str | None], run_id: str = "") -> dict:
        """Makes written folders the current ones, all together."""

        def build(last: dict | None) -> dict:
            last = last or {"tables": {}, "status": {}}
            days = {d: v for d, v in (last["status"] | status).items() if v}
            return {"run": run_id, "tables": last["tables"] | tables, "status": days}

        return self.log.append(build)


# How Spark names the partition of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Run:
    """One run of a day: its id, and what its finished stages returned.

    The ledger of the day has an entry per finished stage. An open run is
    taken up again; ``published`` and ``rejected`` close one.
    """

    def __init__(self, wh: Warehouse, as_of: str):
        self.ledger = CommitLog(wh.spark, f"{wh.root}/tables/{wh.prefix}runs/{as_of}")
        entries = self.ledger.entries()
        last = entries[-1] if entries else None
        if last and last["stage"] not in ("published", "rejected"):
            self.id = last["run"]
        else:
            self.id = f"{as_of}-{_dt.datetime.now(_dt.timezone.utc).strftime('%H%M%S%f')}"
        self.done = {e["stage"]: e["output"] for e in entries if e["run"] == self.id}

    def note(self, name: str, output=None):
        self.ledger.append(lambda _last: {"run": self.id, "stage": name, "output": output})
        self.done[name] = output
        return output

    def stage(self, name: str, work: Callable[[], object]):
        """What ``work`` returns (JSON values), from the ledger if it has run."""
        return self.done[name] if name in self.done else self.note(name, work())


def catalogue_batch(wh: Warehouse, landed: dict[str, DataFrame]) -> DataFrame:
    known = wh.table("game_info").select("game_id") if wh.exists("game_info") else wh.spark.createDataFrame(
        [], "game_id BIGINT"
    )
    candidates = ingest.game_candidates(known, landed["popular"])
    # goes to a new folder: the batch reads the table it replaces
    return ingest.ingest_game_info(candidates, landed["app_details"], landed["review_summary"])


def stage_status(wh: Warehouse, game_info: DataFrame, landed: dict[str, DataFrame], as_of: str) -> str:
    """The day's slice, staged under its dated key."""
    totals = ingest.game_review_totals(game_info)
    batch = ingest.ingest_game_status(totals, landed["player_counts"], as_of)
    return warehouse.land(batch, f"{wh.root}/staging", "game_status", as_of)


def stage_review_pages(wh: Warehouse, landed: dict[str, DataFrame], as_of: str) -> str:
    """The day's review pages, parsed once and staged under their dated key."""
    return warehouse.land(ingest.parse_review_pages(landed["review_pages"]), f"{wh.root}/staging", "review_pages", as_of)


def quarantine_path(wh: Warehouse, as_of) -> str:
    """Where a day's dropped and defaulted documents are kept."""
    return warehouse.landing_path(f"{wh.root}/quarantine", "documents", as_of)


def raw_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {"game_info": wh.table("game_info"), "game_status": wh.status(), "comment_data": wh.table("comment_data")}


def test_and_publish(wh: Warehouse, run: Run, tables: dict[str, str], status: dict, result: RunResult) -> RunResult:
    """Source models + data-quality gate on the unpublished tables, then the
    analytics tables, then one entry that publishes everything."""
    read = wh.spark.read.parquet
    raw = {"game_info": read(tables["game_info"]), "game_status": wh.status(status), "comment_data": read(tables["comment_data"])}
    frames = catalog.model_frames(raw)
    src = {t: frames[f"src_{t}"] for t in raw}
    try:
        result.checks = run.stage("checks", lambda: quality.gate(src))  # raises before any model is built
    except quality.DataQualityError as e:
        run.note("rejected", str(e))
        raise
    # the fact stays a view (a lazily evaluated DataFrame); analytics are tables
    for name in ANALYTICS:
        tables[name] = run.stage(name, lambda: wh.write(name, frames[name], run.id))
    wh.publish(tables, status, run.id)
    run.note("published")
    result.tables = tables | {"game_status": wh.status_path}
    return result


def run_pipeline(spark: SparkSession, landing_dir: str, warehouse_dir: str, as_of, prefix: str = "pm_") -> RunResult:
    as_of = date_text(as_of)
    wh = Warehouse(spark, warehouse_dir, prefix)
    run = Run(wh, as_of)
    landed = read_landed(spark, landing_dir, as_of)
    result = RunResult(as_of)
    tables, read = {}, spark.read.parquet

    tables["game_info"] = run.stage("game_info", lambda: wh.write("game_info", catalogue_batch(wh, landed), run.id))
    staged = run.stage("staged_status", lambda: stage_status(wh, read(tables["game_info"]), landed, as_of))
    slice_ = spark.read.schema(schemas.GAME_STATUS).parquet(staged)
    status = run.stage("game_status", lambda: wh.write_slice(slice_, as_of, run.id))
    pages = read(run.stage("review_pages", lambda: stage_review_pages(wh, landed, as_of)))
    ids = read(tables["game_info"]).select("game_id")
    tables["comment_data"] = run.stage(
        "comment_data", lambda: wh.write("comment_data", ingest.ingest_comment_data(ids, pages), run.id)
    )

    # documents dropped or defaulted by the ingest rules, and their counts
    path = quarantine_path(wh, as_of)
    result.ingest_report = run.stage(
        "quarantine", lambda: quarantine.write(landed["app_details"], landed["player_counts"], pages, path)
    )
    return test_and_publish(wh, run, tables, status, result)


# Folder and file name of each staged CSV batch, keyed
# <folder>/<name>_<YYYY-MM-DD>.csv.
STAGED_CSV = {
    "game_info": ("game_info", "game_info"),
    "game_status": ("game_status", "game_status"),
    "comment_data": ("comment_info", "comment_info"),
}

_TABLE_SCHEMAS = {"game_info": schemas.GAME_INFO, "game_status": schemas.GAME_STATUS, "comment_data": schemas.COMMENT_DATA}


def staged_csv_key(stage_dir: str, table: str, as_of) -> str:
    folder, name = STAGED_CSV[table]
    return f"{stage_dir.rstrip('/')}/{folder}/{name}_{date_text(as_of)}.csv"


def write_staged_day(tables: dict[str, DataFrame], stage_dir: str, as_of) -> dict[str, str]:
    """Stage one day's batches as CSV under their dated keys, columns in
    table order; a re-run of the day replaces them."""
    return {
        name: warehouse.write_csv(df, staged_csv_key(stage_dir, name, as_of), schemas.COLUMNS[name])
        for name, df in tables.items()
    }


def load_staged_day(spark: SparkSession, stage_dir: str, warehouse_dir: str, as_of, prefix: str = "pm_") -> RunResult:
    """Load one day's staged CSV batches (read by column position, integers
    written as floats accepted): catalogue and reviews by full
    refresh, the status slice by date-slice replace; then the gate and the
    models, as in ``run_pipeline``."""
    as_of = date_text(as_of)
    wh = Warehouse(spark, warehouse_dir, prefix)
    run = Run(wh, as_of)

    def staged(table: str) -> DataFrame:
        path = staged_csv_key(stage_dir, table, as_of)
        return warehouse.read_staged_csv(spark, path, _TABLE_SCHEMAS[table])

    tables = {
        t: run.stage(t, lambda: wh.write(t, staged(t), run.id)) for t in ("game_info", "comment_data")
    }
    status = run.stage("game_status", lambda: wh.write_slice(staged("game_status"), as_of, run.id))
    return test_and_publish(wh, run, tables, status, RunResult(as_of))


def latest_run_tables(spark: SparkSession, warehouse_dir: str, prefix: str = "pm_") -> dict[str, DataFrame]:
    wh = Warehouse(spark, warehouse_dir, prefix)
    out = {name: wh.table(name) for name in ("game_info", "comment_data", *ANALYTICS) if wh.exists(name)}
    out["game_status"] = wh.status()
    return out



def register_warehouse_views(spark: SparkSession, warehouse_dir: str, prefix: str = "pm_", view_prefix: str = "") -> list[str]:
    """Name the warehouse's current raw tables and every model as temporary
    views for ``spark.sql`` (models are computed from the raw tables)."""
    return catalog.register_views(spark, raw_tables(Warehouse(spark, warehouse_dir, prefix)), prefix=view_prefix)


def main(argv: list[str] | None = None) -> None:
    """spark-submit entry: ``python -m playmart.plans.pipeline --landing L
    --warehouse W --as-of YYYY-MM-DD``. The session comes from the cluster
    (``getOrCreate``); nothing here overrides its settings."""
    import argparse

    parser = argparse.ArgumentParser(description="daily catalogue / status / review run")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--as-of", required=True)
    parser.add_argument("--prefix", default="pm_")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("playmart-daily").getOrCreate()
    result = run_pipeline(spark, args.landing, args.warehouse, args.as_of, prefix=args.prefix)
    for name, path in result.tables.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
