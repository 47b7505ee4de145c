"""Mergeable per-game state: the aggregates of the playtime fact (M4, A1) and
of the release-month model (M7, A2, A3) without scanning the history.

The rows of a table come in slices (a day's snapshots, a landed batch of
reviews) that are replaced as a whole. Each slice is reduced once to partial
sums and counts per game; the totals over all slices are kept beside them.
Replacing a slice reads the new rows, the partials that the slice had, and
the totals: ``totals - old partials + new partials``, all per game, exact
because sums and counts of integers can be taken away again.

One entry of a commit log names the totals and the partials of every slice, so
a reader never sees the one without the other, and a run that fails leaves
the state as it was. A writer that finds another commit in its way computes
its own again on top of that.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.sqltext import date_text
from playmart.sources.commits import CommitLog

# Sums and counts kept per game: name -> aggregate over the rows of a slice.
COMMENT_SUMS = {
    "n_rows": "count(1)",
    "count_game_id": "count(game_id)",
    "sum_total": "coalesce(sum(total_playtime), 0L)",
    "n_total": "count(total_playtime)",
    "sum_recent": "coalesce(sum(last_two_weeks_playtime), 0L)",
    "n_recent": "count(last_two_weeks_playtime)",
}
STATUS_SUMS = {
    "n_rows": "count(1)",
    "sum_users": "coalesce(sum(user_cnt), 0L)",
    "n_users": "count(user_cnt)",
    "sum_reviews": "coalesce(sum(review_cnt), 0L)",
    "n_reviews": "count(review_cnt)",
}
KEY = "game_id"


def partials(rows: DataFrame, sums: dict[str, str], *by: str) -> DataFrame:
    """One row per game (and slice): partial aggregates run before the shuffle."""
    return rows.groupBy(*by, KEY).agg(*[F.expr(e).alias(name) for name, e in sums.items()])


def merged(parts: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Sums of partials per game; a game whose rows are all gone goes too."""
    return parts.groupBy(KEY).agg(*[F.sum(n).alias(n) for n in sums]).filter("n_rows > 0")


def slice_name(value) -> str:
    return "null" if value is None else date_text(value)


class ConcurrentChange(RuntimeError):
    """Another commit came in between; the change must be computed again."""


@dataclass
class GameState:
    """The state of one table under ``folder``. Partials and totals are small
    Parquet tables in folders that are never written twice."""

    spark: SparkSession
    folder: str
    sums: dict[str, str]
    log: CommitLog = field(init=False)

    def __post_init__(self):
        self.folder = self.folder.rstrip("/")
        self.log = CommitLog(self.spark, f"{self.folder}/log")

    def _read(self, paths: list[str]) -> DataFrame:
        columns = ", ".join([f"{KEY} BIGINT", *[f"{n} BIGINT" for n in self.sums]])
        if not paths:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*[f"{self.folder}/{p}" for p in paths])

    def entry(self) -> dict:
        return self.log.last() or {"seq": 0, "totals": None, "slices": {}}

    def totals(self) -> DataFrame:
        """Sums and counts per game over all slices."""
        held = self.entry()["totals"]
        return self._read([held] if held else [])

    def slices(self) -> dict[str, str]:
        return self.entry()["slices"]

    def replace(self, value, rows: DataFrame) -> dict:
        """The slice ``value`` consists of ``rows`` from now on (none: it is
        removed). Reads these rows, the slice's partials and the totals."""
        return self.replace_all({slice_name(value): rows})

    def replace_all(self, changed: dict[str, DataFrame]) -> dict:
        written = {}
        for name, rows in changed.items():
            path = f"slices/{name}/{uuid.uuid4().hex}"
            partials(rows, self.sums).write.parquet(f"{self.folder}/{path}")
            written[name] = path
        return self._commit(written)

    def load(self, rows: DataFrame, slice_column: str) -> dict:
        """Replaces every slice that has a row in ``rows``, in one pass."""
        version = f"loads/{uuid.uuid4().hex}"
        name = F.coalesce(F.col(slice_column).cast("string"), F.lit("null"))
        parts = partials(rows.withColumn("slice", name), self.sums, "slice")
        parts.write.partitionBy("slice").parquet(f"{self.folder}/{version}")
        found = self.spark.read.parquet(f"{self.folder}/{version}").select(F.col("slice").cast("string")).distinct().collect()
        return self._commit({r[0]: f"{version}/slice={r[0]}" for r in found})

    def _commit(self, written: dict[str, str]) -> dict:
        while True:
            base = self.entry()
            old = [base["slices"][n] for n in written if n in base["slices"]]
            gone = self._read(old).select(KEY, *[(-F.col(n)).alias(n) for n in self.sums])
            parts = self.totals_of(base).unionByName(gone).unionByName(self._read(list(written.values())))
            totals = f"totals/{uuid.uuid4().hex}"
            merged(parts, self.sums).write.parquet(f"{self.folder}/{totals}")

            def build(last: dict | None) -> dict:
                if (last["seq"] if last else 0) != base["seq"]:
                    raise ConcurrentChange
                return {"totals": totals, "slices": base["slices"] | written}

            try:
                return self.log.append(build)
            except ConcurrentChange:
                continue  # on top of the other writer's totals

    def totals_of(self, entry: dict) -> DataFrame:
        return self._read([entry["totals"]] if entry["totals"] else [])


def mean(total: str, n: str) -> str:
    """SQL of a mean as ``avg`` gives it: NULL where nothing was counted."""
    return f"try_divide(CAST({total} AS DOUBLE), CAST({n} AS DOUBLE))"


def comment_state(spark: SparkSession, folder: str) -> GameState:
    return GameState(spark, folder, COMMENT_SUMS)


def status_state(spark: SparkSession, folder: str) -> GameState:
    return GameState(spark, folder, STATUS_SUMS)


def playtime_from(totals: DataFrame) -> DataFrame:
    """The per-game aggregate of the playtime fact (A1) from comment totals."""
    return totals.selectExpr(
        "game_id",
        "count_game_id",
        "CASE WHEN n_total > 0 THEN sum_total END AS sum_total_playtime",
        "CASE WHEN n_recent > 0 THEN sum_recent END AS sum_last_two_weeks_playtime",
        f"{mean('sum_total', 'n_total')} AS avg_total_playtime",
        f"{mean('sum_recent', 'n_recent')} AS avg_last_two_weeks_playtime",
    )


def comment_means(totals: DataFrame) -> DataFrame:
    """Per-game means of the release-month model (A2) from comment totals."""
    return totals.selectExpr(
        "game_id",
        f"{mean('sum_total', 'n_total')} AS total_playtime",
        f"{mean('sum_recent', 'n_recent')} AS last_two_weeks_playtime",
    )


def status_means(totals: DataFrame) -> DataFrame:
    """Per-game means of the release-month model (A3) from status totals."""
    return totals.selectExpr(
        "game_id", f"{mean('sum_users', 'n_users')} AS user_cnt", f"{mean('sum_reviews', 'n_reviews')} AS review_cnt"
    )
