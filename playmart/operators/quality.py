"""Data-quality tests (unique, not_null) and the gate that stops the build.

Each test is a query returning its failing rows, as a column test does. The
gate counts failures of all tests and raises before any fact or analytics
model is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.sqltext import literal


@dataclass(frozen=True)
class ColumnTest:
    name: str
    kind: str  # "unique" or "not_null"
    model: str
    column: str


# The tests declared on the source models.
SOURCE_TESTS = [
    ColumnTest("unique_src_game_info_game_id", "unique", "game_info", "game_id"),
    ColumnTest("not_null_src_game_info_game_id", "not_null", "game_info", "game_id"),
    ColumnTest("not_null_src_game_status_game_id", "not_null", "game_status", "game_id"),
    ColumnTest("not_null_src_comment_data_comment_id", "not_null", "comment_data", "comment_id"),
]


class DataQualityError(RuntimeError):
    """Tests failed; ``failed`` has their failing-row counts."""

    def __init__(self, message: str, failed: dict[str, int] | None = None):
        super().__init__(message)
        self.failed = failed or {}


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-null keys occurring more than once, with their row count.

    A partial count per map task runs before the shuffle, so a key holding
    a large share of rows still sends one row per task.
    """
    return (
        df.select(column)
        .filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failures(test: ColumnTest, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[test.model]
    if test.kind == "unique":
        return unique_failures(df, test.column)
    if test.kind == "not_null":
        return not_null_failures(df, test.column)
    raise ValueError(f"unknown test kind {test.kind!r}")


def test_results(tables: dict[str, DataFrame], tests=SOURCE_TESTS) -> DataFrame:
    """One row per test with its failing-row count.

    Tests on the same column share one pass: with a ``unique`` test the
    column is counted per value once (partial counts before the shuffle);
    the NULL value is its own group, which gives the ``not_null`` failures
    too. A column with only ``not_null`` is a global count. Nothing but the
    counts reaches the driver.
    """
    by_column: dict[tuple[str, str], list[ColumnTest]] = {}
    for t in tests:
        by_column.setdefault((t.model, t.column), []).append(t)
    out = None
    for (model, column), col_tests in by_column.items():
        df = tables[model].select(column)
        if any(t.kind == "unique" for t in col_tests):
            counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            summary = counted.selectExpr(
                f"coalesce(sum(CASE WHEN {column} IS NULL THEN n END), 0L) AS not_null",
                f"count(CASE WHEN {column} IS NOT NULL AND n > 1 THEN 1 END) AS unique",
            )
        else:
            summary = df.selectExpr(f"count(CASE WHEN {column} IS NULL THEN 1 END) AS not_null")
        rows = ", ".join(
            f"struct({literal(t.name)} AS test_name, {literal(t.kind)} AS test_kind, {literal(t.model)} AS model, "
            f"{literal(t.column)} AS column_name, `{t.kind}` AS failures)"
            for t in col_tests
        )
        part = summary.selectExpr(f"inline(array({rows}))")
        out = part if out is None else out.unionByName(part)
    return out


def gate(tables: dict[str, DataFrame], tests=SOURCE_TESTS) -> dict[str, int]:
    """Run all tests; raise DataQualityError if any has failing rows.

    Only one count per test is collected.
    """
    counts = {r["test_name"]: r["failures"] for r in test_results(tables, tests).collect()}
    failed = {k: v for k, v in counts.items() if v}
    if failed:
        raise DataQualityError(f"data-quality tests failed: {failed}", failed)
    return counts
