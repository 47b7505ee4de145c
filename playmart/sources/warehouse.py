"""Sinks and loads: CSV staging (S8/S9), dated landing keys (S10), full
refresh (S11), date-slice replace (S12) and staging (S13).

All writes are Spark writers running on executors; the driver only plans
them. Which version of a fully refreshed table is current is said by a commit
log under the table's folder, so it outlives the session.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.scalars import integer_sql
from playmart.functions.sqltext import date_text, literal
from playmart.sources import files
from playmart.sources.commits import CommitLog

# CSV options that keep text exactly as written: no trimming on write, quote
# escaped by doubling, quoted values may hold line breaks. A staged file is one
# day's batch, so that reading it whole (multiLine) is bounded by the day.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
}
CSV_READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "FAILFAST",
}


# --------------------------------------------------------------------------
# CSV staging by column position
# --------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> str:
    """Write the chosen columns in order, with a header and no index."""
    out = df.select(*(columns or df.columns))
    out.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)
    return path


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def read_staged_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read staged CSV by position: the header line is skipped and its text
    ignored; column names and types come from ``schema``.

    Integer columns may hold ``12000.0``: frame libraries turn an integer
    column with missing values into floats. A row with another number of
    columns, or text in an integer column, fails the read.
    """
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType(), True) if isinstance(f.dataType, _INTEGRAL) else f for f in schema.fields]
    )
    exprs = []
    for f in schema.fields:
        if isinstance(f.dataType, _INTEGRAL):
            text = f"`{f.name}`"
            bad = f"raise_error(concat({literal(f'staged CSV: no integer in {f.name}: ')}, {text}))"
            value = integer_sql(text, f.dataType.simpleString())
            exprs.append(f"CASE WHEN {text} IS NOT NULL THEN coalesce({value}, {bad}) END AS {text}")
        else:
            exprs.append(f"`{f.name}`")
    return spark.read.schema(as_text).options(**CSV_READ_OPTIONS).csv(path).selectExpr(*exprs)


# --------------------------------------------------------------------------
# Dated landing key
# --------------------------------------------------------------------------


def landing_path(base: str, name: str, as_of) -> str:
    return f"{base.rstrip('/')}/{name}/dt={date_text(as_of)}"


def land(df: DataFrame, base: str, name: str, as_of, fmt: str = "parquet") -> str:
    """Write a batch under its dated key, replacing an earlier one."""
    path = landing_path(base, name, as_of)
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


# --------------------------------------------------------------------------
# Full refresh through a new version folder and a version log
# --------------------------------------------------------------------------

def _table_folder(table_root: str, table: str) -> str:
    return f"{table_root.rstrip('/')}/{table}"


def version_log(spark: SparkSession, table: str, table_root: str) -> CommitLog:
    return CommitLog(spark, f"{_table_folder(table_root, table)}/log")


def versions(spark: SparkSession, table: str, table_root: str) -> list[tuple[int, str]]:
    """(seq, version) of the full refreshes of a table that the log keeps,
    oldest first."""
    return [(e["seq"], e["version"]) for e in version_log(spark, table, table_root).entries()]


def version_path(table: str, table_root: str, version: str) -> str:
    return f"{_table_folder(table_root, table)}/version={version}"


def current_path(spark: SparkSession, table: str, table_root: str) -> str | None:
    """Folder of the current version, or None if the table was never loaded."""
    last = version_log(spark, table, table_root).last()
    return version_path(table, table_root, last["version"]) if last else None


def read_current(spark: SparkSession, table: str, table_root: str) -> DataFrame:
    path = current_path(spark, table, table_root)
    if path is None:
        raise ValueError(f"table {table} has not been loaded under {table_root}")
    return spark.read.parquet(path)


def full_refresh(spark: SparkSession, batch: DataFrame, table: str, table_root: str, run_id: str | None = None) -> str:
    """Replace the whole content of ``table`` with ``batch``.

    The batch is written to a fresh version folder (never the folder being
    read, so the batch may itself read the table). Last, one entry is put
    into the table's version log, which makes that folder the current one for
    every session. A run that fails before leaves the old version current; of
    two runs at once both get an entry, the later one is current.
    """
    version = run_id or uuid.uuid4().hex
    path = version_path(table, table_root, version)
    batch.write.mode("errorifexists").parquet(path)
    version_log(spark, table, table_root).append(lambda last: {"version": version})
    return path


@contextmanager
def reading(spark: SparkSession, table: str, table_root: str) -> Iterator[DataFrame]:
    """The current version under a lease: ``expire`` keeps its files until the
    block ends. A reader that dies leaves its lease; it runs out."""
    lease = f"{_table_folder(table_root, table)}/leases/{uuid.uuid4().hex}"
    try:
        while True:
            path = current_path(spark, table, table_root)
            if path is None:
                raise ValueError(f"table {table} has not been loaded under {table_root}")
            files.write_text(spark, lease, path.rsplit("version=", 1)[1])
            if files.exists(spark, path):  # else it expired before the lease was there
                break
        yield spark.read.parquet(path)
    finally:
        files.delete(spark, lease)


LEASE_SECONDS = 24 * 3600


def expire(
    spark: SparkSession, table: str, table_root: str, keep: int = 2, lease_seconds: int = LEASE_SECONDS, now: float | None = None
) -> list[str]:
    """Removes versions of a table that nothing can reach any more, and says
    which: all but those of the last ``keep`` log entries and those under a
    lease younger than ``lease_seconds``. Folders that the log does not name
    may belong to a refresh still running; they go when they are older than
    that too. Log entries go with their version."""
    folder = _table_folder(table_root, table)
    oldest = ((now or time.time()) - lease_seconds) * 1000
    log = version_log(spark, table, table_root)
    entries = log.entries()
    leases = files.children(spark, f"{folder}/leases")
    held = {files.read_text(spark, f"{folder}/leases/{name}") for name, modified in leases if modified >= oldest}
    held |= {e["version"] for e in entries[-max(1, keep) :]}
    logged = {e["version"] for e in entries}
    gone = []
    for name, modified in files.children(spark, folder):
        version = name.removeprefix("version=")
        if name != version and version not in held and (version in logged or modified < oldest):
            files.delete(spark, f"{folder}/{name}")
            gone.append(version)
    for name, modified in leases:
        if modified < oldest:
            files.delete(spark, f"{folder}/leases/{name}")
    kept = [e["seq"] for e in entries if e["version"] in held]
    if kept:
        log.drop_before(min(kept))
    return gone


# --------------------------------------------------------------------------
# Date-slice replace
# --------------------------------------------------------------------------


def not_on_day(date_col: Column, as_of) -> Column:
    """Rows to keep when the slice of ``as_of`` is replaced: every other
    day, and rows whose date is NULL (a NULL never equals the run date)."""
    return ~date_col.eqNullSafe(F.lit(date_text(as_of)).cast("date"))


def replace_slice(existing: DataFrame, batch: DataFrame, as_of, date_column: str = "create_dt") -> DataFrame:
    """Pure form: existing rows of other days plus the whole batch."""
    keep = existing.filter(not_on_day(F.col(date_column), as_of))
    return keep.unionByName(batch.select(*existing.columns))


def write_days(rows: DataFrame, table_path: str, date_column: str = "create_dt") -> None:
    """Replace the partition of every day in ``rows`` by its rows, in one
    job: tasks write to a staging folder and the partitions are swapped at
    job commit, so a failed job leaves the old days in place."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(table_path)
    )


def write_slice(batch: DataFrame, table_path: str, as_of, date_column: str = "create_dt") -> str:
    """Storage form over a table partitioned by day.

    The day partition of ``as_of`` is replaced by the batch rows of that day.
    Batch rows dated on another day, or NULL, are added to what those days
    hold, as the insert of the whole batch adds them. Both happen in one job:
    the other days are rewritten with their old rows and the new ones. Days
    the batch does not name are never touched. If the batch has no row for
    the day, its old rows are deleted first.

    ``batch`` is read several times; pass a staged batch.
    """
    day = date_text(as_of)
    on_day = F.col(date_column).eqNullSafe(F.lit(day).cast("date"))
    if batch.filter(on_day).isEmpty():
        empty = batch.drop(date_column).limit(0)
        empty.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/{date_column}={day}")
    try:
        existing = read_partitioned(batch.sparkSession, table_path, batch.schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        write_days(batch, table_path, date_column)
        return table_path
    # the few other days of one batch, so that only their partitions are read
    others = [r[0] for r in batch.filter(~on_day).select(date_column).distinct().collect()]
    if others:
        batch = batch.unionByName(existing.filter(on_days(date_column, others)).select(*batch.columns))
    write_days(batch, table_path, date_column)
    return table_path


def on_days(date_column: str, days: list) -> Column:
    """Rows of one of the days (dates; None is the rows without a date)."""
    known = [date_text(d) for d in days if d is not None]
    some = F.col(date_column).isin([F.lit(d).cast("date") for d in known]) if known else F.lit(False)
    return some | F.col(date_column).isNull() if len(known) < len(days) else some


def read_partitioned(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """Read a day-partitioned table with its declared schema (the partition
    column is typed by the schema, not inferred from folder names)."""
    return spark.read.schema(schema).parquet(table_path).select(*schema.fieldNames())
