"""Manifest of staged files per day: which files hold rows of which day.

A stream of staged files notes, from the files' own metadata, every (day,
file) pair it sees. To rebuild a day, only the files noted for it are opened,
however long the history of staged files is.

The manifest is a small table in partitions by day; adding a micro-batch
rewrites the partitions of its days, in one job, with the union of what they
held and the new files. So a replayed micro-batch changes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.sqltext import date_text
from playmart.sources import files
from playmart.sources.warehouse import write_days

ENTRIES = "file STRING, size BIGINT, modified TIMESTAMP, seq BIGINT, day DATE"
# Columns that a reader of staged files adds to its rows.
FILE_COLUMNS = {"_file": "_metadata.file_path", "_size": "_metadata.file_size", "_modified": "_metadata.file_modification_time"}
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def with_file_columns(staged: DataFrame) -> DataFrame:
    """The rows with the file each was read from."""
    return staged.select("*", *[F.col(source).alias(name) for name, source in FILE_COLUMNS.items()])


def days_of(rows: DataFrame, date_column: str) -> list[_dt.date | None]:
    """The days of a micro-batch: a partial distinct per task, few rows."""
    return [r[0] for r in rows.select(date_column).distinct().collect()]


def entries(spark: SparkSession, manifest: str, days: list[_dt.date | None]) -> DataFrame:
    """(file, size, modified, seq, day) noted for the days; reads their
    partitions only."""
    folders = [f"{manifest.rstrip('/')}/day={_NO_DAY if d is None else date_text(d)}" for d in days]
    there = [f for f in folders if files.exists(spark, f)]
    if not there:
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).option("basePath", manifest).parquet(*there)


def record(batch: DataFrame, manifest: str, date_column: str, seq: int) -> list[_dt.date | None]:
    """Notes the files of a micro-batch with ``FILE_COLUMNS``; returns its days."""
    seen = batch.groupBy(F.col("_file").alias("file"), F.col(date_column).alias("day")).agg(
        F.max("_size").alias("size"), F.max("_modified").alias("modified"), F.lit(seq).cast("bigint").alias("seq")
    )
    days = days_of(batch, date_column)
    known = entries(batch.sparkSession, manifest, days).select(*seen.columns)
    # a file noted before keeps the number it came with
    union = seen.unionByName(known).groupBy("file", "day").agg(
        F.max("size").alias("size"), F.max("modified").alias("modified"), F.min("seq").alias("seq")
    )
    if days:
        write_days(union.select("file", "size", "modified", "seq", "day").coalesce(1), manifest, "day")
    return days


def files_of(spark: SparkSession, manifest: str, days: list[_dt.date | None]) -> list[str]:
    """The files noted for the days that still exist: a slice staged anew
    under the same key has replaced its former files."""
    noted = entries(spark, manifest, days).select("file").distinct().collect()
    return files.present(spark, [r.file for r in noted])
