"""Incremental load of staged daily status slices with Structured Streaming.

Replaces polling for a landing file: a file-source stream notices staged
files once (tracked in its checkpoint). A micro-batch notes its files in the
manifest and says which days have new ones; each of those days is then rebuilt
from all files noted for it, no others being opened, and replaces the day's
partition. So a day may come in any number of files, in any order and in any
number of micro-batches, and replaying one changes nothing. A corrected slice
is staged over the old one, under the same key.

Run it with ``available_now=True`` from the daily schedule (process what has
landed, then stop) or continuously with a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from playmart import schemas
from playmart.sources import manifest
from playmart.sources.warehouse import on_days, write_days


def slices_of(spark: SparkSession, manifest_path: str, days: list) -> DataFrame | None:
    """All staged rows of the days, from the files noted for them."""
    paths = manifest.files_of(spark, manifest_path, days)
    if not paths:
        return None
    staged = spark.read.schema(schemas.GAME_STATUS).parquet(*paths)
    return staged.filter(on_days("create_dt", days))  # a file may hold other days too


def replace_days(batch: DataFrame, epoch: int, manifest_path: str, table_path: str) -> list:
    """Every day with a row in ``batch`` is replaced by all its staged rows;
    other days are untouched. Returns the days."""
    days = manifest.record(batch, manifest_path, "create_dt", epoch)
    whole = slices_of(batch.sparkSession, manifest_path, days) if days else None
    if whole is not None:
        write_days(whole.select(*schemas.GAME_STATUS.fieldNames()), table_path)
    return days


def start_status_loader(
    spark: SparkSession,
    staged_dir: str,
    table_path: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "10 minutes",
    max_files_per_trigger: int | None = None,
    manifest_path: str | None = None,
) -> StreamingQuery:
    """``checkpoint``: a shared folder of this stream alone. The manifest is
    beside the table unless ``manifest_path`` says otherwise; it belongs to
    the checkpoint, which decides what the stream has seen."""
    manifest_path = manifest_path or f"{table_path.rstrip('/')}_manifest"
    reader = spark.readStream.schema(schemas.GAME_STATUS).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    slices = manifest.with_file_columns(reader.parquet(staged_dir))
    writer = (
        slices.writeStream.foreachBatch(lambda df, epoch: replace_days(df, epoch, manifest_path, table_path))
        .option("checkpointLocation", checkpoint)
        .queryName("status_slice_loader")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
