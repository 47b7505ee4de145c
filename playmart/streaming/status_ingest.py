"""The daily status run as a stream: landed player-count documents ->
status slices of their days -> date-slice replace.

Player-count documents land under ``<landing>/player_counts/dt=<day>/``. A
file-source stream notices each landed file once (tracked in its checkpoint);
a micro-batch says which days have new documents, and the slice of each of
those days (all catalogue games, 0 for a game without a document) is built
from all the documents landed for the day. A late file completes its day, and
a replayed micro-batch leaves the same table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playmart import schemas
from playmart.operators import ingest
from playmart.plans.pipeline import Warehouse

LANDED_COUNTS = "game_id BIGINT, body STRING, dt DATE"


def load_days(batch: DataFrame, wh: Warehouse, landed_counts: str) -> list[str]:
    """Build and load the slices of every day in ``batch``, in one job.

    Only the distinct days of the micro-batch reach the driver; documents
    are read again from the landing folder, so that each day is whole.
    """
    days = sorted(str(r["dt"]) for r in batch.select("dt").distinct().collect() if r["dt"] is not None)
    if days:
        docs = wh.spark.read.schema(LANDED_COUNTS).parquet(landed_counts).filter(F.col("dt").cast("string").isin(days))
        totals = ingest.game_review_totals(wh.table("game_info"))
        slices = ingest.ingest_status_days(totals, docs, days)
        rows = slices.select(*schemas.GAME_STATUS.fieldNames())
        wh.publish({}, wh.write_status(rows, f"stream-{uuid.uuid4().hex}", days))
    return days


def start_status_ingest(
    spark: SparkSession,
    landing_dir: str,
    warehouse_dir: str,
    checkpoint: str,
    prefix: str = "pm_",
    available_now: bool = True,
    interval: str = "10 minutes",
) -> StreamingQuery:
    """``checkpoint``: a shared folder of this stream alone."""
    wh = Warehouse(spark, warehouse_dir, prefix)
    landed = f"{landing_dir.rstrip('/')}/player_counts"
    docs = spark.readStream.schema(LANDED_COUNTS).parquet(landed)
    writer = (
        docs.writeStream.foreachBatch(lambda batch, _epoch: load_days(batch, wh, landed))
        .option("checkpointLocation", checkpoint)
        .queryName("status_ingest")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
