"""Uniqueness of a batch against all keys stored before (Q-U, A9).

The keys are kept in a table that is bucketed and sorted by key, with their
number of rows. A batch is reduced to its distinct keys, dealt out to the
same buckets and joined with the stored ones bucket by bucket: only the
batch's keys move, the stored side is read where it lies, without a shuffle.
Row groups carry minima, maxima and Bloom filters of the keys.

Adding a batch appends its keys to the buckets; a key that comes again gets a
further row, so counts are summed on reading, again within buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.sqltext import literal

BUCKETS = 64


class KeyIndex:
    """The key table at ``location``. Its entry in the session's catalog only
    names the files, any session makes its own."""

    def __init__(self, spark: SparkSession, location: str, key_type: str = "STRING", buckets: int = BUCKETS):
        self.spark, self.location, self.buckets = spark, location.rstrip("/"), buckets
        self.name = f"key_index_{hashlib.md5(self.location.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (key {key_type}, n BIGINT) USING parquet "
            f"OPTIONS ('parquet.bloom.filter.enabled#key' 'true', path {literal(self.location)}) "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {int(buckets)} BUCKETS"
        )

    def stored(self) -> DataFrame:
        """(key, n) of the stored keys, one row per key; no shuffle."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).groupBy("key").agg(F.sum("n").alias("n"))

    def keys_of(self, batch: DataFrame, column: str) -> DataFrame:
        """(key, n) of a batch, dealt out as the buckets are. Partial counts go
        first, so that a key that fills the batch does not fill a task."""
        counted = batch.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return counted.repartition(self.buckets, "key")

    def failures(self, batch: DataFrame, column: str) -> DataFrame:
        """Keys of the batch that would occur more than once in the whole
        table with the batch, and their number of rows there."""
        stored = self.stored().withColumnRenamed("n", "stored_n")
        found = self.keys_of(batch, column).join(stored, "key", "left")
        rows = F.col("n") + F.coalesce("stored_n", F.lit(0))
        return found.select(F.col("key").alias(column), rows.alias("n_records")).filter("n_records > 1")

    def all_failures(self, column: str) -> DataFrame:
        """Failing keys of everything added, as the unique test gives them."""
        return self.stored().filter("n > 1").select(F.col("key").alias(column), F.col("n").alias("n_records"))

    def add(self, batch: DataFrame, column: str) -> None:
        self.keys_of(batch, column).sortWithinPartitions("key").write.insertInto(self.name)
