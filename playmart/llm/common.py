"""Helpers shared by the operators: tables, scratch tables, worker state."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.session import scratch_path
from playmart.sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the path is only ever opened by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run inside go as soon as each job has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later steps start from the files, so a lost executor only repeats tasks
    of the running step and nothing upstream is computed twice. The shuffle
    files of the step go with its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes the files of a table of ``materialize`` that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        files.delete(table.sparkSession, folder)


# Residues of ``likely``; their table, 16 bytes each, is what is broadcast.
RESIDUES = 1 << 18


def likely(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows whose key may be among the wanted keys: those with the hash
    residue of one. Goes before a join that would shuffle long rows; it keeps
    every wanted row, and the broadcast is bounded by the number of residues.
    """
    residue = lambda c: F.pmod(F.xxhash64(c), F.lit(RESIDUES))
    some = wanted.select(residue(F.col(wanted_key)).alias("wanted_residue")).distinct()
    return rows.join(F.broadcast(some), residue(rows[key]) == some["wanted_residue"], "left_semi")


def worker_state(name: str, build: Callable[[], object]):
    """An object kept for the life of a Python worker process, by name."""
    holder = sys.modules.setdefault("_playmart_llm_worker_state", types.ModuleType("_playmart_llm_worker_state"))
    if not hasattr(holder, name):
        setattr(holder, name, build())
    return getattr(holder, name)


def texts(column) -> list[str]:
    """An Arrow string column as a list; null is the empty text, and bytes
    that are not UTF-8 become replacement characters."""
    try:
        return [t or "" for t in column.to_pylist()]
    except UnicodeDecodeError:
        import pyarrow as pa

        return [(b or b"").decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]
