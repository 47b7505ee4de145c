"""Game-aligned storage (J1, J2, J5, J7): raw tables bucketed and sorted by
``game_id``, all into the same number of buckets.

A game's catalogue row, reviews and snapshots lie in buckets of one number,
so that per-game aggregates and game-to-game joins read them bucket by bucket
and shuffle nothing. Writing shuffles once, for all models and days that read
the table after it.

The files are a table of their own under ``folder``; the entry in a session's
catalog only names them, and any session makes its own.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from playmart import schemas
from playmart.functions.sqltext import literal
from playmart.sources.commits import CommitLog

KEY = "game_id"
BUCKETS = 64
SCHEMAS = {"game_info": schemas.GAME_INFO, "game_status": schemas.GAME_STATUS, "comment_data": schemas.COMMENT_DATA}


class AlignedTables:
    """The three raw tables under ``folder``, bucketed by game."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), int(buckets)

    def _log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.folder}/{table}/log")

    def _named(self, table: str, path: str) -> str:
        """The catalog's name of the files at ``path``, entered if need be."""
        name = f"aligned_{hashlib.md5(path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[table].fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (path {literal(path)}) "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS"
        )
        return name

    def write(self, table: str, rows: DataFrame) -> None:
        """A new version of the table, one file per bucket; readers see it by
        its log entry."""
        version = f"{self.folder}/{table}/version={uuid.uuid4().hex}"
        name = self._named(table, version)
        dealt = rows.select(*SCHEMAS[table].fieldNames()).repartition(self.buckets, KEY).sortWithinPartitions(KEY)
        dealt.write.insertInto(name)
        self._log(table).append(lambda _last: {"path": version, "buckets": self.buckets})

    def read(self, table: str) -> DataFrame:
        last = self._log(table).last()
        if last is None:
            raise ValueError(f"table {table} has not been written under {self.folder}")
        if last["buckets"] != self.buckets:
            raise ValueError(f"table {table} has {last['buckets']} buckets, not {self.buckets}")
        return self.spark.table(self._named(table, last["path"]))

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in SCHEMAS}
