"""Key-only tables bucketed by their key: a daily run looks up which keys are loaded without moving or widely reading the history."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class KeyTable:
    """A Parquet folder of ``columns`` (a schema in text form), bucketed by ``key``.

    The session's catalog only holds its declaration, which each session repeats, so the folder is all that must be kept. A join on
    the key reads it bucket by bucket without an exchange; the other side is exchanged once, or not at all if it is
    bucketed alike. ``buckets`` is fixed when the table is created: choose it so that a bucket of the largest size expected fits a task.
    """

    path: str
    columns: str
    key: str
    buckets: int = 256

    def _declare(self, spark: SparkSession) -> str:
        name = "keys_" + hashlib.md5(f"{self.path} {self.columns} {self.buckets}".encode()).hexdigest()
        place = self.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self.columns}) USING parquet CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return name

    def read(self, spark: SparkSession) -> DataFrame:
        name = self._declare(spark)
        spark.catalog.refreshTable(name)
        return spark.table(name)

    def add(self, rows: DataFrame) -> None:
        """Append rows, by name; each bucket gets one file. Repeated keys do no harm to a lookup."""
        name = self._declare(rows.sparkSession)
        names = T.StructType.fromDDL(self.columns).fieldNames()
        rows.select(*[F.col(f"`{c}`") for c in names]).repartition(self.buckets, F.col(f"`{self.key}`")).write.insertInto(name)
