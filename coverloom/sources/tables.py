"""Stored tables: read, replace, append by name, one-row logs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.functions import schemas as S
from coverloom.functions.exprs import at, col


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Create or replace a table or one partition folder of a table; ``df`` may read ``path``.

    The new one is written beside the old one, under a name that readers of the parent folder skip, and swapped in by renaming, so a failed job
    leaves the old one. A run that stops between the two renames leaves it as ``_<name>.old``.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    new, old = f"{parent}/_{name}.new-{uuid.uuid4().hex}", f"{parent}/_{name}.old"
    df.write.mode("errorifexists").partitionBy(*partitions).parquet(new)
    at_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = at_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at_path(path)):
        fs.delete(at_path(old), True)
        if not fs.rename(at_path(path), at_path(old)):
            raise RuntimeError(f"{path} can't be renamed")
    if not fs.rename(at_path(new), at_path(path)):
        raise RuntimeError(f"{new} can't be renamed to {path}")
    fs.delete(at_path(old), True)
    spark.catalog.refreshByPath(path)


def run_name(run_ts: str) -> str:
    """A run's time as the name of a folder."""
    return "".join(c for c in run_ts if c.isdigit())


def append(df: DataFrame, path: str, contract: T.StructType) -> None:
    """Append the contract's columns by name, in its order and types."""
    S.shape(df, contract).write.mode("append").parquet(path)


def append_once(df: DataFrame, path: str, contract: T.StructType, kind: str, run_ts: str) -> None:
    """``append``, unless rows of this run are there already: rows of ``df`` are left out whose ``kind`` column has a value that the run has logged."""
    if exists(df.sparkSession, path):
        done = read(df.sparkSession, path, contract).filter(col("CREATED_AT") == at(run_ts)).select(kind).distinct()
        df = df.join(done, kind, "left_anti")
    append(df, path, contract)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def monitor_row(spark: SparkSession, check: str, status: str, details: DataFrame, run_ts: str) -> DataFrame:
    """One log row; ``details`` is a one-row DataFrame turned into a JSON object."""
    row = details.select(F.to_json(F.struct(*[col(c) for c in details.columns])).alias("DETAILS"))
    return S.shape(row, S.MONITOR_LOG, LOG_ID=F.expr("uuid()"), CHECK_TYPE=F.lit(check), STATUS=F.lit(status), CREATED_AT=at(run_ts))


def alert_row(found: DataFrame, kind: str, count: str, message, run_ts: str) -> DataFrame:
    """Alert rows for the rows of ``found`` (none when it is empty)."""
    return S.shape(found, S.ALERTS, ALERT_ID=F.expr("uuid()"), ALERT_TYPE=F.lit(kind), ALERT_MSG=message,
                   RECORD_COUNT=col(count), CREATED_AT=at(run_ts))


