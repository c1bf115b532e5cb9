"""Registered queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from coverloom.catalog.star import TABLES, Star
from coverloom.functions.exprs import col
from coverloom.session import size_shuffles, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``f(star)``; ``sql`` is the same question for the second engine."""

    def add(f: Callable[[Star], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            size_shuffles(tune(spark), *[f"{sf_dir}/{t}.parquet" for t in TABLES])
            return plain(f(Star(spark, sf_dir)))

        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return f

    return add


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text: the open end lies beyond what some clients can hold."""
    return df.select(*[col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else col(f.name)
                       for f in df.schema])
