"""Helpers shared by the corpus operators: tables, distributed prefix sums, cells of hot groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coverloom.session import materialise, tune

#: White space of the word definition of every contract: ASCII only.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Options of the corpus jobs: Arrow batches small enough for very long texts."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def boxed(docs: DataFrame) -> Column:
    """The whole row as one column, so that columns beside it can have any name; ``row.*`` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def ascii_lower(c):
    return F.translate(c, UPPER, LOWER)


def prefix_sums(rows: DataFrame, group: list[str], value: str, out: str, rows_per_range: int = 20_000) -> DataFrame:
    """Add ``out``: the exclusive running sum of ``value`` along (``key``, all other columns) within each group.

    ``rows`` is a stored table with an MD5 text ``key``. Keys are uniform, so ranges of equal width of their first
    32 bits hold about equal shares of any group, a hot one too: sums per range, their prefix per group, then a window
    within each range. Rows that agree in every column are interchangeable, so reruns agree. Rows with equal keys
    (copies of one key) stay in one range.
    """
    ranges = max(1, -(-rows.count() // rows_per_range))
    at = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(2.0**32)).cast("long")
    rows = rows.withColumn("_range", at)
    totals = rows.groupBy(*group, "_range").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    totals = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_r"), "_before")
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    order = ["key", *[c for c in rows.columns if c not in ("key", "_range", *group)]]
    within = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(totals, same, "left")
    summed = joined.withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(within), F.lit(0)))
    return summed.drop("_range", "_r", "_before", *[f"_g{i}" for i in range(len(group))])


def in_cells(rows: DataFrame, keys: list[str], spread: str, limit: int, sampled: DataFrame, sample: int) -> DataFrame:
    """Add ``_i``, ``_j``, ``_own``: cells that together hold every pair of rows of a group.

    A group of at most about ``limit`` rows is the cell (0, 0). A larger one is cut by a hash of ``spread`` into chunks; each
    chunk meets itself and every other one in a cell of its own, so no cell holds more than two chunks. ``_own`` is the
    chunk of the row. ``sampled`` is about one ``sample``-th of the rows; it only tells which groups to cut, every row is kept.
    """
    hot = sampled.groupBy(*keys).agg((F.count(F.lit(1)) * sample).alias("_size")).filter(F.col("_size") > limit)
    hot = materialise(hot, "hot-buckets")
    if hot.isEmpty():
        return rows.withColumns({"_i": F.lit(0), "_j": F.lit(0), "_own": F.lit(0)})
    hot = hot.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.ceil(F.col("_size") / limit).cast("int").alias("_chunks"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_h{i}"))
    chunks = F.coalesce("_chunks", F.lit(1))
    out = rows.join(hot, same, "left").withColumn("_own", F.pmod(F.xxhash64(F.lit("chunk"), spread), chunks).cast("int"))
    out = out.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    out = out.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")})
    return out.drop("_chunks", "_other", *[f"_h{i}" for i in range(len(keys))])


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], at_least: int = 50_000) -> Iterator[pd.DataFrame]:
    """Rebatch rows sorted by ``keys`` so that no group crosses a batch; memory is ``at_least`` rows and one group."""
    held: list[pd.DataFrame] = []
    rows = 0
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows >= at_least:
            pdf = pd.concat(held, ignore_index=True)
            changed = np.flatnonzero(~(pdf[keys] == pdf[keys].iloc[-1]).all(axis=1).to_numpy())
            if len(changed):
                yield pdf.iloc[:changed[-1] + 1].reset_index(drop=True)
                pdf = pdf.iloc[changed[-1] + 1:]
            held, rows = [pdf], len(pdf) if len(changed) else 0
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def group_bounds(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Starts of the groups of sorted rows, and the end."""
    new = np.zeros(len(pdf), bool)
    new[0] = True
    for k in keys:
        v = pdf[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(pdf))


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge linked rows in place: afterwards both ends of every link carry the smallest index they reach."""
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label[:] = label[label]
        keep = label[i] != label[j]
        i, j = i[keep], j[keep]
