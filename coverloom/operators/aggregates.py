"""Aggregations beyond a plain groupBy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.exprs import col, text
from coverloom.operators.joins import with_stats
from coverloom.session import materialise


def share_of_total(df: DataFrame, measure: str, name: str = "PCT", digits: int = 1) -> DataFrame:
    """Percentage of the column total, from a one-row total instead of a global window."""
    total = df.agg(F.sum(measure).alias("_total"))
    pct = F.round(col(measure).cast("double") / F.nullif(F.col("_total"), F.lit(0)).cast("double") * 100, digits)
    return with_stats(df, total).withColumn(name, pct).drop("_total")


def column_profile(df: DataFrame, width: int = 8) -> DataFrame:
    """Rows, non-NULL and distinct values of every column.

    Counts come from one aggregate, one row for all columns. Columns without values are done then; the others are taken
    ``width`` at a time, so each pass reads its own columns only and multiplies rows by ``width`` at most. Values are made
    distinct before the shuffle, so a frequent value costs one row per task.
    """
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)]).first()
    known = [(c, counts["_rows"], counts[f"_n{i}"]) for i, c in enumerate(df.columns)]
    given = [c for c, _, n in known if n]
    found = df.sparkSession.createDataFrame([], "column_name string, distinct_values long")
    for at in range(0, len(given), width):
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("v")) for c in given[at:at + width]])
        values = df.select(F.inline(pairs)).filter(F.col("v").isNotNull()).distinct()
        found = found.unionByName(values.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values")))
    columns = df.sparkSession.createDataFrame(known, "column_name string, row_count long, non_null long")
    return columns.join(found, "column_name", "left").select("column_name", "row_count", "non_null", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table as one result."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``surplus`` = copies in left minus copies in right."""
    sign = lambda df, n: df.select(*[col(c) for c in left.columns], F.lit(n).alias("_n"))
    both = sign(left, 1).unionByName(sign(right, -1))
    return (both.groupBy(*[col(c) for c in left.columns]).agg(F.sum("_n").alias("surplus"))
            .filter(F.col("surplus") != 0))


def difference_by_digest(left: DataFrame, right: DataFrame, buckets: int = 1 << 16) -> DataFrame:
    """``difference`` of two stored tables that should be equal: first by digests, then the rows of buckets that differ.

    A row's bucket comes from a hash of all its columns; counts and sums of two 64-bit hashes per bucket are compared, at most
    ``buckets`` rows a side. Wide rows are only exchanged where these differ, so equal tables exchange digests alone. Both tables are scanned twice.
    """
    kinds = {f.name: f.dataType for f in left.limit(0).unionByName(right.select(*[col(c) for c in left.columns]).limit(0)).schema}
    hashed = lambda *seed: F.xxhash64(*seed, *[col(c) for c in kinds])
    bucket = F.pmod(hashed(), F.lit(buckets))
    sides, digests = [], []
    for df, sign in ((left, 1), (right, -1)):
        # plain columns stay plain: Catalyst would pair every alias with its origin in all that is known about the hash of them all
        rows = df.select(*[col(c) if df.schema[c].dataType == kind else col(c).cast(kind).alias(c) for c, kind in kinds.items()])
        total = lambda h: F.sum(h.cast("decimal(20,0)") * F.lit(sign))  # noqa: B023, E731
        digests.append(rows.groupBy(bucket.alias("_bucket")).agg(
            F.sum(F.lit(sign)).alias("_rows"), total(hashed()).alias("_a"), total(hashed(F.lit("second"))).alias("_b")))
        sides.append((rows, sign))
    added = digests[0].unionByName(digests[1]).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in ("_rows", "_a", "_b")])
    differing = materialise(added.filter((F.col("_rows") != 0) | (F.col("_a") != 0) | (F.col("_b") != 0)).select("_bucket"), "differing-buckets")
    sides = [rows.join(differing, bucket == F.col("_bucket"), "left_semi").withColumn("_n", F.lit(sign)) for rows, sign in sides]
    both = sides[0].unionByName(sides[1])
    return (both.groupBy(*[col(c) for c in left.columns]).agg(F.sum("_n").alias("surplus"))
            .filter(F.col("surplus") != 0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def distinct_where(condition: Column, c: str) -> Column:
    return F.count_distinct(F.when(condition, col(c)))
