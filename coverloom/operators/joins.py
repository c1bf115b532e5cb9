"""Join shapes. No side is broadcast by hint here: Spark broadcasts a side when its measured size
allows, and splits skewed partitions of the other joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.exprs import at, col
from coverloom.operators.ordered import HOT_ROWS, MAX_SLICES, NEVER, hot_groups, latest_per_key
from coverloom.session import materialise


def pairs(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & (col(a) == col(b))
    return out


def _side(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_r{i}" for i in range(len(keys))]
    return df.select(*[col(k).alias(n) for k, n in zip(keys, names, strict=True)]), names


def _keys_of(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Distinct keys: a frequent key of the checked side collapses before the shuffle."""
    side, names = _side(df, keys)
    return side.distinct(), names


def absent(df: DataFrame, other: DataFrame, keys: list[str], other_keys: list[str] | None = None,
           only: Column | None = None) -> DataFrame:
    """Rows of ``df`` without a partner; with ``only``, just the rows meeting it are checked."""
    side, names = _keys_of(other, other_keys or keys)
    on = pairs(keys, names)
    return df.join(side, on if only is None else on & only, "left_anti")


def present(df: DataFrame, other: DataFrame, keys: list[str],
            other_keys: list[str] | None = None) -> DataFrame:
    side, names = _keys_of(other, other_keys or keys)
    return df.join(side, pairs(keys, names), "left_semi")


def join_spread(big: DataFrame, small: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    """Inner join on equally named keys where a key of ``big`` may be frequent.

    Rows of frequent keys are spread by a hash of the whole row over as many parts as the key's
    size asks for, and the partners of just these keys are repeated once per part. Without
    frequent keys this is a plain join.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    hot = None if limit >= NEVER else hot_groups(big, keys, limit)
    if hot is None:
        return big.join(small, keys)
    parts = F.least(F.lit(MAX_SLICES), F.ceil(F.col("_size") / F.lit(limit))).cast("int")
    # At most rows / hot_rows keys are frequent; stored, so Spark knows their size and broadcasts them by it.
    marked = materialise(hot, "hot-keys").select(*[col(k) for k in keys], parts.alias("_parts"))
    count = F.coalesce("_parts", F.lit(1))
    salt = F.pmod(F.xxhash64(*[col(c) for c in big.columns]), count).cast("int")
    left = big.join(marked, keys, "left").withColumn("_salt", salt).drop("_parts")
    right = (small.join(marked, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1))).drop("_parts"))
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def lookup_spread(df: DataFrame, big: DataFrame, keys: list[str], take: list[str], prefix: str,
                  hot_rows: int | None = None) -> DataFrame:
    """Left join on equally named keys, where a key of the looked-up side may be frequent."""
    renamed = {c: f"{prefix}{c}" for c in take}
    side = big.select(*[col(k) for k in keys], *[col(c).alias(n) for c, n in renamed.items()])
    limit = HOT_ROWS if hot_rows is None else hot_rows
    if limit >= NEVER or hot_groups(side, keys, limit) is None:
        return df.join(side, keys, "left")
    matched = join_spread(side, df, keys, limit)
    return matched.unionByName(absent(df, side, keys), allowMissingColumns=True)


def drop_listed(df: DataFrame, condition: Column, key: str, listed: DataFrame, listed_key: str,
                null_aware: bool = False) -> DataFrame:
    """Rows except those that meet ``condition`` and whose key is listed.

    ``null_aware=True`` follows NOT IN: a NULL in the list, or a NULL key against a non-empty list,
    makes the test unknown and drops the row.
    """
    kept = absent(df, listed, [key], [listed_key], only=condition)
    if not null_aware:
        return kept
    facts = listed.agg(F.count(F.lit(1)).alias("_any"),
                       F.max(col(listed_key).isNull().cast("int")).alias("_null"))
    unknown = (F.col("_null") == 1) | (col(key).isNull() & (F.col("_any") > 0))
    return (kept.crossJoin(F.broadcast(facts))  # one row by construction
            .filter(~(F.coalesce(condition, F.lit(False)) & F.coalesce(unknown, F.lit(False))))
            .drop("_any", "_null"))


def flagged(df: DataFrame, other: DataFrame, keys: list[str], other_keys: list[str], name: str,
            yes: str = "1", no: str = "0", distinct: bool = True) -> DataFrame:
    """Add ``name``: ``yes`` where a partner exists. ``distinct=False`` keeps the fan-out."""
    side, names = _side(other, other_keys)
    if distinct:
        side = side.distinct()
    joined = df.join(side.withColumn("_hit", F.lit(True)), pairs(keys, names), "left")
    return joined.withColumn(name, F.when(F.col("_hit"), yes).otherwise(no)).drop("_hit", *names)


def lookup(df: DataFrame, dim: DataFrame, keys: list[str], dim_keys: list[str],
           take: dict[str, str | Column], only: Column | None = None) -> DataFrame:
    """Left join adding ``take`` = {new name: dimension column}. Fan-out is kept."""
    names = [f"_r{i}" for i in range(len(dim_keys))]
    side = dim.select(*[col(k).alias(n) for k, n in zip(dim_keys, names, strict=True)],
                      *[col(c).alias(n) for n, c in take.items()])
    on = pairs(keys, names)
    return df.join(side, on if only is None else on & only, "left").drop(*names)


def per_group(df: DataFrame, stored: DataFrame, group: str, columns: list[str], add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``add(df)`` for left joins on ``columns``: they are made for the distinct (group, columns) of ``stored`` only, whose results are joined back by group.

    So narrow rows travel by ``columns``, and the wide ones stay dealt by ``group``. ``stored`` holds all of these that ``df`` has and is cheap to
    read. Rows without a group can't be joined back; where there are any, all rows travel.
    """
    if not stored.filter(col(group).isNull()).isEmpty():
        return add(df)
    ids = stored.select(col(group), *[col(c) for c in columns]).distinct()
    found = add(ids)
    names = {c: f"_g{i}" for i, c in enumerate(columns)}
    on = col(group) == F.col("_g")
    for c, n in names.items():
        on = on & col(c).eqNullSafe(F.col(n))
    side = found.select(col(group).alias("_g"), *[col(c).alias(n) for c, n in names.items()], *[col(c) for c in found.columns if c not in ids.columns])
    return df.join(side, on, "left").drop("_g", *names.values())


def valid_now(dim: DataFrame, run_ts: str) -> DataFrame:
    return dim.filter(at(run_ts).between(col("VALID_FROM_DTTM"), col("VALID_TO_DTTM")))


def latest_version(dim: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the row with the latest validity end; ties go to the smallest value."""
    order = [col("VALID_TO_DTTM").desc_nulls_first(), col(value).asc_nulls_last()]
    return latest_per_key(dim, [key], order).select(col(key), col(value))


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach the one row of a global aggregate to every row."""
    return df.crossJoin(F.broadcast(stats))
