"""Ordered per-group operators that stay distributed when one group is huge.

A Spark window sends a whole group to one task. ``along`` uses such a window as long as every
group is small. Groups above ``hot_rows`` are cut into slices of their order; the window then runs
per (group, slice), and what crosses a slice border (the neighbour row, the number of rows before,
a group maximum) comes from one summary row per slice. Slices are a function of row values and of
cut points written to the shared folder, so a recomputed task sees the same slices.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverloom.functions.exprs import col
from coverloom.session import materialise

HOT_ROWS = 5_000_000
NEVER = 2**62  # as ``hot_rows``: the caller knows that no group is hot
MAX_SLICES = 4096  # a group above MAX_SLICES * hot_rows rows has larger slices
_BLOCK = 64  # cut points are searched in two steps of at most 64 comparisons each
_TRACKED, _SUSPECTS = 1 << 16, 12_000  # of the sketch of frequent keys: at most _TRACKED / 7 keys are hot where it is used
RANGE_ROWS = 1_000_000  # distinct keys that one task ranks
_DRAWS = 50  # sampled rows per wanted slice; the sample only places the cuts


@dataclass(frozen=True)
class Asc:
    """Ascending sort item; ``nulls_first`` places NULLs."""

    name: str
    nulls_first: bool = False

    def sort(self) -> Column:
        c = col(self.name)
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def encoded(self) -> list[Column]:
        c = col(self.name)
        null_rank, value_rank = (0, 1) if self.nulls_first else (1, 0)
        return [F.when(c.isNull(), null_rank).otherwise(value_rank), c]


def by(*names: str | Asc) -> list[Asc]:
    return [n if isinstance(n, Asc) else Asc(n) for n in names]


def _position(order: list[Asc]) -> Column:
    """The sort items as one comparable struct that sorts like the window."""
    parts = [p for item in order for p in item.encoded()]
    return F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _same(keys: list[str], prefix: str) -> list[Column]:
    return [col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)]


def _renamed(keys: list[str], prefix: str) -> list[Column]:
    return [col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Groups above ``hot_rows`` with their sizes, or None.

    A sketch of frequent items finds the suspects in one pass that shuffles no keys; usually there are none. It holds every key with more than
    two of its errors, 3.5 / ``_TRACKED`` of all rows each, and its estimates are never too low. Only rows of suspects are then counted, exactly,
    by key. More rows than the sketch is good for are counted by key at once, combined before the shuffle.
    """
    mark, rows = F.xxhash64(F.lit(0), *[col(k) for k in keys]), df
    sketch = F.call_function("approx_top_k", mark, F.lit(_SUSPECTS), F.lit(_TRACKED))
    seen = df.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    if seen["n"] * 2 * 3.5 / _TRACKED < hot_rows:
        suspects = [(s["item"],) for s in seen["top"] if s["count"] > hot_rows]
        if not suspects:
            return None
        listed = df.sparkSession.createDataFrame(suspects, "_mark long")
        rows = df.join(listed, mark == F.col("_mark"), "left_semi")
    sizes = rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_size"))
    hot = sizes.filter(F.col("_size") > hot_rows)
    return None if hot.isEmpty() else hot


def hot_limit(probe: DataFrame, keys: list[str], hot_rows: int | None) -> int:
    """``hot_rows`` if the probe has a hot group, else ``NEVER``; one check for several operators."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    return NEVER if hot_groups(probe, keys, hot_rows) is None else hot_rows


def _cuts(df: DataFrame, keys: list[str], order: list[Asc], hot_rows: int) -> DataFrame | None:
    """Cut points per hot group: sampled positions, about one slice per ``hot_rows`` rows."""
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        return None
    slices = F.least(F.lit(MAX_SLICES), F.ceil(F.col("_size") / F.lit(hot_rows))).cast("int")
    # At most rows / hot_rows groups are hot. Stored, so Spark knows their size; no side is broadcast by hint.
    small = materialise(hot, "hot-groups").select(*_renamed(keys, "_h"), "_size", slices.alias("_slices"))
    rows = df.join(small, _all(_same(keys, "_h")), "inner")
    drawn = (rows.filter(F.rand(7) < F.lit(_DRAWS) * F.col("_slices") / F.col("_size"))
             .groupBy(*[col(k) for k in keys])
             .agg(F.sort_array(F.collect_list(_position(order))).alias("_drawn"),
                  F.first("_slices").alias("_slices")))
    step = F.greatest(F.lit(1), F.floor(F.size("_drawn") / F.col("_slices"))).cast("int")
    picked = F.filter("_drawn", lambda _, i: ((i + 1) % F.col("_step")) == 0)
    cuts = drawn.withColumn("_step", step).select(*[col(k) for k in keys],
                                                  F.array_distinct(picked).alias("_cuts"))
    return materialise(cuts, "cut-points")


def _with_slices(df: DataFrame, keys: list[str], order: list[Asc], cuts: DataFrame) -> DataFrame:
    """Add ``_slice``: 0 for ordinary groups, 1.. for slices of hot groups."""
    here = _position(order)
    reached = lambda points: F.size(F.filter(points, lambda c: c <= here))
    coarse = F.filter("_cuts", lambda _, i: (i % _BLOCK) == 0)
    block = F.greatest(reached(coarse) - 1, F.lit(0))
    fine = F.slice(F.col("_cuts"), block * _BLOCK + 1, F.lit(_BLOCK))
    number = F.when(F.col("_cuts").isNull(), 0).otherwise(block * _BLOCK + reached(fine) + 1)
    small = cuts.select(*_renamed(keys, "_c"), "_cuts")
    joined = df.join(small, _all(_same(keys, "_c")), "left")
    return joined.withColumn("_slice", number).drop("_cuts", *[f"_c{i}" for i in range(len(keys))])


def along(
    df: DataFrame,
    keys: list[str],
    order: list[str | Asc],
    *,
    prev: tuple[str, list[str]] | None = None,
    next: tuple[str, list[str]] | None = None,
    rank: str | None = None,
    earlier: tuple[str, Column] | None = None,
    whole: dict[str, Column] | None = None,
    hot_rows: int | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add ordered per-group columns.

    - ``prev=(name, cols)`` / ``next=(name, cols)``: struct of the neighbour's columns, NULL at the edge
    - ``rank=name``: 1-based position
    - ``earlier=(name, condition)``: earlier rows meeting the condition, NULL on the first row
    - ``whole={name: expr}``: maximum of the expression over the group

    ``probe`` is a cheaper DataFrame used to look for hot groups, by default ``df`` itself. It has
    the keys and at least the first order columns; cuts are placed by the columns it has.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    order = by(*order)
    whole = whole or {}
    probe = df if probe is None else probe
    shared = list(takewhile(lambda o: o.name in probe.columns, order))
    cuts = None if hot_rows >= NEVER else _cuts(probe, keys, shared, hot_rows)
    part = [col(k) for k in keys]
    if cuts is not None:
        df = _with_slices(df, keys, shared, cuts)
        part = [*part, F.col("_slice")]
    group = Window.partitionBy(*part)
    w = group.orderBy(*[o.sort() for o in order])

    # Values are first computed per window group, then completed across slice borders.
    local: dict[str, Column] = {}
    if prev:
        local[prev[0]] = F.lag(_record(prev[1])).over(w)
    if next:
        local[next[0]] = F.lead(_record(next[1])).over(w)
    if rank:
        local[rank] = F.row_number().over(w).cast("long")
    if earlier:
        hit = F.when(earlier[1], 1).otherwise(0)
        local[earlier[0]] = F.sum(hit).over(w.rowsBetween(Window.unboundedPreceding, -1))
    for name, expr in whole.items():
        local[name] = F.max(expr).over(group)
    out = df.select("*", *[c.alias(n) for n, c in local.items()])
    if cuts is None:
        return out

    # One row per slice: at most 2 * rows / hot_rows of them.
    edges = materialise(_edges(df, keys, order, prev, next, earlier, whole), "slice-edges")
    on = _all([*_same(keys, "_e"), F.col("_slice") == F.col("_e_slice")])
    joined = out.join(edges, on, "left")
    rows_before = F.coalesce(F.col("_rows_before"), F.lit(0))
    done: dict[str, Column] = {}
    if prev:
        done[prev[0]] = F.coalesce(col(prev[0]), F.col("_prev"))
    if next:
        done[next[0]] = F.coalesce(col(next[0]), F.col("_next"))
    if rank:
        done[rank] = col(rank) + rows_before
    if earlier:
        inner = col(earlier[0])
        done[earlier[0]] = F.when(rows_before == 0, inner).otherwise(
            F.coalesce(inner, F.lit(0)) + F.col("_hits_before"))
    for i, name in enumerate(whole):
        done[name] = F.coalesce(F.col(f"_whole{i}"), col(name))
    return joined.select(*[done[c].alias(c) if c in done else col(c) for c in out.columns if c != "_slice"])


def _record(cols: list[str]) -> Column:
    return F.struct(*[col(c).alias(c) for c in cols])


def _edges(df, keys, order, prev, next, earlier, whole) -> DataFrame:
    """One row per slice of a hot group with what its rows need from the other slices."""
    at = _position(order)
    totals = [F.count(F.lit(1)).alias("_n")]
    if prev:
        totals.append(F.max_by(_record(prev[1]), at).alias("_last"))
    if next:
        totals.append(F.min_by(_record(next[1]), at).alias("_first"))
    if earlier:
        totals.append(F.sum(F.when(earlier[1], 1).otherwise(0)).alias("_hits"))
    totals += [F.max(expr).alias(f"_max{i}") for i, expr in enumerate(whole.values())]
    part = [col(k) for k in keys]
    slices = df.filter(F.col("_slice") > 0).groupBy(*part, F.col("_slice")).agg(*totals)
    group = Window.partitionBy(*part)
    w = group.orderBy("_slice")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    cols = [*_renamed(keys, "_e"), F.col("_slice").alias("_e_slice"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before")]
    if prev:
        cols.append(F.lag("_last").over(w).alias("_prev"))
    if next:
        cols.append(F.lead("_first").over(w).alias("_next"))
    if earlier:
        cols.append(F.coalesce(F.sum("_hits").over(before), F.lit(0)).alias("_hits_before"))
    cols += [F.max(f"_max{i}").over(group).alias(f"_whole{i}") for i in range(len(whole))]
    return slices.select(*cols)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order (NODUPKEY).

    ``row_number() = 1`` is cut to one row per key before the shuffle (WindowGroupLimit), so a hot
    key sends one row per map task.
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def append_nodupkey(frames: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """UNION ALL by name, then one row per key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return latest_per_key(out, keys, order)


def dense_ranks(df: DataFrame, keys: list[str], name: str, hot_rows: int | None = None) -> DataFrame:
    """Distinct keys as one struct ``_id`` with their dense rank (ascending, NULLs last).

    The distinct keys are dealt into ranges of their order and sorted there; a key's rank is its place in its range after the rows of the ranges before.
    So there is no single-task window, and no key is compared with cut points. Within the struct NULL equals NULL, so unresolved keys share a rank.
    """
    ids = materialise(df.select(*[col(k) for k in keys]).distinct(), "distinct-keys")
    count, tasks = ids.count(), ids.sparkSession.sparkContext.defaultParallelism
    share = min(hot_rows or HOT_ROWS, RANGE_ROWS, max(10_000, -(-count // tasks)))
    order = [o.sort() for o in by(*keys)]
    dealt = ids.repartitionByRange(max(1, -(-count // share)), *order).sortWithinPartitions(*order)
    # Stored, as the places hold for this one dealing.
    placed = materialise(dealt.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place")), "ranges")
    # One row per range.
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")).select("_range", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = placed.join(materialise(starts, "range-starts"), "_range")
    return ranked.select(key_struct(keys).alias("_id"), (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias(name))


def global_dense_rank(df: DataFrame, keys: list[str], name: str, hot_rows: int | None = None) -> DataFrame:
    """Dense rank over all rows by ``keys``."""
    return df.withColumn("_id", key_struct(keys)).join(dense_ranks(df, keys, name, hot_rows), "_id", "left").drop("_id")


def key_struct(keys: list[str]) -> Column:
    return F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])
