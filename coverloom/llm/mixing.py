"""Mixing sources to target weights with DataFrame functions only.

Documents get hash-random keys (MD5 of id and size), are put in ranges of the key within their source, and distributed prefix
sums of their sizes tell where a source's budget ends. A budget above the source's size repeats whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import WORD, boxed, prefix_sums
from coverloom.session import materialise


def words(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[float], most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; a null source is one of its own, last by code point.

    The sources, by code point, weigh ``weights`` in turn and share all sizes. None gets over ``most`` times its size; what is
    over goes to the others by weight. With the sources ordered by limit/weight, those up to some place are at their
    limit and the others share the rest, so one running sum gives the level. There is one row per source here.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    limit = F.col("source_size") * most
    per = per.withColumn("weight", weight).withColumn("ratio", limit / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier, later = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    per = per.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(earlier), F.lit(0))) / F.sum("weight").over(later))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole)
    target = F.least(limit.cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def key(doc_id: Column, size: Column) -> Column:
    """Random by hash: the order in which a source's rows are taken."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), size))


def budget() -> Column:
    return F.floor(F.col("target") + 0.5).cast("long")


def epochs() -> Column:
    """How often a source is taken whole."""
    return F.when(F.col("source_size") > 0, F.floor(budget() / F.col("source_size"))).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: list[float], most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): ``taken`` words of each row, repeats counted.

    In key order each source's rows are taken until its target, rounded, is spent exactly; the row at the cut is taken in part. A
    null text has size 0, a null source is a source, a null id has a key like any other; repeated rows count each. An
    empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    rows = materialise(rows.withColumn("key", key(F.col("doc_id"), F.col("size"))), "sizes")
    per = materialise(targets(rows, weights, most), "targets")
    placed = prefix_sums(rows, ["source"], "size", "before")
    goals = per.select(F.col("source").alias("_s"), "source_size", "target")
    rest = budget() - epochs() * F.col("source_size") - F.col("before")
    taken = epochs() * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    # the rows of ``per`` are the sources: Spark broadcasts them if their measured size allows
    joined = placed.join(goals, F.col("source").eqNullSafe(F.col("_s")), "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: list[float], most: int = 3, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; the one at a source's cut counts if at least half of it is.

    Columns are those of ``docs``. Documents without words weigh nothing and stay once. In key order a source's rows repeat whole epochs,
    and once more up to its cut, so a row needs no more than its own key and its source's cut: no text moves. Rows that share an id,
    source and size have one key; if the cut falls among them, the first by a hash of all columns are taken once more.
    """
    source, text = options.get("source_col", "source"), options.get("text_col", "text")
    plan = mix(docs, weights, most, id_col, **options).filter(F.col("size") > 0)
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("long")
    plan = plan.select("source", key(F.col("doc_id"), F.col("size")).alias("key"), times.alias("times"), epochs().alias("epochs"))
    plan = materialise(plan.withColumn("more", F.col("times") - F.col("epochs")), "mix-plan")
    cuts = plan.groupBy("source").agg(F.first("epochs").alias("epochs"), F.max(F.when(F.col("more") > 0, F.col("key"))).alias("cut"))
    cuts = materialise(cuts, "mix-cuts").select(F.col("source").alias("at"), "epochs", "cut")
    ends = plan.join(cuts.drop("epochs"), F.col("source").eqNullSafe(F.col("at")) & (F.col("key") == F.col("cut")))
    ends = ends.groupBy("at", "epochs", "cut").agg(F.sum("more").alias("more"), F.count(F.lit(1)).alias("rows"))
    others = cuts.filter(F.col("cut").isNull()).select("at", "epochs", "cut", F.lit(0).cast("long").alias("more"), F.lit(0).cast("long").alias("rows"))
    ends = materialise(ends.unionByName(others), "mix-ends")  # one row per source

    sized = docs.select(boxed(docs), F.col(source).alias("source"), F.col(id_col).alias("id"), words(F.col(text)).alias("size"))
    keyed = sized.select("row", "source", "size", key(F.col("id"), F.col("size")).alias("key"))
    keyed = keyed.join(ends, F.col("source").eqNullSafe(F.col("at")), "left")
    tied = (F.col("size") > 0) & F.coalesce(F.col("key") == F.col("cut"), F.lit(False)) & (F.col("more") < F.col("rows"))
    once_more = F.coalesce((F.col("key") <= F.col("cut")) & ~tied, F.lit(False)).cast("long")
    copies = F.when(F.col("size") > 0, F.col("epochs") + once_more).otherwise(1)
    again = keyed.select("row", copies.alias("copies")).filter("copies > 0")
    out = again.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")
    if ends.filter(F.col("more") < F.col("rows")).isEmpty():
        return out
    return out.unionByName(_tied(keyed.filter(tied)).select("row.*"))


def _tied(rows: DataFrame, slice_rows: int = 1000) -> DataFrame:
    """The first ``more`` of each source's rows, by a hash of all columns; equal rows are counted, sent once and multiplied in slices."""
    mark = F.md5(F.to_json("row"))
    marks = materialise(rows.groupBy("source", mark.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.first("more").alias("more")), "tied")
    taken = F.least(F.col("n"), F.col("more") - F.col("before"))
    chosen = prefix_sums(marks, ["source"], "n", "before").select(F.col("source").alias("from"), F.col("key").alias("mark"), taken.alias("taken")).filter("taken > 0")
    texts = rows.groupBy("source", mark.alias("mark")).agg(F.first("row").alias("row"))
    found = texts.join(chosen.withColumnRenamed("mark", "chosen"), F.col("source").eqNullSafe(F.col("from")) & (F.col("mark") == F.col("chosen")))
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1, F.lit(slice_rows).cast("long")))
    slices = found.select("row", "taken", start.alias("start")).repartition("start", F.md5(F.to_json("row")))
    upto = F.least(F.col("start") + slice_rows, F.col("taken")) - 1
    return slices.select("row", F.explode(F.sequence(F.col("start"), upto)).alias("copy"))
