"""Connected components of a link table, fully distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.session import materialise


def _is_forest_of_stars(links: DataFrame) -> bool:
    """Every larger end has one link, and no centre is a larger end itself."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node with a link; the component is its smallest node.

    ``links`` has two long columns ``a``, ``b`` without nulls; self-links and repeats are ignored. Alternating large-star and
    small-star steps (Kiveris et al., 2014) end after a logarithmic number of rounds. Minima are combined before the
    shuffle and stored, so the join with a centre that has a third of all links reads two plain exchanges, which
    adaptive execution can split. Each step is a table in the shared folder.
    """
    a, b = F.col("a"), F.col("b")
    links = materialise(links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    while not _is_forest_of_stars(links):
        both = links.unionByName(links.select(b.alias("a"), a.alias("b")))
        low = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large-star-minima")
        large = both.filter(b > a).join(low, "a").select(b.alias("a"), F.col("m").alias("b")).distinct()
        links = materialise(large, "large-star")
        low = materialise(links.groupBy("a").agg(F.min("b").alias("m")), "small-star-minima")
        small = links.join(low, "a").select(b.alias("a"), F.col("m").alias("b")).filter(a != b)
        links = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    centres = links.select(b.alias("node"), b.alias("component")).distinct()
    return links.select(a.alias("node"), b.alias("component")).unionByName(centres)
