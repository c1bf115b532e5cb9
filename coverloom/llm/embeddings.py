"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A vector is rotated by three rounds of random signs and a Walsh-Hadamard transform; its hash is the nearest vertex of the
cross-polytope, that is the coordinate of largest size and its sign. Each table joins several hashes. A vector is at home
in the bucket of its hashes and also visits, for each hash, the bucket where that hash is replaced by its second
choice. All pairs of a bucket are verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import group_bounds, join_labels, whole_groups
from coverloom.llm.components import components
from coverloom.session import materialise

_CELL = ["label", "key", "_i", "_j"]


def usable(c: str):
    """Not null, without null or non-finite components, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(c, finite) & F.exists(c, lambda x: x != 0), F.lit(False))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, in place; their length is a power of two."""
    step, (n, d) = 1, x.shape
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        a, b = y[:, :, 0].copy(), y[:, :, 1].copy()
        y[:, :, 0], y[:, :, 1] = a + b, a - b
        step *= 2
    return x


def buckets(x: np.ndarray, tables: int, hashes: int, seed: int = 7) -> np.ndarray:
    """(rows, tables, 1 + hashes) bucket numbers, the home bucket first, then one per hash with its second choice."""
    n, width = x.shape
    d = 1 << max(1, (width - 1).bit_length())
    signs = np.random.default_rng([seed, d]).choice([-1.0, 1.0], size=(tables, hashes, 3, d))
    padded = np.zeros((n, d))
    padded[:, :width] = x
    out, at = np.empty((n, tables, 1 + hashes), np.int64), np.arange(n)
    for t in range(tables):
        first, second = np.empty((hashes, n), np.int64), np.empty((hashes, n), np.int64)
        for h in range(hashes):
            y = padded.copy()
            for s in signs[t, h]:
                y = hadamard(y * s) / np.sqrt(d)
            size = np.abs(y)
            for chosen in (first, second):
                best = size.argmax(axis=1)
                chosen[h] = 2 * best + (y[at, best] > 0)
                size[at, best] = -1
        for probe in range(1 + hashes):
            number = np.full(n, t, np.int64)
            for h in range(hashes):
                number = number * (2 * d) + (second if probe == h + 1 else first)[h]
            out[:, t, probe] = number
    return out


def hash_count(rows: int, width: int, tables: int, most: int = 6) -> int:
    """Hashes a table, so that ``rows`` vectors of one label and ``width`` seldom share a bucket by chance, however many they are.

    Two below 16 components: so few coordinates have too few rotations for tables of many hashes to differ.
    """
    sides, hashes = 2 << max(1, (width - 1).bit_length()), 2
    while sides >= 32 and hashes < most and 8 * rows * (1 + hashes) ** 2 > sides**hashes and tables * sides ** (hashes + 1) < 2**62:
        hashes += 1
    return hashes


def _links(g: pd.DataFrame, least: float, tables: int, block: int = 512, at_once: int = 1 << 20) -> pd.DataFrame:
    """(rep, links, root) of the cells in ``g``, vectors of one length; counts each pair in the first bucket where the two meet only."""
    v = np.stack(g["vector"].to_numpy()).astype(np.float64)
    norm, copies, own, key, rep = np.sqrt((v * v).sum(axis=1)), *(g[c].to_numpy() for c in ("copies", "_own", "key", "rep"))
    across = (g["_i"] != g["_j"]).to_numpy()
    label, links = np.arange(len(g)), np.zeros(len(g), np.int64)
    signature = np.stack(g["signature"].to_numpy()).reshape(len(g), tables, -1)

    def count(i: np.ndarray, j: np.ndarray) -> None:
        join_labels(label, i, j)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            shared = (signature[a][:, :, :, None] == signature[b][:, :, None, :]).any(axis=3)  # of the buckets where the two meet, the smallest counts
            first = np.where(shared, signature[a], np.iinfo(np.int64).max).min(axis=(1, 2)) == key[a]
            np.add.at(links, a[first], copies[b[first]])
            np.add.at(links, b[first], copies[a[first]])

    bounds = group_bounds(g, _CELL)
    starts, sizes = bounds[:-1], np.diff(bounds)
    i = starts[sizes == 2]  # by far the most cells, compared together
    i = i[np.einsum("nd,nd->n", v[i], v[i + 1]) / norm[i] / norm[i + 1] >= least]
    i = i[~across[i] | (own[i] != own[i + 1])]
    held, size = [(i, i + 1)], len(i)
    for lo, hi in zip(starts[sizes > 2], bounds[1:][sizes > 2]):
        for at in range(lo, hi, block):
            end = min(at + block, hi)
            i, j = np.nonzero((v[at:end] @ v[at:hi].T) / norm[at:end, None] / norm[None, at:hi] >= least)
            i, j = i + at, j + at
            keep = (i < j) & (~across[lo] | (own[i] != own[j]))
            held.append((i[keep], j[keep]))
            size += int(keep.sum())
            if size >= at_once:
                count(*map(np.concatenate, zip(*held)))
                held, size = [], 0
    if size:
        count(*map(np.concatenate, zip(*held)))
    some = links > 0
    return pd.DataFrame({"rep": rep[some], "links": links[some], "root": rep[label[some]]})


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98,
                    tables: int = 6, hashes: int | None = None, cell_rows: int = 2048) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row.

    Linked are vectors of equal label (not null) and length with cosine >= ``least``. Equal vectors are one class before
    anything is compared; ``n_links`` counts rows. Unusable vectors (see ``usable``), rows without label and rows without id
    link with nothing: 0 links, their own component, kept (null and not kept without id). Other columns are ignored.

    Hashes a table follow the largest label (``hash_count``) unless ``hashes`` is given. Bucket numbers travel first, with ids alone; vectors only
    to buckets that hold several. A bucket of more than ``cell_rows`` is cut by a hash of the id into chunks, and any two chunks meet in a cell of their own.
    """
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("vector"))
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector")
    rows = materialise(rows.withColumn("vhash", F.when(takes_part, F.xxhash64("vector"))), "vectors")
    live = rows.filter(F.col("vhash").isNotNull())
    classes = live.groupBy("label", "vhash", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes, "vector-classes")
    spread = classes.withColumn("label", F.concat_ws(":", F.size("vector"), "label"))  # vectors of one length only meet
    largest = spread.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    hashes_of = lambda width: hashes or hash_count(largest, width, tables)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for width, g in pdf.groupby(pdf["vector"].map(len)):
                flat = buckets(np.stack(g["vector"].to_numpy()), tables, hashes_of(width)).reshape(len(g), -1)
                yield pd.DataFrame({"label": g["label"].to_numpy(), "rep": g["rep"].to_numpy(), "signature": list(flat)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, _CELL, 5_000):
            for _, g in pdf.groupby(pdf["vector"].map(len)):
                yield _links(g.reset_index(drop=True), least, tables)

    signed = materialise(spread.select("label", "rep", "vector").mapInPandas(place, "label string, rep long, signature array<long>"), "vector-buckets")
    keys = signed.select("label", F.explode("signature").alias("key"), "rep")
    shared = keys.groupBy("label", "key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    crowded = materialise(keys.join(shared, ["label", "key"]), "crowded-buckets")
    chunks = F.ceil(F.col("size") / cell_rows).cast("int")
    placed = crowded.join(classes.select("rep", "copies", "vector"), "rep").join(signed.select("rep", "signature"), "rep")
    placed = placed.withColumn("_own", F.pmod(F.xxhash64(F.lit("chunk"), "rep"), chunks).cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    placed = placed.select("label", "key", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "rep", "copies", "vector", "signature")
    cells = placed.repartition(*_CELL).sortWithinPartitions(*_CELL)
    met = materialise(cells.mapInPandas(compare, "rep long, links long, root long"), "vector-links")
    found = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    counted = met.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.join(counted, "rep", "left").join(found, "rep", "left").select(
        "label", "vhash", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    named = materialise(named, "vector-components")
    out = live.join(named, ["label", "vhash", "vector"], "left").select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("vhash").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
