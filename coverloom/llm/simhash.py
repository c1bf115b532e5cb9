"""SimHash near-duplicates by anchor-point covering.

A fingerprint is cut into two 32-bit halves. Two fingerprints that differ in at most three bits differ in at most one bit
in one of the halves. The anchors of a half are the words of a covering code of radius 1: the perfect Hamming code of
length 31 times one free bit. Each fingerprint is at home at the anchor nearest to a half (distance 0 or 1) and is
copied to every anchor within radius + 1 = 2: 17 per half. Of a pair within one bit, either is in the list of the
other's home, so comparing the residents of an anchor with its visitors loses no link. Links are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import boxed, group_bounds, in_cells, join_labels, whole_groups
from coverloom.llm.components import components
from coverloom.session import materialise

_CELL = ["key", "_i", "_j"]


def fingerprint(text: str | None, words: int = 3, seed: int = 42, block: int = 1 << 15) -> int:
    """SimHash of the word shingles of a whole text; bits set in over half of the hashes. No words: 0."""
    w = (text or "").encode().lower().split()  # bytes: white space and case are ASCII only
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    if len(w) < words:
        return h(b" ".join(w), seed)
    counts, n = np.zeros(64, np.int64), len(w) - words + 1
    for at in range(0, n, block):
        part = w[at:at + block + words - 1]
        hashes = np.array([h(b" ".join(s), seed) for s in zip(*[part[k:] for k in range(words)])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document, ``fp`` the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _flips() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the bits to flip to reach each anchor within distance 2, home first, and which entries are in use."""
    masks, used = np.zeros((32, 17), np.uint64), np.zeros((32, 17), bool)
    free, bit = 1 << 31, lambda p: 1 << (p - 1)
    for s in range(32):
        home = bit(s) if s else 0
        far = [bit(p) | bit(p ^ s) for p in range(1, 32) if p < p ^ s] if s else []
        reached = [home, home | free, *far]
        masks[s, :len(reached)], used[s, :len(reached)] = reached, True
    return masks, used


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, anchor keys and home flags of all copies of the fingerprints (unsigned)."""
    masks, used = _flips()
    rows, keys, homes = [], [], []
    for half in range(2):
        b = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        s = np.zeros(len(fp), np.int64)
        for k in range(5):
            parity = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
            s |= (np.bitwise_count(b & np.uint64(parity)).astype(np.int64) & 1) << k
        at, slot = np.nonzero(used[s])
        rows.append(at)
        keys.append((b[at] ^ masks[s[at], slot]).astype(np.int64) | (half << 32))
        homes.append(slot == 0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _compare(bits: int, block: int = 512):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, _CELL):
            fp, home, rep = pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy(), pdf["rep"].to_numpy()
            label, bounds, links = np.arange(len(pdf)), group_bounds(pdf, _CELL), []
            sizes = np.diff(bounds)
            for size in np.unique(sizes[(sizes > 1) & (sizes <= 64)]):  # all small groups of one size at once
                at = bounds[:-1][sizes == size][:, None] + np.arange(size)
                for d in range(1, size):
                    i, j = at[:, :-d].ravel(), at[:, d:].ravel()
                    some = home[i] | home[j]
                    i, j = i[some], j[some]
                    near = np.bitwise_count(fp[i] ^ fp[j]) <= bits
                    links.append((i[near], j[near]))
            if links:
                join_labels(label, *map(np.concatenate, zip(*links)))
            for g in np.flatnonzero(sizes > 64):
                lo, hi = bounds[g], bounds[g + 1]
                residents = lo + np.flatnonzero(home[lo:hi])
                for at in range(0, len(residents), block):
                    mine = residents[at:at + block]
                    i, j = np.nonzero(np.bitwise_count(fp[mine][:, None] ^ fp[lo:hi][None, :]) <= bits)
                    join_labels(label, mine[i], lo + j)
            linked = label != np.arange(len(pdf))
            yield pd.DataFrame({"a": rep[linked], "b": rep[label[linked]]})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 3,
                    cell_rows: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    Documents whose fingerprints differ in at most ``bits`` (at most 3) bits are linked; ``component_id`` is the smallest id reachable.
    Equal fingerprints are one class before anything is compared. A null or empty text has fingerprint 0 and is linked
    like any other. A row without id gets its fingerprint and the component of its class; it adds no link, and a class of such rows alone has none.
    Repeated rows are returned as often as given; other columns of ``docs`` are ignored.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the anchors cover at most 3 differing bits")
    docs = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = materialise(docs.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")

    def copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp, rep = pdf["fp"].to_numpy(), pdf["rep"].to_numpy()
            at, key, home = anchors(fp.view(np.uint64))
            yield pd.DataFrame({"key": key, "home": home, "fp": fp[at], "rep": rep[at]})

    kind, sample = "key long, home boolean, fp long, rep long", 16
    sampled = classes.filter(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0).mapInPandas(copies, kind)
    placed = in_cells(classes.mapInPandas(copies, kind), ["key"], "fp", cell_rows, sampled, sample)
    cells = placed.select(*_CELL, "home", "fp", "rep").repartition(*_CELL).sortWithinPartitions(*_CELL)
    found = components(cells.mapInPandas(_compare(bits), "a long, b long"))
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = materialise(named.select("fp", F.coalesce("component", "rep").alias("component_id")), "class-components")
    return docs.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without near-duplicates: of each group the one with the smallest id, once; all columns stay.

    Rows without id are kept, as nothing tells them apart. Of several rows that share the kept id, the first by all columns stays.
    """
    known = docs.filter(F.col(id_col).isNotNull())
    found = near_duplicates(known, id_col, **options)
    return first_rows(docs, found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct(), id_col)


def first_rows(docs: DataFrame, kept: DataFrame, id_col: str) -> DataFrame:
    """For each id of ``kept`` its first row by all columns; rows without id are kept."""
    kept = materialise(kept.select(F.col(id_col).alias("id")), "kept")
    known = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), boxed(docs))
    sortable = [F.col("row").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    first = F.row_number().over(Window.partitionBy("id").orderBy(*sortable))
    rows = known.join(kept, "id", "left_semi").withColumn("place", first).filter("place = 1")
    return rows.select("row.*").unionByName(docs.filter(F.col(id_col).isNull()))
