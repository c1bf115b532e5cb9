"""Source divergence audit by chunk factorization.

Documents are cut at white space into chunks, which are counted per document; each distinct chunk of the whole corpus is taken apart into
terms once, and the terms are joined back. Distinct documents and occurrences of a term then tell which terms a language keeps and
how far the sources of a language lie apart. All figures are whole numbers.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import ascii_lower
from coverloom.session import materialise, scratch_dir

#: ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000


#: A row whose group columns are given names a group of a block; its ``chunk`` is the block's number behind a space, which no chunk holds.
_ROWS = "block long, chunk string, documents binary, lang string, source string, first int"


def chunk_counts(docs: DataFrame, block_bytes: int = 48 << 20, block_docs: int = 60_000) -> DataFrame:
    """(block, chunk, documents, lang, source, first): the documents of a block that hold each chunk, once per occurrence, ascending.

    ``docs`` has lang, source and text without nulls. A block is a run of documents of one task with about ``block_bytes`` of text, or one longer document.
    Its documents have 16-bit numbers, by lang and source; further rows name the groups and their ``first`` numbers. So a chunk costs two bytes
    an occurrence, and no document is in two blocks: their distinct documents add up.
    """

    def rows_of(block: int, vocabulary: dict, held: list, rows_at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda d: d[:2])
        sizes = [len(ids) for *_, ids in held]
        ids, number = np.concatenate([ids for *_, ids in held]), np.repeat(np.arange(len(held), dtype="<u2"), sizes)
        chunks = sorted(vocabulary)  # neighbours look alike, which the shuffle's compression makes use of
        place = np.empty(len(chunks), np.int32)
        place[[vocabulary[c] for c in chunks]] = np.arange(len(chunks), dtype=np.int32)
        ids = place[ids]
        flat = number[np.argsort(ids, kind="stable")]
        ends = np.append(0, np.cumsum(np.bincount(ids, minlength=len(chunks)))) * 2
        buffer = pa.py_buffer(flat.tobytes())
        groups = [(lang, source, k) for k, (lang, source, _) in enumerate(held) if k == 0 or (lang, source) != held[k - 1][:2]]
        names, kinds = ["block", "chunk", "documents", "lang", "source", "first"], [pa.string(), pa.binary(), pa.string(), pa.string(), pa.int32()]
        columns = [pa.array([f" {block}"] * len(groups)), pa.nulls(len(groups), pa.binary()), *[pa.array(v, k) for v, k in zip(zip(*groups), kinds[2:])]]
        yield pa.RecordBatch.from_arrays([pa.array([block] * len(groups), pa.int64()), *columns], names=names)
        for at in range(0, len(chunks), rows_at_once):
            part, offsets = chunks[at:at + rows_at_once], ends[at:at + rows_at_once + 1].astype(np.int32)
            documents = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets.tobytes()), buffer])
            columns = [pa.array(part, pa.binary()).cast(pa.string()), documents, *[pa.nulls(len(part), k) for k in kinds[2:]]]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, held = TaskContext.get().partitionId() << 32, 0, []
        vocabulary: dict = defaultdict(lambda: len(vocabulary))
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                chunks = text.encode().split()  # bytes: white space is ASCII only
                held.append((lang, source, np.fromiter(map(vocabulary.__getitem__, chunks), np.int32, len(chunks))))
                size += len(text)
                if size >= block_bytes or len(held) >= block_docs:
                    yield from rows_of(block, vocabulary, held)
                    vocabulary.clear()
                    block, size, held = block + 1, 0, []
        if held:
            yield from rows_of(block, vocabulary, held)

    return docs.select("lang", "source", "text").mapInArrow(run, _ROWS)


def _per_group(rows: pa.Table, groups: list[tuple[str, str, int]]) -> pa.RecordBatch:
    """Documents and occurrences per group and term; ``rows`` are a block's, sorted by term, whole terms only."""
    terms = rows.column("term").combine_chunks().dictionary_encode()
    which = terms.indices.to_numpy()
    documents = rows.column("documents").combine_chunks()
    offsets = np.frombuffer(documents.buffers()[1], np.int32)[documents.offset:documents.offset + len(documents) + 1]
    flat = np.frombuffer(documents.buffers()[2], "<u2")[offsets[0] // 2:offsets[-1] // 2]
    found = np.sort(np.repeat(which.astype(np.int64), np.diff(offsets) // 2) << 16 | flat)  # a term's chunks are united
    cell = (found >> 16) * len(groups) + np.searchsorted([first for *_, first in groups], found & 0xFFFF, side="right") - 1
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    new = np.diff(found, prepend=-1) != 0
    group = pa.array(cell[starts] % len(groups))
    names = [pa.array([g[k] for g in groups], pa.string()).take(group) for k in (0, 1)]
    columns = [*names, terms.dictionary.take(pa.array(cell[starts] // len(groups))), pa.array(np.add.reduceat(new, starts, dtype=np.int64)), pa.array(np.diff(starts, append=len(cell)))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "docs", "times"])


def _count_terms(batches: Iterator[pa.RecordBatch], rows_at_once: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, its groups first, then by term: ``_per_group`` of each block, by whole terms."""
    groups: list = []
    of_block, held = None, None

    def counted(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal of_block
        block = rows.column("block").to_numpy()
        ends = [*np.flatnonzero(np.diff(block)) + 1, len(block)]
        for lo, hi in zip([0, *ends], ends):
            part = rows.slice(lo, hi - lo)
            if block[lo] != of_block:
                of_block = block[lo]
                groups.clear()
            named = pc.is_null(part.column("term"))
            groups.extend(zip(*(part.filter(named).column(c).to_pylist() for c in ("lang", "source", "first"))))
            part = part.filter(pc.invert(named))
            if len(part):
                yield _per_group(part, groups)

    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if len(held) >= rows_at_once:
            last, term = held.column("block")[-1].as_py(), held.column("term")[-1].as_py()
            same = pc.and_(pc.equal(held.column("block"), last), pc.fill_null(pc.equal(held.column("term"), term or ""), term is None))
            whole = pc.index(same, True).as_py()
            yield from counted(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and len(held):
        yield from counted(held)


def _clustered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows as a bucketed table in the shared folder: exchanged by ``keys`` once, then grouped and joined by them where they lie."""
    spark, name = rows.sparkSession, f"chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(buckets, *keys).write.option("compression", "zstd").option("path", f"{scratch_dir(spark)}/coverloom-stages/{name}")
    dealt.bucketBy(buckets, *keys).saveAsTable(name)
    return spark.table(name)


def frequent_terms(counted: DataFrame, least: int) -> DataFrame:
    """(chunk, term), once per place in the chunk: each distinct chunk taken apart once. Terms with fewer than ``least`` occurrences in all are left out."""
    chunks = counted.groupBy("chunk").agg(F.sum(F.octet_length("documents") / 2).cast("long").alias("times"))
    terms = chunks.select("chunk", "times", F.explode(F.regexp_extract_all(ascii_lower(F.col("chunk")), F.lit(TERM), F.lit(0))).alias("term"))
    terms = materialise(terms, "chunk-terms")
    enough = terms.groupBy("term").agg(F.sum("times").alias("times")).filter(F.col("times") >= least).select("term")
    return terms.select("chunk", "term").join(enough, "term")


def term_counts(docs: DataFrame, least: int = 1, slots: int = 16, blocks_at_once: int = 16, blocks_together: int = 1024, **options) -> DataFrame:
    """(lang, source, term, docs, times): documents that hold the term and its occurrences, per group; for terms of at least ``least`` occurrences in all.

    A chunk may hold a term more than once, and a document may hold it in several chunks: occurrences add up, documents
    are united within their block. A chunk has one row per block; ``blocks_together`` blocks at most meet in one task for it, the others in tasks of
    their own, with a copy of the terms. The terms of a block are dealt to ``slots`` cells, and about ``blocks_at_once`` blocks share
    them, so a cell holds that many blocks' part of the terms and no more.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block_bytes = options.get("block_bytes", 48 << 20)
    docs = docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // block_bytes)))  # tasks that read less than a block leave more rows
    salts = 1 + size // (block_bytes * blocks_together)
    salt = F.pmod(F.xxhash64("block"), F.lit(salts))
    keys = ["chunk"] if salts == 1 else ["chunk", "salt"]
    stored = _clustered(chunk_counts(docs, **options).withColumn("salt", salt), keys)
    counted, groups = stored.filter(F.col("lang").isNull()), stored.filter(F.col("lang").isNotNull())
    terms = frequent_terms(counted, least)
    if salts > 1:
        terms = terms.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    joined = counted.join(terms, keys).withColumn("slot", F.pmod(F.xxhash64("term"), F.lit(slots)).cast("int"))
    named = groups.withColumns({"term": F.lit(None).cast("string"), "slot": F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))})
    columns = ["block", "slot", "term", "documents", "lang", "source", "first"]
    cells = max(1, -(-groups.select("block").distinct().count() // blocks_at_once))
    rows = joined.select(*columns).unionByName(named.select(*columns)).withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)))
    rows = rows.repartition("cell", "slot").sortWithinPartitions("slot", "block", F.col("term").asc_nulls_first(), "first")
    per_block = rows.select("block", "term", "documents", "lang", "source", "first").mapInArrow(
        _count_terms, "lang string, source string, term string, docs long, times long")
    return per_block.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """Smoothed share of a term in ``SCALE`` parts, at least 1."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide(count + 2) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + 2 * kept))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); the same either way round."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, q, value, rank): how far each source of a language lies from the others, and by which terms.

    Null text, lang and source are read as ''. A language keeps the terms of at least ``least_docs`` of its documents; every row is a
    document, repeated ones too. Part ``pair`` has a row for each other source of the language, even if nothing is kept (value 0); part
    ``term`` the ``top`` terms that weigh more here than in the language. Ties go by item in byte order. An empty table
    gives no rows; other columns are ignored.

    Most sources lack most terms, and all terms that a source lacks have one and the same share. So a pair's value is taken as if no term were in both
    (counts of terms per share, against the other's share of an absent term), and corrected for the terms that are: only these are joined.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counts = materialise(term_counts(docs, least_docs), "terms")  # fewer occurrences than that can't be in so many documents
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("times").alias("lang_count")).filter(F.col("docs") >= least_docs)
    kept = materialise(kept.drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_count").alias("lang_total"))
    here = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", F.col("times").alias("count"), "lang_count")
    here = materialise(here, "kept-counts")
    totals = here.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("present"))
    none = {"total": 0, "present": 0, "kept": 0, "lang_total": 0}
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(none)
    # a language without kept terms has no shares; 1 stands in and meets no term
    groups = groups.withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("kept", F.lit(1)))).otherwise(1))
    groups = materialise(groups, "groups")
    terms = here.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "p0", share(F.col("count"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_count"), F.col("lang_total"), F.col("kept")).alias("q"))
    terms = materialise(terms, "shares")
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "q", "value", "rank"]
    best = terms.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "q", gap(F.col("p"), F.col("q")).alias("value"))
    best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top).select(*columns)
    return best.unionByName(_pairs(terms, groups).withColumn("rank", F.row_number().over(ranked)).select(*columns))


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, q, value) of all other sources of each language.

    ``q`` is null here: a pair has one share per term.
    """
    # groups of a language meet each other, as the result has a row for each such pair
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"), F.col("present").alias("other_present"))
    ends = [F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b")]
    alike = terms.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    alone = alike.join(other, "lang").filter(F.col("source") != F.col("other"))
    alone = alone.select("lang", *ends, (F.col("n") * gap(F.col("p"), F.col("other_p0"))).alias("value"))
    absent = groups.join(other, "lang").filter(F.col("source") < F.col("other"))
    lacking = F.col("kept") - F.col("present") - F.col("other_present")
    absent = absent.select("lang", *ends, (lacking * gap(F.col("p0"), F.col("other_p0"))).alias("value"))
    x, y = terms.select("lang", "term", "source", "p", "p0"), terms.select("lang", "term", *[F.col(c).alias(f"other{s}") for c, s in (("source", ""), ("p", "_p"), ("p0", "_p0"))])
    both = x.join(y, ["lang", "term"]).filter(F.col("source") < F.col("other"))
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "other_p", "other_p0"))
    both = both.select("lang", *ends, (gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)).alias("value"))
    each = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    values = alone.unionByName(absent).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).withColumn("each", each)
    return values.select("lang", "each.source", F.lit("pair").alias("part"), "each.item", F.lit(None).cast("long").alias("q"), "value")
