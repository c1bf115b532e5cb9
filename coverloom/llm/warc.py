"""WARC archives over a chunked record table.

A page becomes rows of (record id, chunk number, bytes), each with the SHA-1 of the payload up to its end; the digest is carried
from chunk to chunk, so no digest needs a payload twice. A chunk is written as one WARC record: a payload of several chunks is
segmented as the format provides, a first record and ``continuation`` records. Spark's text writer puts the record's closing
``CRLF CRLF`` as line separator, and its binary reader hands whole archives back, so any store that Spark reaches works.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.session import materialise, scratch_dir

CRLF = b"\r\n"
CHUNK = 256 * 1024
PER_ARCHIVE = 2000  # records, so an archive unpacks to 512 MB at most, usually to some 10 MB


def responses(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(digest, bytes, first_id) for each payload of at least ``least`` bytes that several rows of (page_id, digest, bytes) share.

    ``first_id`` is the largest page_id. Rows are combined before the shuffle, so a payload with many copies costs one row per task.
    """
    shared = pages.filter(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return shared.filter("n > 1").drop("n")


def chunks(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """(record_id, chunk, chunks, total, offset, data, running): the chunks of (record_id, payload binary, with_payload).

    ``running`` is the hex SHA-1 of the payload up to the chunk's end. An empty payload, or one left out (a revisit), is one empty chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "chunk", "chunks", "total", "offset", "data", "running"]
        for batch in batches:
            held, rows = 0, []
            for record, payload, with_payload in zip(*[batch.column(c) for c in ("record_id", "payload", "with_payload")]):
                view, sha = memoryview(payload.as_buffer() or b""), hashlib.sha1()
                total = len(view)
                starts = range(0, max(total, 1), size) if with_payload.as_py() else [0]
                for k, at in enumerate(starts):
                    data = view[at:at + size] if with_payload.as_py() else b""
                    sha.update(data)
                    rows.append((record.as_py(), k, len(starts), total, at, bytes(data), sha.hexdigest()))
                    held += len(data)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), names=names)
                        held, rows = 0, []
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CHUNK_TYPES)], names=names)

    return records.select("record_id", "payload", "with_payload").mapInArrow(
        run, "record_id string, chunk long, chunks long, total long, offset long, data binary, running string")


_CHUNK_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]


def _header(*fields: tuple[str, object]):
    """Header text of a record; a field whose value is null is left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"))


def write(pages: DataFrame, path: str, least: int = 1000, size: int = CHUNK, date: str = "2026-01-01T00:00:00Z",
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one WARC record per row to gzipped archives under ``path``; oversized payloads as segments of ``size`` bytes.

    Of copies of a payload of at least ``least`` bytes those with the largest id are responses, the others revisit it; if no copy has an
    id, all are responses. A null payload is empty. Repeated rows get a record each, with ids from their place in the input.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    shared = materialise(responses(rows.select("page_id", "digest", "bytes"), least), "warc-responses")
    shared = shared.select(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"), "first_id", F.lit(True).alias("shared"))
    wide = rows.withColumn("number", F.md5(F.concat_ws(":", F.lit(path), F.monotonically_increasing_id(), "digest")))
    wide = wide.join(shared, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    revisit = F.coalesce("shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    parts = [F.substring("number", a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    wide = wide.withColumns({"type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first_id")),
                             "record_id": F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))})
    heads = ["page_id", "url", "bytes", "digest", "type", "refers_to"]
    # the chunk rows carry the record's head along, so they need no second exchange
    records = wide.withColumn("with_payload", F.col("type") == "response")
    blocks = _with_heads(records, heads, size)
    first = F.col("chunk") == 0
    segmented = F.col("chunks") > 1
    text = lambda c: F.col(c).cast("string")
    safe = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    header = _header(
        ("WARC-Type", F.when(first, F.col("type")).otherwise("continuation")),
        ("WARC-Record-ID", F.when(first, F.col("record_id")).otherwise(F.regexp_replace("record_id", ">$", F.concat(F.lit("-"), text("chunk"), F.lit(">"))))),
        ("WARC-Segment-Origin-ID", F.when(~first, F.col("record_id"))),
        ("WARC-Segment-Number", F.when(segmented, (F.col("chunk") + 1).cast("string"))),
        ("WARC-Segment-Total-Length", F.when(segmented & (F.col("chunk") == F.col("chunks") - 1), text("total"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.when(first & (F.col("url") != ""), safe)),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), "digest"))),
        ("WARC-Profile", F.when(first & (F.col("type") == "revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("X-Page-ID", F.when(first, text("page_id"))),
        ("X-Refers-To-Page-ID", F.when(first, text("refers_to"))),
        ("X-Payload-Bytes", F.when(first, text("bytes"))),
        ("X-Running-Digest", F.when(F.col("type") == "response", F.concat(F.lit("sha1:"), "running"))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length("data").cast("string")))
    record = F.concat(header.cast("binary"), F.col("data")).cast("string")
    (blocks.select(record.alias("value")).write.mode("errorifexists").option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", PER_ARCHIVE).text(path))


def _with_heads(records: DataFrame, heads: list[str], size: int) -> DataFrame:
    """``chunks`` of the records, each row with the columns ``heads`` of its record."""
    names = ["record_id", "chunk", "chunks", "total", "offset", "data", "running"]
    packed = records.select(F.to_json(F.struct("record_id", *heads)).alias("record_id"), "payload", "with_payload")
    kinds = ", ".join(f"{c} {records.schema[c].dataType.simpleString()}" for c in ["record_id", *heads])
    head = F.from_json("record_id", kinds)
    return chunks(packed, size).withColumn("_head", head).select("_head.*", *names[1:])


def unpacked(content: memoryview, step: int = 1 << 18) -> Iterator[bytes]:
    """A gzip archive of any number of members in pieces of at most ``step`` bytes."""
    import zlib

    inflate = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        rest, full = content[at:at + step], False
        while rest or full:
            out = inflate.decompress(rest, step)
            rest, full = inflate.unconsumed_tail, len(out) == step
            if out:
                yield out
            if inflate.eof:
                rest, inflate, full = inflate.unused_data, zlib.decompressobj(31), False


def _records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Headers of each record and its block in pieces, which must be taken before the next record. Held: one piece and what is left of the one before."""
    buffer = bytearray()

    def more(why: str) -> None:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError(f"the archive ends inside {why}")
        buffer.extend(piece)

    def block(left: int) -> Iterator[bytes]:
        while left:
            if not buffer:
                more("a block")
            piece = bytes(buffer[:left])
            del buffer[:left]
            left -= len(piece)
            yield piece

    for piece in pieces:
        buffer.extend(piece)
        while buffer:
            while (end := buffer.find(CRLF * 2)) < 0:
                more("a header")
            lines = buffer[:end].decode().split("\r\n")
            del buffer[:end + 4]
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record: {lines[0][:40]!r}")
            head = dict(line.split(": ", 1) for line in lines[1:])
            yield head, block(int(head["Content-Length"]))
            while len(buffer) < 4:
                more("the end of a record")
            if buffer[:4] != CRLF * 2:
                raise ValueError(f"the record {head.get('WARC-Record-ID')} isn't closed")
            del buffer[:4]


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, segment, type, page_id, url, refers_to, declared_bytes, declared_digest, bytes, digest, data) of all records under ``path``.

    A record that isn't segmented has its block's SHA-1 as ``digest`` and no ``data``; the blocks of segments are returned, which
    are chunks. Archives are unpacked in steps: besides the packed file, a task holds a step and one segment.
    """
    names = ["record_id", "segment", "type", "page_id", "url", "refers_to", "declared_bytes", "declared_digest", "bytes", "digest", "data"]
    types = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, block in _records(unpacked(memoryview(content.as_buffer()))):
                    part, sha, size, kept = head.get("WARC-Segment-Number"), hashlib.sha1(), 0, []
                    for piece in block:
                        sha.update(piece)
                        size += len(piece)
                        if part:
                            kept.append(piece)
                    rows.append((head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]), int(part or 0), head["WARC-Type"], head.get("X-Page-ID"),
                                 head.get("WARC-Target-URI"), head.get("X-Refers-To-Page-ID"), int(head.get("X-Payload-Bytes", 0)),
                                 head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, size,
                                 None if part else sha.hexdigest(), b"".join(kept) if part else None))
                    if len(rows) == 1000 or part:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    kind = ("record_id string, segment long, type string, page_id string, url string, refers_to string, declared_bytes long, declared_digest string, "
            "bytes long, digest string, data binary")
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(run, kind)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record from its segments in order; only the running digest is held, never the payload."""
    record, sha, total, expected = None, None, 0, 1

    def done():
        return pa.RecordBatch.from_arrays([pa.array([record]), pa.array([total]), pa.array([sha.hexdigest()])], names=["record_id", "bytes", "digest"])

    for batch in batches:
        for rid, segment, data in zip(*[batch.column(c) for c in ("record_id", "segment", "data")]):
            if rid.as_py() != record:
                if record is not None:
                    yield done()
                record, sha, total, expected = rid.as_py(), hashlib.sha1(), 0, 1
            if segment.as_py() != expected:
                raise ValueError(f"segment {expected} of {record} is missing")
            sha.update(data.as_buffer())
            total, expected = total + len(data.as_buffer()), expected + 1
    if record is not None:
        yield done()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id text, url, payload_bytes, payload_digest, record_type, refers_to text): one row per record, digests checked.

    Digest and size of a response are computed from the bytes read; a wrong digest raises. A revisit has those its header
    declares, as its payload is in another record.
    """
    parts = materialise(read_segments(spark, path), "warc-segments")
    one = parts.filter(F.col("segment") == 0)
    many = parts.filter(F.col("segment") > 0)
    whole = many.select("record_id", "segment", "data").repartition("record_id").sortWithinPartitions("record_id", "segment")
    whole = whole.mapInArrow(_stitch, "record_id string, bytes long, digest string")
    heads = many.filter(F.col("segment") == 1).drop("bytes", "digest")
    stitched = heads.join(whole, "record_id", "left")
    cols = ["type", "page_id", "url", "refers_to", "declared_bytes", "declared_digest", "bytes", "digest"]
    out = one.select(*cols).unionByName(stitched.select(*cols))
    revisit = F.col("type") == "revisit"
    right = revisit | (F.col("digest").eqNullSafe(F.col("declared_digest")) & (F.col("bytes") == F.col("declared_bytes")))
    checked = F.when(right, F.col("declared_digest")).otherwise(F.raise_error(F.concat(F.lit("wrong digest, page "), F.coalesce("page_id", F.lit("null")))))
    return out.select("page_id", "url", F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
                      checked.alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


def round_trip(pages: DataFrame, least: int = 1000, size: int = CHUNK, id_col: str = "page_id", **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back; ids have their own type again."""
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, least, size, id_col=id_col, **options)
    kind = pages.schema[id_col].dataType
    back = read(spark, path)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
