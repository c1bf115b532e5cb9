"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Every match of the pattern is encoded by itself, so a text may be cut wherever a match must end and the next one begin. Long texts
are cut at such places and encoded piece by piece: no regular expression runs over more than a piece, and no list of ids
is longer than a piece's. Ids decode to raw bytes, as a token may end inside a character.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space of Unicode, as the pattern's engine reads it (fixed values).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where a match ends for certain: no match holds white space behind another character, and none of those that hold a letter or
#: digit listed here goes on with punctuation.
CUT = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=[0-9A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff])(?=[!-/:-@\[-`{{-~\u3001\u3002\uff0c\uff01\uff1f])")
#: White space that the library's engine is not asked to match; it runs out of stack within a million characters.
LONG_SPACE = re.compile(rf"[{SPACE}]{{4096,}}")


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str):
    """The library's encoding of a rank file; once per Python worker."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int) -> Iterator[tuple[str, bool]]:
    """The text in pieces cut at safe places, and whether a piece is one match by itself.

    Of a run of white space before another character, all but the last one are a match; at the end of a text, all are.
    """
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + size) if len(text) - at > size else None
        end = cut.end() if cut else len(text)
        for run in LONG_SPACE.finditer(text, at, end):
            match_end = run.end() - (run.end() < len(text))
            if run.start() > at:
                yield text[at:run.start()], False
            yield text[run.start():match_end], True
            at = match_end
        if at < end:
            yield text[at:end], False
        at = end


def token_ids(text: str, ranks: str, pattern: str, size: int = 1 << 16) -> bytes:
    """Ids of a whole text as little-endian 32-bit integers."""
    library = encoding(ranks, pattern)
    out = []
    for piece, single in pieces(text, size):
        ids = library._encode_single_piece(piece) if single else library.encode_ordinary(piece)
        out.append(np.array(ids, "<u4").tobytes())
    return b"".join(out)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1 << 16) -> DataFrame:
    """(doc_id, n_tokens, ids): one row per document, ``ids`` as little-endian unsigned 32-bit integers.

    ``ranks`` is a local rank file that every executor has. ``CUT`` fits patterns whose matches hold white space at their start or are
    white space only. A null text is read as empty and has no ids; strings of special tokens are ordinary text; repeated rows and null ids
    are rows like any other; other columns are ignored. Memory: one text, its ids, and the lists of a piece of about ``size`` characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [token_ids(t.as_py() or "", ranks, pattern, size) for t in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(rows: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids", size: int = 1 << 16) -> DataFrame:
    """(doc_id, ids, bytes): the raw bytes that the ids stand for. Null ids are none, their bytes empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoding(ranks, pattern)
        for batch in batches:
            out = []
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_py() or b"", "<u4")
                out.append(b"".join(library.decode_bytes(ids[k:k + size].tolist()) for k in range(0, len(ids), size)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"doc_id {kind}, ids binary, bytes binary")


def digests(docs: DataFrame, ranks: str, pattern: str, **columns: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids alone."""
    back = decode(encode(docs, ranks, pattern, **columns), ranks, pattern)
    count = F.floor(F.octet_length("ids") / 4).cast("long")
    return back.select("doc_id", count.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
