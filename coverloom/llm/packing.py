"""Best-fit packing of tokenised documents by minimum bin slack.

Bins are filled one after another: the longest piece left, then the fullest combination of available lengths that still
fits, found by a bitset subset-sum over the lengths. Only the number of pieces per length matters, so the plan comes
from a table of at most ``capacity`` counts, whatever the number of documents; a combination is used as often as the
counts allow. Pieces then find their place by their rank within their length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import prefix_sums
from coverloom.session import materialise

_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Texts of these characters only are split here exactly as the tokenizer's own pattern splits them; others go to it whole.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LATIN[6:]}]*")
_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+")


class Encoder:
    """Ids of a byte-level BPE file as little-endian 32-bit integers, as the tokenizer's plain call gives them. The ids of frequent words are remembered, 2^20 at most.

    Texts that hold the string of a special token go to the tokenizer whole.
    """

    def __init__(self, path: str, most: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.known = Tokenizer.from_file(path), most, {}
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        split = {i: _SPLIT.findall(t) for i, t in enumerate(texts) if _PLAIN.fullmatch(t) and not self.special.search(t)}
        if len(self.known) > self.most:
            self.known.clear()
        new = list(set().union(*split.values()).difference(self.known)) if split else []
        self.known.update(zip(new, self._ids(new)))
        for i, words in split.items():
            out[i] = b"".join(map(self.known.__getitem__, words))
        other = [i for i in range(len(texts)) if out[i] is None]
        for i, ids in zip(other, self._ids([texts[i] for i in other])):
            out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and ``end_id``, cut only if longer than ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, texts = [], [t or "" for t in batch.column("text").to_pylist()]
            for i, ids in enumerate(encode(texts)):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                rows += [(i, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            at, *values = np.array(rows, np.int64).reshape(-1, 5).T
            ids = batch.column("doc_id").take(pa.array(at))
            yield pa.RecordBatch.from_arrays([ids, pa.array(values[0], pa.int32()), *map(pa.array, values[1:])],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths with their numbers whose sum is the largest that fits in ``room``, long ones first."""
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:  # copies of one length in powers of two
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & full
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, last rank + 1, first sequence, pieces per sequence, offset): minimum bin slack by counts.

    Each round uses up, but for fewer than one combination needs, some length; so there are few rounds at any size.
    """
    left, ranks, runs, sequence = dict(counts), dict.fromkeys(counts, 0), [], 0
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        used = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times, offset = min(left[k] // n for k, n in used.items()), 0
        for length in sorted(used, reverse=True):
            n = used[length]
            runs.append((length, ranks[length], ranks[length] + n * times, sequence, n, offset))
            ranks[length] += n * times
            offset += n * length
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return runs


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to (doc_id, piece, start, length, ids_crc32) rows with lengths from 1 to ``capacity``."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "piece", "ids_crc32"))
    cut = materialise(cut.withColumns({"key": key, "one": F.lit(1).cast("long")}), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    runs = plan(counts, capacity)
    by_length: dict[int, np.ndarray] = {}
    for run in sorted(runs):
        by_length.setdefault(run[0], []).append(run)
    by_length = {k: np.array(v, np.int64) for k, v in by_length.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank, length = pdf["rank"].to_numpy(), pdf["length"].to_numpy()
            sequence, offset = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    own = by_length[int(length[rows[0]])]
                    r = own[np.searchsorted(own[:, 1], rank[rows], side="right") - 1]
                    within = rank[rows] - r[:, 1]
                    sequence[rows] = r[:, 3] + within // r[:, 4]
                    offset[rows] = r[:, 5] + within % r[:, 4] * r[:, 0]
            yield pdf.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    ranked = prefix_sums(cut, ["length"], "one", "rank")
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInPandas(place, f"{kind}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, **options) -> DataFrame:
    """One row per piece, with its sequence and its gapless place there.

    A null or empty text is the end id alone; a null id stays null; repeated rows are packed each; an empty table gives no
    rows. Other columns are ignored. Very long texts become many pieces; all but the first are full.
    """
    return pack(pieces(docs, tokenizer, capacity, **options), capacity)
