"""Vector codes by product codebooks: ball k-means in whole numbers, exact.

Vectors are cut into equal parts with a codebook each. The parts assigned to an entry are its ball; its radius holds its farthest
part. An entry whose ball is small against half its distance to another entry can lose no part to that one, so the radius
leaves a few neighbour entries. Ordered by distance, the halves of their distances cut the ball into rings: a part in the
core, nearer than half the way to the nearest neighbour, keeps its entry unseen, one in the k-th ring is compared with k neighbours only.
Every such test is made on squared whole numbers (``4 own >= between``), with equality inside, so ties are seen too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.session import materialise

_TOTALS = ["part", "entry", "pos", "n", "total", "radius"]


def whole_numbers(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, x): components as ``floor(scale * component)``; vectors that are null or hold null or non-finite components go."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    kept = rows.filter(F.coalesce(F.forall(vec_col, finite), F.lit(False)))
    x = F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return kept.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), x.alias("x"))


class Balls:
    """The codebook of one part: entries, and for each its neighbours in order of distance. ``radii`` (squared) may be unknown."""

    def __init__(self, entries: np.ndarray, radii: list[int] | None):
        self.entries, k = entries, len(entries)
        between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(between, axis=1, kind="stable")
        self.order = np.array([[j for j in row if j != i] for i, row in enumerate(order)], np.int64).reshape(k, k - 1)
        self.between = np.take_along_axis(between, self.order, axis=1)
        self.neighbours = [k - 1] * k if radii is None else [int((self.between[i] <= 4 * r).sum()) for i, r in enumerate(radii)]

    def assign(self, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, squared distance) of the nearest entry, ties to the lower index; ``code`` is the entry each part had."""
        code, best = code.copy(), ((x - self.entries[code]) ** 2).sum(axis=1)
        ring = np.zeros(len(x), np.int64)
        for i in np.unique(code):
            mine = code == i
            ring[mine] = np.searchsorted(self.between[i, :self.neighbours[i]], 4 * best[mine], side="right")
        rows = np.argsort(-ring, kind="stable")
        ring, home = ring[rows], code[rows]
        for j in range(int(ring[0]) if len(ring) else 0):
            left = int(np.searchsorted(-ring, -j, side="left"))  # rows whose ring is beyond j
            at, other = rows[:left], self.order[home[:left], j]
            d = ((x[at] - self.entries[other]) ** 2).sum(axis=1)
            nearer = (d < best[at]) | ((d == best[at]) & (other < code[at]))
            best[at[nearer]], code[at[nearer]] = d[nearer], other[nearer]
        return code, best


def _fitting(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if no sum of squares can overflow, else as Python integers."""
    top = max(int(np.abs(a.astype(object)).max()) if a.size and a.dtype == object else int(max(-int(a.min()), int(a.max()))) if a.size else 0 for a in (x, entries))
    return (x, entries) if 16 * top * top * max(1, x.shape[-1]) < 1 << 62 else (x.astype(object), entries.astype(object))


def _pass(codebooks: list[np.ndarray], radii: list[list[int]] | None, totals: bool, rows_at_once: int = 8192):
    """One pass over the vectors: new codes from the present ones; then, if asked for, the task's totals per entry and position."""
    parts, width = len(codebooks), codebooks[0].shape[1]

    def assign(table: pa.Table, sums: dict) -> pa.Table:
        flat = table.column("x").combine_chunks().flatten()
        x = flat.to_numpy(zero_copy_only=False).reshape(-1, parts, width)
        x, books = _fitting(x, np.stack(codebooks))
        code = np.zeros((len(x), parts), np.int64)
        if "code" in table.column_names:
            code[:] = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(-1, parts)
        error = np.zeros(len(x), books.dtype)
        for p in range(parts):
            balls = Balls(books[p], radii and radii[p])
            code[:, p], own = balls.assign(x[:, p], code[:, p])
            error = error + own
            for e in np.unique(code[:, p]) if totals else ():
                mine = code[:, p] == e
                n, total, radius = sums.get((p, e), (0, [0] * width, 0))
                add = x[mine, p].astype(object if x.dtype == object else np.int64).sum(axis=0).tolist()
                sums[p, e] = n + int(mine.sum()), [a + b for a, b in zip(total, add)], max(radius, int(own[mine].max()))
        out = table.select(["vec_id", "label", "x"])
        out = out.append_column("code", pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary()))
        return out.append_column("error", pa.array([int(v) if v < 1 << 63 else None for v in error], pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        sums: dict = {}
        held, n = [], 0
        kinds: pa.Schema | None = None
        whole = pa.decimal128(38, 0)
        extra = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), whole, whole]

        def padded(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for name, kind in zip(_TOTALS, extra):
                table = table.append_column(name, pa.nulls(len(table), kind))
            yield from table.to_batches(max_chunksize=rows_at_once)

        for batch in batches:
            kinds = batch.schema
            held.append(batch)
            n += len(batch)
            if n >= rows_at_once:
                yield from padded(assign(pa.Table.from_batches(held), sums))
                held, n = [], 0
        if n:
            yield from padded(assign(pa.Table.from_batches(held), sums))
        if sums:
            found = [(p, e, k, m, Decimal(t), Decimal(r)) for (p, e), (m, total, r) in sums.items() for k, t in enumerate(total)]
            columns = [pa.nulls(len(found), kinds.field(c).type) for c in ("vec_id", "label", "x")]
            columns += [pa.nulls(len(found), pa.binary()), pa.nulls(len(found), pa.int64())]
            columns += [pa.array(v, kind) for v, kind in zip(zip(*found), extra)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "code", "error", *_TOTALS])

    return run


def _moved(codebook: np.ndarray, found: dict, part: int) -> tuple[np.ndarray, list[int]]:
    """New entries, and squared radii of balls around them that hold all their parts: the old radius and the entry's way."""
    new, radii = codebook.astype(object), []
    for e in range(len(codebook)):
        if (part, e) not in found:
            radii.append(0)  # an empty ball
            continue
        n, total, radius = found[part, e]
        new[e] = [t // n for t in total]
        way = sum((int(a) - int(b)) ** 2 for a, b in zip(new[e], codebook[e]))
        radii.append((isqrt(radius) + isqrt(way) + 2) ** 2)
    small = all(-(1 << 62) < v < 1 << 62 for v in new.ravel())
    return new.astype(np.int64) if small else new, radii


def quantise(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id",
             vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks): a table (vec_id, label, x, code, error) and one array of entries per part.

    The codebooks start as the parts of the ``entries`` smallest ids, which tie by their components; nulls count as largest. In each
    of ``rounds`` passes every part goes to its nearest entry, then each entry becomes the floored mean of its parts; one more
    pass assigns them again. ``code`` holds a byte per part, ``error`` the squared distances of all parts (null if beyond 64 bits).

    Vectors that are null or hold null or non-finite components are dropped, and so are those that can't be cut like the others: empty ones,
    lengths that ``parts`` doesn't divide, and any length but that of the smallest id left. Fewer vectors than ``entries`` give
    as many entries; none gives an empty table and no codebooks. Repeated rows count each; other columns are ignored.

    A pass leaves codes and per-task totals in one table of the shared folder; the driver sees one row per entry and position,
    which depends on ``entries`` and the length only. Components beyond 2^63 after scaling are taken as 2^63.
    """
    if not 1 < entries <= 256:
        raise ValueError("a code is one byte")
    kept = whole_numbers(rows, id_col, vec_col, label_col, scale).filter((F.size("x") > 0) & (F.size("x") % parts == 0))
    first = kept.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(1).collect()
    length = len(first[0].x) if first else parts
    kept = kept.filter(F.size("x") == length)
    first = kept.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([r.x for r in first], np.int64).reshape(len(first), parts, length // parts)
    codebooks, radii = [start[:, p] for p in range(parts)], None
    kinds = f"vec_id {rows.schema[id_col].dataType.simpleString()}, label {rows.schema[label_col].dataType.simpleString()}, x array<bigint>, code binary, error long"
    schema = f"{kinds}, part int, entry int, pos int, n long, total decimal(38,0), radius decimal(38,0)"
    if not first:
        return rows.sparkSession.createDataFrame([], kinds), []
    for k in range(rounds + 1):
        done = materialise(kept.mapInArrow(_pass(codebooks, radii, k < rounds), schema), f"codes-{k}")
        kept = done.filter(F.col("part").isNull()).select("vec_id", "label", "x", "code")
        if k < rounds:
            found: dict = {}
            by = done.filter(F.col("part").isNotNull()).groupBy("part", "entry", "pos").agg(
                F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("radius").alias("radius"))
            for r in by.orderBy("part", "entry", "pos").collect():
                found.setdefault((r.part, r.entry), (r.n, [], int(r.radius)))[1].append(int(r.total))
            codebooks, radii = map(list, zip(*[_moved(c, found, p) for p, c in enumerate(codebooks)]))
    return done.select("vec_id", "label", "x", "code", "error"), codebooks


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for c in codebooks for v in c.ravel()).encode()).hexdigest()


def codes(rows: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): ``quantise`` with codes as hex text.

    ``label_error`` adds the errors of equal labels, null ones together, and is null if it or one of them is beyond 64 bits. The sums per label are joined back, so no label's rows meet in one task.
    """
    coded, codebooks = quantise(rows, **options)
    coded = coded.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error")
    total = F.when(F.bool_and(F.col("error").isNotNull()), F.sum(F.col("error").cast("decimal(38,0)")))
    per = coded.groupBy("label").agg(total.alias("total"))
    per = per.select(F.col("label").alias("_label"), F.expr("try_cast(total AS bigint)").alias("label_error"))
    joined = coded.join(per, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))
