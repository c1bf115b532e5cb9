"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard.

Vectors get one more coordinate, so that all have the length of the longest; nearest by Euclidean distance is then largest by inner
product. A fixed number of shards, more only where a task could not hold one, are graphs of their own: points enter in growing batches, a greedy search on the graph so far
proposes neighbours, pruning drops a candidate that is closer (by the factor ``alpha``) to a neighbour already chosen, and reverse
edges are pruned alike. A query runs a beam search in every shard; exact products on the original vectors rank what the beams return.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.embeddings import usable
from coverloom.session import materialise

_FAR = np.float32(np.inf)

#: Vector components that a shard and a block of queries have at most, on average: 131,072 and 65,536 vectors of 64.
SHARD_COMPONENTS, BLOCK_COMPONENTS = 1 << 23, 1 << 22


def distances(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Squared distances between (n, d) and (n, k, d)."""
    return np.maximum((q * q).sum(1)[:, None] + (v * v).sum(2) - 2 * np.einsum("nd,nkd->nk", q, v), 0)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Negated inner products between (n, d) and (n, k, d): the order of the distances, as all lifted vectors are equally long."""
    return -np.einsum("nd,nkd->nk", q, v)


def beam_search(v: np.ndarray, edges: np.ndarray, entry: np.ndarray, q: np.ndarray, width: int, step: int = 4, away=distances) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances by ``away`` (queries, width), nearest first, -1 where fewer were reached. ``edges`` has -1 for none."""
    n = len(q)
    ids = np.full((n, max(width, len(entry))), -1, np.int32)
    ids[:, :len(entry)] = entry
    dist = np.full(ids.shape, _FAR)
    dist[:, :len(entry)] = away(q, np.broadcast_to(v[entry], (n, len(entry), v.shape[1])))
    order = np.argsort(dist, axis=1, kind="stable")[:, :width]
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    done = ids < 0
    active = np.arange(n)
    while len(active):
        best = np.argsort(np.where(done[active], _FAR, dist[active]), axis=1, kind="stable")[:, :step]
        chosen = np.take_along_axis(ids[active], best, 1)
        fresh = ~np.take_along_axis(done[active], best, 1)
        np.put_along_axis(done_now := done[active], best, True, 1)
        near = np.where(fresh[:, :, None], edges[chosen], -1).reshape(len(active), -1)
        d = np.where(near >= 0, away(q[active], v[near]), _FAR)
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_dist = np.concatenate([dist[active], d], axis=1)
        all_done = np.concatenate([done_now, near < 0], axis=1)
        by_id = np.lexsort((~all_done, all_ids), axis=1)  # of repeats the one already expanded stays
        all_ids, all_dist, all_done = (np.take_along_axis(a, by_id, 1) for a in (all_ids, all_dist, all_done))
        all_dist[:, 1:][all_ids[:, 1:] == all_ids[:, :-1]] = _FAR
        keep = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
        ids[active], dist[active], done[active] = (np.take_along_axis(a, keep, 1) for a in (all_ids, all_dist, all_done))
        gone = ~np.isfinite(dist[active])
        ids[active], done[active] = np.where(gone, -1, ids[active]), done[active] | gone
        active = active[~done[active].all(axis=1)]
    return ids, dist


def prune(v: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point from (points, k) candidates, -1 for none."""
    ids = np.sort(candidates, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    ids = np.where(ids == points[:, None], -1, ids)
    c = v[ids]
    dist = np.where(ids >= 0, distances(v[points], c), _FAR)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist, c = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1), np.take_along_axis(c, order[:, :, None], 1)
    size = (c * c).sum(2)
    between = np.maximum(size[:, :, None] + size[:, None] - 2 * c @ c.transpose(0, 2, 1), 0)
    out, alive, rows = np.full((len(points), degree), -1, np.int32), ids >= 0, np.arange(len(points))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = ids[some, first[some]]
        alive &= ~(some[:, None] & (alpha * alpha * between[rows, first] <= dist))
        alive[rows, first] = False
    return out


def build(v: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Edges (n, degree) and entry points of the graph over the vectors (distinct rows)."""
    n = len(v)
    edges = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    centre = np.argmin(((v - v.mean(axis=0)) ** 2).sum(axis=1))
    order = np.concatenate([[centre], order[order != centre]]).astype(np.int32)
    entry, at = order[:1], 1
    while at < n:
        batch = order[at:at + max(1, min(at, 512))]
        found, _ = beam_search(v, edges, entry, v[batch], width)
        edges[batch] = prune(v, batch, found, degree, alpha)
        source, slot = np.nonzero(edges[batch] >= 0)
        ends, starts = edges[batch][source, slot], batch[source]
        by_end = np.argsort(ends, kind="stable")
        ends, starts = ends[by_end], starts[by_end]
        nodes, first, more = np.unique(ends, return_index=True, return_counts=True)
        place = np.arange(len(ends)) - np.repeat(first, more)
        for lo in range(0, len(nodes), 512):  # the candidates of a node: its neighbours and the new ones
            some = slice(lo, lo + 512)
            incoming = np.full((len(nodes[some]), more[some].max()), -1, np.int32)
            mine = (ends >= nodes[some][0]) & (ends <= nodes[some][-1])
            incoming[np.searchsorted(nodes[some], ends[mine]), place[mine]] = starts[mine]
            both = np.concatenate([edges[nodes[some]], incoming], axis=1)
            full = (both >= 0).sum(axis=1) > degree
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
            if full.any():
                packed[full] = prune(v, nodes[some][full], both[full], degree, alpha)
            edges[nodes[some]] = packed
        at += len(batch)
    return edges, entry


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """With the coordinate that makes all lengths equal, less ``longest``: short vectors then have small ones, told apart whatever the longest is."""
    v = v.astype(np.float64)
    square = (v * v).sum(axis=1)
    shift = -square / (longest + np.sqrt(np.maximum(longest**2 - square, 0)))
    return np.concatenate([v, shift[:, None]], axis=1).astype(np.float32)


def classes(rows: DataFrame, keep: int, salts: int = 16) -> DataFrame:
    """(vector, ids) per distinct vector, with its ``keep`` smallest ids: more can't be among the nearest of any query."""
    smallest = lambda keys: F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
    rows = rows.select("vec_id", "vector", F.xxhash64("vector").alias("vhash")).distinct()
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)))
    for keys in (["vhash", "salt", "vector"], ["vhash", "vector"]):  # salted first, so a vector with many copies is spread
        rows = rows.withColumn("place", smallest(keys)).filter(F.col("place") <= keep)
    return rows.groupBy("vhash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _parts(vectors: DataFrame, rows: int | None, components: int, least: int) -> int:
    """Parts of about ``rows`` vectors if given, else ``least`` or as many as keep each to ``components``."""
    count, held = vectors.agg(F.count(F.lit(1)), F.sum(F.size("vector"))).first()
    return max(1, -(-count // rows)) if rows else max(least, -(-(held or 0) // components))


def index(rows: DataFrame, longest: float, keep: int, shards: int = 8, shard_rows: int | None = None, degree: int = 32, width: int = 64, alpha: float = 1.2) -> DataFrame:
    """(shard, node, ids, vector, edges, entry): every vector, in shards of vectors of one length.

    Every query is sought in every shard, so there are ``shards`` of them whatever the size of ``rows``, until one has ``SHARD_COMPONENTS``;
    ``shard_rows`` sets their size instead.
    """
    distinct = materialise(classes(rows, keep), "vector-classes")
    shards = _parts(distinct, shard_rows, SHARD_COMPONENTS, shards)
    shard = F.concat_ws(":", F.size("vector"), F.pmod("vhash", F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vhash").reset_index(drop=True)
        v = np.stack(pdf["vector"].to_numpy())
        edges, entry = build(lifted(v, longest), degree, width, alpha)
        return pdf.drop(columns="vhash").assign(node=np.arange(len(pdf)), edges=list(edges), entry=int(entry[0]))

    kind = "shard string, ids array<long>, vector array<double>, node int, edges array<int>, entry int"
    placed = distinct.select(shard.alias("shard"), "vhash", "ids", "vector")
    return materialise(placed.groupBy("shard").applyInPandas(run, kind), "graph")


def search(rows: DataFrame, queries: DataFrame, k: int = 20, query_block: int | None = None, width: int = 96, id_col: str = "vec_id",
           vector_col: str = "embedding", **options) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` nearest of all rows with another id.

    Nearness is the inner product in double precision, ties go to the smaller id; fewer candidates are all returned. Vectors that are
    null, zero or hold null or non-finite components, and rows without id, take no part; vectors of another length aren't candidates.
    A repeated query row counts once; an id with several vectors is as many queries. Other columns are ignored. Queries go to the
    shards in blocks of about ``query_block`` (by default of ``BLOCK_COMPONENTS``), so no task holds all queries, and a shard is copied once per block.
    """
    tidy = lambda d: d.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable("vector"))
    rows, queries = materialise(tidy(rows), "vectors"), materialise(tidy(queries).distinct(), "queries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    longest = rows.agg(F.max(norm)).first()[0] or 1.0
    graph = index(rows, longest, k + 1, width=max(64, min(width, 96)), **options)
    blocks = _parts(queries, query_block, BLOCK_COMPONENTS, 1)
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
    shards = materialise(graph.select("shard", F.split("shard", ":")[0].cast("int").alias("size")).distinct(), "shards")
    asked = queries.withColumns({"block": block, "size": F.size("vector")}).join(shards, "size").select("shard", "block", "vec_id", "vector")
    held = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(g: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if g.empty or q.empty:
            return pd.DataFrame({"query_id": [], "query_hash": [], "vec_id": [], "score": []})
        g = g.sort_values("node")
        v, asked, ids = np.stack(g["vector"].to_numpy()), np.stack(q["vector"].to_numpy()), g["ids"].to_numpy()
        # far longer vectors than the rest have the largest products with half of all queries, but are near no other: searches start there too
        starts = np.unique(np.append(np.argsort(-(v * v).sum(axis=1), kind="stable")[:32], g["entry"].iloc[0])).astype(np.int32)
        single, edges = v.astype(np.float32), np.stack(g["edges"].to_numpy())
        found = np.concatenate([beam_search(single, edges, starts, asked[at:at + 1024].astype(np.float32), max(width, k + 1), away=products)[0]
                                for at in range(0, len(asked), 1024)])
        out = []
        for query, mark, own, nodes in zip(q["vec_id"], pd.util.hash_array(np.array([a.tobytes() for a in asked], object)).view(np.int64), asked, found):
            nodes = nodes[nodes >= 0]
            scores = np.einsum("nd,d->n", v[nodes], own)
            near = np.concatenate([ids[n] for n in nodes])
            scores = np.repeat(scores, [len(ids[n]) for n in nodes])
            other = near != query
            near, scores = near[other], scores[other]
            best = np.lexsort((near, -scores))[:k]
            out.append((np.full(len(best), query), np.full(len(best), mark), near[best], scores[best]))
        query, mark, near, scores = map(np.concatenate, zip(*out))
        return pd.DataFrame({"query_id": query, "query_hash": mark, "vec_id": near, "score": scores})

    cells = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
    found = cells.applyInPandas(run, "query_id long, query_hash long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
