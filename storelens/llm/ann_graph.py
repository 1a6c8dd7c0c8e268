"""Nearest neighbours by robust-pruned directed graphs, one for each shard.

Vectors are dealt to shards by hash. A shard's graph grows from random links: greedy
searches from its medoid propose neighbours for each vector, and relaxed distance
pruning keeps the diverse ones: a candidate goes if a nearer kept neighbour, its
distance times ALPHA, is closer to the candidate than the vector is. A query runs a
beam search in each shard; the shards' results meet in its nearest.

Equal vectors are one point of the graph that carries its smallest ids, so a common
vector costs one point and ties come out whole. Vectors of different lengths are never
compared. Searches of a block of queries, and insertions of a block of vectors, go
through the graph together as matrix operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import stored
from storelens.llm.vectors import usable_vectors, matrix

#: Vectors in a shard, about; links of a vector; beam of a search while building and for a query; relaxation.
SHARD, DEGREE, BUILD_BEAM, BEAM, ALPHA = 2048, 32, 48, 96, 1.2

#: Inner products that pruning holds at once.
_PRODUCTS = 4_000_000

#: Queries in a block: they travel and search together.
BLOCK = 256


def _distances(x: np.ndarray, norms: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of each query (row of q) to its own candidates (row of at; -1 is none)."""
    d = norms[at] - 2 * np.einsum("qd,qkd->qk", q, x[at]) + (q * q).sum(axis=1)[:, None]
    return np.where(at < 0, np.inf, np.maximum(d, 0))


def beam_search(x: np.ndarray, norms: np.ndarray, links: np.ndarray, entry: int, q: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(points, squared distances), nearest first, of the ``beam`` best found for each query; -1 where fewer."""
    m, n = len(q), len(x)
    pool = np.full((m, beam), -1, dtype=np.int64)
    best = np.full((m, beam), np.inf)
    pool[:, 0] = entry
    best[:, 0] = _distances(x, norms, q, pool[:, :1])[:, 0]
    done = np.zeros((m, beam), dtype=bool)
    seen = np.zeros((m, n), dtype=bool)
    seen[:, entry] = True
    live = np.arange(m)
    while len(live):
        open_ = ~done[live] & (pool[live] >= 0)
        has = open_.any(axis=1)
        live = live[has]
        if not len(live):
            break
        slot = open_[has].argmax(axis=1)  # the pool is sorted: the nearest not yet expanded
        done[live, slot] = True
        near = links[pool[live, slot]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        rows, cols = np.nonzero(fresh)
        seen[live[rows], near[rows, cols]] = True
        near = np.where(fresh, near, -1)
        d = _distances(x, norms, q[live], near)
        all_p = np.concatenate((pool[live], near), axis=1)
        all_d = np.concatenate((best[live], d), axis=1)
        all_s = np.concatenate((done[live], np.zeros_like(fresh)), axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        pool[live] = np.take_along_axis(all_p, order, axis=1)
        best[live] = np.take_along_axis(all_d, order, axis=1)
        done[live] = np.take_along_axis(all_s, order, axis=1) | (pool[live] < 0)
    return pool, best


def robust_prune(x: np.ndarray, norms: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int,
                 alpha: float) -> np.ndarray:
    """The kept neighbours of each point among its candidates (a row each; -1 is none), nearest first."""
    width = candidates.shape[1]
    step = max(1, _PRODUCTS // (width * width))
    if len(points) > step:
        return np.concatenate([robust_prune(x, norms, points[i:i + step], candidates[i:i + step], degree, alpha)
                               for i in range(0, len(points), step)])
    cand = np.sort(candidates, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == points[:, None]] = -1
    d = _distances(x, norms, x[points], cand)
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, axis=1), np.take_along_axis(d, order, axis=1)
    own = x[cand]
    between = norms[cand][:, :, None] + norms[cand][:, None, :] - 2 * (own @ own.transpose(0, 2, 1))
    kept = np.full((len(points), degree), -1, dtype=np.int64)
    alive = cand >= 0
    for k in range(degree):
        rows = np.flatnonzero(alive.any(axis=1))
        if not len(rows):
            break
        first = alive[rows].argmax(axis=1)
        kept[rows, k] = cand[rows, first]
        alive[rows] &= alpha * alpha * between[rows, first] > d[rows]
        alive[rows, first] = False
    return kept


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
                block: int = 256, seed: int = 7) -> tuple[np.ndarray, int]:
    """(links, entry): up to ``degree`` neighbours of each row of x (-1 is none), and the medoid."""
    n = len(x)
    rng = np.random.default_rng(seed)
    norms = (x * x).sum(axis=1)
    entry = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    links = rng.integers(0, n, (n, min(degree, max(1, n - 1))))
    links[links == np.arange(n)[:, None]] = -1
    links = np.pad(links, ((0, 0), (0, degree - links.shape[1])), constant_values=-1)
    for relax in (1.0, alpha):
        order = rng.permutation(n)
        for at in range(0, n, block):
            points = order[at:at + block]
            found, _ = beam_search(x, norms, links, entry, x[points], beam)
            links[points] = robust_prune(x, norms, points, np.concatenate((found, links[points]), axis=1), degree, relax)
            # the new links' other ends get the points as candidates
            back, source = links[points].ravel(), np.repeat(points, degree)
            source, back = source[back >= 0], back[back >= 0]
            sort = np.argsort(back, kind="stable")
            source, back = source[sort], back[sort]
            ends, first, count = np.unique(back, return_index=True, return_counts=True)
            nth = np.arange(len(back)) - np.repeat(first, count)
            extra = np.full((len(ends), count.max(initial=0)), -1, dtype=np.int64)
            extra[np.repeat(np.arange(len(ends)), count), nth] = source
            links[ends] = robust_prune(x, norms, ends, np.concatenate((links[ends], extra), axis=1), degree, relax)
    return links, entry


def _scale(x: np.ndarray) -> float:
    """A power of two near the largest component: divided by it, products fit into single precision."""
    return float(2.0 ** np.frexp(np.abs(x).max(initial=0))[1])


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD,
                ids_kept: int = 11) -> DataFrame:
    """The stored index: a row for each shard (shard, dim, n, vectors, ids, links, entry).

    Every usable vector is in it; null, zero or non-finite ones and null ids are not. Equal vectors are one point
    with its ``ids_kept`` smallest ids, enough for searches of fewer neighbours than that. Repeated rows are one, an
    empty table gives an empty index.
    """
    rows = usable_vectors(vectors, id_col, vector_col)
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    points = stored(rows.distinct().select("id", "vector", first.alias("nth")).where(f"nth <= {ids_kept}")
                    .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")  # ids_kept at most
    if ids_kept < 2:
        raise ValueError("at least two ids of equal vectors must be kept")
    shards = points.count() // shard + 1
    dealt = points.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"),
                          "vector", "ids")

    def build(part: pa.Table) -> pa.Table:
        x = matrix(part.column("vector"))
        links, entry = build_graph((x / _scale(x)).astype(np.float32))
        return pa.table({
            "shard": part.column("shard").slice(0, 1), "dim": pa.array([x.shape[1]], pa.int64()),
            "n": pa.array([len(x)], pa.int64()), "ids_kept": pa.array([ids_kept], pa.int64()), "vectors": pa.array([x.tobytes()], pa.binary()),
            "ids": pa.array([part.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "links": pa.array([links.astype(np.int32).tobytes()], pa.binary()), "entry": pa.array([entry], pa.int64())})

    return stored(dealt.groupBy("shard", "dim").applyInArrow(
        build, "shard long, dim long, n long, ids_kept long, vectors binary, ids array<array<long>>, links binary, entry long"), "graphs")


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest found of each ``queries(id, vector)``.

    ``queries`` has usable vectors; a query's own id is no result for it. Ties go to the smaller id. Fewer than k
    other vectors of its length: all of them. Each block of queries goes to every shard of its length once. Repeated
    queries are one; several vectors of one id are one query for what is nearest to any of them. Without queries, or
    with an empty index, there is no row. An index keeps a bounded number of ids of equal vectors: a k for which they
    may not do is an error (build the index with ``ids_kept`` above k).
    """
    least = index.agg(F.min("ids_kept")).first()[0]
    if least is not None and k >= least:
        raise ValueError(f"the index keeps {least} ids of equal vectors, too few for the {k} nearest")
    queries = queries.select("id", "vector").distinct()
    groups = queries.count() // block + 1
    blocks = (queries.select(F.size("vector").cast("long").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(groups)).alias("block"),
                             "id", "vector")
              .groupBy("dim", "block").agg(F.collect_list(F.struct("id", "vector")).alias("queries")))  # a block each
    shards = index.select("dim", "shard").distinct()
    asked = blocks.join(shards, "dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                x = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
                links = np.frombuffer(row["links"], np.int32).reshape(-1, DEGREE).astype(np.int64)
                ids = row["ids"]
                q = np.array([r["vector"] for r in row["queries"]], dtype=np.float64)
                scale = max(_scale(x), _scale(q))
                near32 = (x / scale).astype(np.float32)
                found, _ = beam_search(near32, (near32 * near32).sum(axis=1), links, row["entry"],
                                       (q / scale).astype(np.float32), max(beam, k + 1))
                out = ([], [], [])
                for r, points in zip(row["queries"], found, strict=True):
                    own = points[points >= 0]
                    exact = np.sqrt(((x[own] - np.array(r["vector"], dtype=np.float64)) ** 2).sum(axis=1))
                    near = sorted((d, i) for p, d in zip(own.tolist(), exact.tolist(), strict=True)
                                  for i in ids[p] if i != r["id"])[:k]
                    out[0].extend([r["id"]] * len(near))
                    out[1].extend([i for _, i in near])
                    out[2].extend([d for d, _ in near])
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    found = (asked.join(index, ["shard", "dim"])
             .mapInArrow(run, "query_id long, vec_id long, score double")
             .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
