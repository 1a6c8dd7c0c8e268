"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

Spherical k-means on a bounded sample gives cell centres; every vector belongs to the
cell of its largest cosine. Within a cell the cosines of its vectors are blocked matrix
products. A pair at the threshold may lie in two cells: a vector is also compared with
the members of another cell, of smaller number, when it is no farther from the border
between the two cells than the threshold's angle allows, so that no link is lost. Links
are counted per vector and kept as each vector's smallest id in its block, never as all pairs;
connected components and one representative of each follow.

Equal vectors are compared once and carry their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import bounded_batches, stored
from storelens.llm.components import connected_components
from storelens.llm.vectors import matrix, usable

THRESHOLD = 0.95

#: Vectors in a cell, about; rows of the k-means sample: for a cell, and in all unless there are more cells; its rounds.
CELL, SAMPLE_PER_CELL, SAMPLE, ROUNDS = 2048, 64, 200_000, 8

#: Bytes of all cells' centres, which the driver and the tasks hold: what bounds the number of cells. Cosines with
#: centres that a task holds at once.
CENTRE_BYTES, NEAR = 256_000_000, 4_000_000

#: Members (or guests) of a cell in one block, about: a crowded cell becomes many pairs of blocks. Rows and columns
#: of one product.
BLOCK, SQUARE = 4096, 1024


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _slices(rows: int, cells: int) -> list[slice]:
    """Rows whose cosines with all cells are held at once."""
    step = max(1, NEAR // max(1, cells))
    return [slice(at, at + step) for at in range(0, rows, step)]


def guests(x: np.ndarray, centres: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home of each unit vector, row and cell of each guest): cells of smaller number whose border is near enough.

    The border's distance is what the home centre is nearer by, over the centres' distance. That comes from the cosine of
    the two centres, for the homes that occur, so no table of all pairs of cells is held anywhere.
    """
    homes, rows, cells = [], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for part in _slices(len(x), len(centres)):
        near = x[part] @ centres.T
        home = near.argmax(axis=1)
        own, at = np.unique(home, return_inverse=True)
        gap = np.sqrt(np.maximum(0, 2 - 2 * (centres[own] @ centres.T)) + 1e-14)[at]  # rounding of near centres
        ok = near[np.arange(len(home)), home][:, None] - near <= slack * gap + 1e-12
        ok &= np.arange(len(centres)) < home[:, None]
        r, c = np.nonzero(ok)
        homes.append(home)
        rows.append(r + part.start)
        cells.append(c)
    return np.concatenate([np.zeros(0, dtype=np.int64), *homes]), np.concatenate(rows), np.concatenate(cells)


def spherical_kmeans(sample: DataFrame, cells: int, dim: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres (cells, dim) fitted on ``sample(vector)``: assignments in tasks, sums of one row per cell back."""
    spark = sample.sparkSession
    first = sample.orderBy(F.xxhash64("vector"), "vector").limit(cells).select("vector").collect()  # cells rows
    centres = unit(np.array([r.vector for r in first], dtype=np.float64))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sums = np.zeros_like(shared.value)
            for batch in batches:
                x = unit(matrix(batch.column(0)))
                for part in _slices(len(x), len(sums)):
                    np.add.at(sums, (x[part] @ shared.value.T).argmax(axis=1), x[part])
            yield pa.RecordBatch.from_pydict({"cell": list(range(len(sums))), "total": [s.tobytes() for s in sums]})

        def add(parts: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(b, np.float64) for b in parts.column("total").to_pylist())
            return pa.table({"cell": parts.column("cell").slice(0, 1), "total": [total.tobytes()]})

        rows = (sample.select("vector").mapInArrow(assign, "cell long, total binary")
                .groupBy("cell").applyInArrow(add, "cell long, total binary").collect())  # cells rows
        moved = centres.copy()
        for r in rows:
            total = np.frombuffer(r.total, np.float64)
            if (size := np.linalg.norm(total)) > 0:
                moved[r.cell] = total / size
        done = np.abs(moved - centres).max() < 1e-4
        centres = moved
        if done:
            break
    return centres


def _lowest(hit: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column reaches through the links of this block."""
    none = np.iinfo(np.int64).max
    while True:
        low_r = np.minimum(rows, np.where(hit, cols[None, :], none).min(axis=1))
        low_c = np.minimum(cols, np.where(hit, low_r[:, None], none).min(axis=0))
        if (low_r == rows).all() and (low_c == cols).all():
            return rows, cols
        rows, cols = low_r, low_c


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, cell: int = CELL) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept, cell.

    n_links: other vectors linked directly (cosine of at least ``threshold``, in double precision). component_id:
    smallest vec_id reachable by links, itself included; kept: vec_id = component_id. Null, empty, zero or non-finite
    vectors link with nothing and have no cell; vectors of different lengths never link. Rows with a null id stay,
    with null component and kept = false, and link with nothing. Repeated rows of one id count as one vector. The cells
    grow in number with the vectors, up to CENTRE_BYTES of centres; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()
    # equal vectors: the smallest id stands for all of them
    classes = stored(good.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
                     .withColumn("dim", F.size("vector").cast("long")), "classes")
    sizes = classes.groupBy("dim").count().collect()  # the few lengths that vectors have
    members, counts, links = [], [], []
    for size in sizes:
        own = classes.where(F.col("dim") == size.dim)
        member, count, link = _cells(own, size.dim, size["count"], threshold, cell)
        members.append(member)
        counts.append(count)
        links.append(link)

    def union(parts: list[DataFrame], schema: str) -> DataFrame:
        out = spark.createDataFrame([], schema)
        for p in parts:
            out = out.unionByName(p)
        return out

    linked = union(counts, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    labels = connected_components(stored(union(links, "a long, b long"), "links"))
    per_class = (classes.select("id", "vector", "copies")
                 .join(linked, "id", "left").join(labels.withColumnRenamed("node", "id"), "id", "left")
                 .join(union(members, "id long, cell long"), "id", "left")
                 .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "id").alias("component_id"), "cell"))
    keyed = rows.withColumn("key", F.when(F.col("vec_id").isNotNull() & usable(F.col("vector")), F.col("vector")))
    out = keyed.join(per_class.withColumnRenamed("vector", "key"), "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), "cell")


def _cells(own: DataFrame, dim: int, n: int, threshold: float, cell: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (id, cell), link counts (id, links) in parts, and (vector, smallest id linked to it) pairs (a, b) of one length's classes."""
    spark = own.sparkSession
    cells = max(1, min(n // cell, CENTRE_BYTES // (8 * dim)))
    part = min(1.0, max(cells, min(SAMPLE, cells * SAMPLE_PER_CELL)) / max(1, n))
    sample = own.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(part * (1 << 30)) + 1) if part < 1 else own
    centres = spherical_kmeans(sample, cells, dim) if cells > 1 else np.eye(1, dim)
    slack = math.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9  # sine of the threshold's angle
    shared = spark.sparkContext.broadcast(centres)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cell, id, copies, vector, home): every vector in its cell, and as a guest in others that it may link with."""
        for batch in batches:
            home, rows, at = guests(unit(matrix(batch.column(1))), shared.value, slack)
            rows, at = np.concatenate((np.arange(len(home)), rows)), np.concatenate((home, at))
            pick = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int64)), batch.column(0).take(pick), batch.column(2).take(pick),
                 batch.column(1).take(pick), pa.array(home[rows].astype(np.int64))],
                ["cell", "id", "copies", "vector", "home"])

    dealt = stored(own.select("id", "vector", "copies").mapInArrow(
        deal, "cell long, id long, copies long, vector array<double>, home long"), "cells")
    # Members and guests of a cell are dealt to blocks; a task compares two blocks, members with members or with
    # guests, so a crowded cell is many tasks of a bounded size.
    guest = F.col("cell") != F.col("home")
    sizes = dealt.groupBy("cell").agg((F.sum(F.when(guest, 0).otherwise(1)) / BLOCK).cast("long").alias("last"),
                                      F.sum(F.when(guest, 1).otherwise(0)).alias("guests"))  # a row for each cell
    rows = dealt.join(F.broadcast(sizes), "cell").select(
        "cell", "id", "copies", "vector", guest.alias("guest"), "last",
        F.when(F.col("guests") > 0, (F.col("guests") / BLOCK).cast("long")).alias("last_guest"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("guest"), F.col("last_guest")).otherwise(F.col("last")) + 1)

    def tiles(left, right, with_guests: bool, span):
        return F.transform(span, lambda k: F.struct(F.lit(with_guests).alias("with_guests"), left(k).alias("left"),
                                                    right(k).alias("right")))

    own_block, zero = F.col("own"), F.lit(0).cast("long")
    member_tiles = F.concat(
        tiles(lambda k: k, lambda k: F.col("own"), False, F.sequence(zero, own_block)),
        F.filter(tiles(lambda k: F.col("own"), lambda k: k, False, F.sequence(own_block, F.col("last"))),
                 lambda t: t["left"] != t["right"]),
        F.when(F.col("last_guest").isNotNull(),
               tiles(lambda k: F.col("own"), lambda k: k, True, F.sequence(zero, F.coalesce("last_guest", zero))))
        .otherwise(F.array().cast("array<struct<with_guests: boolean, left: bigint, right: bigint>>")))
    guest_tiles = tiles(lambda k: k, lambda k: F.col("own"), True, F.sequence(zero, F.col("last")))
    sent = (rows.withColumn("own", own)
            .withColumn("tile", F.explode(F.when(F.col("guest"), guest_tiles).otherwise(member_tiles)))
            .select("cell", "tile.with_guests", "tile.left", "tile.right", "id", "copies", "vector", "guest", "own"))

    def compare(part: pa.Table) -> pa.Table:
        """Products of two blocks, a square at a time."""
        with_guests, left, right = (part.column(c)[0].as_py() for c in ("with_guests", "left", "right"))
        block = part.column("own").combine_chunks().to_numpy()
        guests = part.column("guest").combine_chunks().to_numpy(zero_copy_only=False)
        ids = part.column("id").combine_chunks().to_numpy()
        copies = part.column("copies").combine_chunks().to_numpy().astype(np.int64)
        x = unit(matrix(part.column("vector")))
        rows, cols = np.flatnonzero(~guests & (block == left)), np.flatnonzero((guests == with_guests) & (block == right))
        same = not with_guests and left == right  # each pair is met from both sides
        counts = np.zeros(len(ids), dtype=np.int64)
        ends: list[np.ndarray] = [np.zeros((0, 2), dtype=np.int64)]
        for i in range(0, len(rows), SQUARE):
            for j in range(0, len(cols), SQUARE):
                mine, other = rows[i:i + SQUARE], cols[j:j + SQUARE]
                hit = x[mine] @ x[other].T >= threshold
                if same:
                    hit &= ids[mine][:, None] != ids[other][None, :]
                if hit.any():
                    counts[mine] += hit @ copies[other]
                    if not same:
                        counts[other] += copies[mine] @ hit
                    for at, low in zip((ids[mine], ids[other]), _lowest(hit, ids[mine], ids[other]), strict=True):
                        ends.append(np.stack((at, low), axis=1)[at != low])
        edges = np.unique(np.concatenate(ends), axis=0)
        some = np.flatnonzero(counts)
        return pa.table({
            "id": pa.array(np.concatenate((ids[some], edges[:, 0]))),
            "links": pa.array(np.concatenate((counts[some], np.zeros(len(edges), dtype=np.int64)))),
            "b": pa.array([None] * len(some) + edges[:, 1].tolist(), pa.int64())})

    found = stored(sent.groupBy("cell", "with_guests", "left", "right").applyInArrow(compare, "id long, links long, b long"), "near")
    return (dealt.where("cell = home").select("id", "cell"), found.where("b is null").select("id", "links"),
            found.where("b is not null").select(F.col("id").alias("a"), "b"))
