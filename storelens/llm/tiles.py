"""Comparing the rows of a cell with each other in bounded pairs of blocks.

A cell has members and guests: members are compared with members and with guests. A
small cell goes to one task together with others; a crowded one is dealt to blocks, and
a task takes two blocks. So a cell of m rows becomes rows in proportion to m times its
blocks, never its pairs, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of items in a block, about; bytes of small cells in a task, about.
BLOCK_ROWS, BLOCK_BYTES, TASK_BYTES = 1024, 8_000_000, 8_000_000

#: Columns of one product of incidence matrices.
_COLUMNS = 2048


def dealt(rows: DataFrame, alone: str = "false", block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``rows(cell, key, guest, items, ...)`` with the tiles (task, kind, left, right) that each takes part in.

    ``key`` (bytes or a number) tells rows of a cell apart; ``items`` is an array of longs. Kind 0 compares members with
    members, kind 1 members (left) with guests (right), kind 2 is a whole small cell. Cells with nothing to compare drop
    out, unless a row fulfils ``alone``.
    """
    size = 8 * F.size("items").cast("long") + 64
    of_kind = lambda guest: F.greatest(  # noqa: E731  blocks of members or of guests
        F.ceil(F.sum(F.when(F.col("guest") == guest, 1).otherwise(0)) / block_rows),
        F.ceil(F.sum(F.when(F.col("guest") == guest, size).otherwise(0)) / block_bytes)).cast("long")
    cells = (rows.groupBy("cell").agg(of_kind(False).alias("blocks"), of_kind(True).alias("guest_blocks"),
                                      F.count("*").alias("n"), F.count(F.when(~F.col("guest"), 1)).alias("own"),
                                      F.max(F.expr(alone)).alias("alone"))
             .where("own > 0 and (n > 1 or alone)").drop("n", "own", "alone"))
    total = rows.agg(F.sum(size)).first()[0] or 0
    tasks = int(total // TASK_BYTES) + 1
    small = (F.col("blocks") == 1) & (F.col("guest_blocks") <= 1)
    at = rows.join(cells, "cell").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.when(F.col("guest"), F.col("guest_blocks")).otherwise(F.col("blocks"))))
    zero = F.lit(0).cast("long")
    tile = lambda kind, left, right: F.struct(F.lit(kind).alias("kind"), left.alias("left"), right.alias("right"))
    pairs = F.when(F.col("guest"), F.transform(F.sequence(zero, F.col("blocks") - 1), lambda k: tile(1, k, F.col("block"))))
    pairs = pairs.otherwise(F.concat(
        F.transform(F.sequence(zero, F.col("blocks") - 1),
                    lambda k: tile(0, F.least(k, F.col("block")), F.greatest(k, F.col("block")))),
        F.filter(F.transform(F.sequence(zero, F.greatest(zero, F.col("guest_blocks") - 1)),
                             lambda k: tile(1, F.col("block"), k)),
                 lambda t: F.col("guest_blocks") > 0)))
    tiles = F.explode(F.when(small, F.array(tile(2, zero, zero))).otherwise(pairs))
    task = F.when(F.col("kind") == 2, F.pmod(F.xxhash64("cell"), F.lit(tasks))).otherwise(
        F.xxhash64("cell", "kind", "left", "right").bitwiseOR(F.lit(1 << 62)))  # apart from the small cells' tasks
    return (at.withColumn("tile", tiles).select(*rows.columns, "block", "tile.kind", "tile.left", "tile.right")
            .withColumn("task", task))


def comparisons(part: pa.Table, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """The comparisons (rows, other rows, whether both are the same rows) of one task's table; of equal keys one row."""
    cell, kind, left, right, block = (part.column(c).to_numpy() for c in ("cell", "kind", "left", "right", "block"))
    guest = part.column("guest").to_numpy()
    order = np.lexsort((right, left, kind, cell))
    keys = np.stack([x[order] for x in (cell, kind, left, right)])
    cuts = np.append(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))), len(order))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = order[lo:hi]
        own = own[np.unique(key[own], return_index=True)[1]]
        members, guests = own[~guest[own]], own[guest[own]]
        if kind[own[0]] == 0 and left[own[0]] != right[own[0]]:
            yield members[block[members] == left[own[0]]], members[block[members] == right[own[0]]], False
            continue
        if kind[own[0]] != 1:
            yield members, members, True
        if len(guests):
            yield members, guests, False


class Items:
    """The items of a task's rows, for counting what two rows share."""

    def __init__(self, column: pa.ChunkedArray):
        column = column.combine_chunks()
        self.first = column.offsets.to_numpy().astype(np.int64)
        self.first -= self.first[0]
        self.flat = column.flatten().to_numpy()

    def _of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.first[rows + 1] - self.first[rows]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[rows] - ends + n, n)
        return self.flat[at], np.repeat(np.arange(len(rows)), n)

    def shared(self, rows: np.ndarray, others: np.ndarray, same: bool) -> np.ndarray:
        """How many items each of ``rows`` shares with each of ``others``: products of 0/1 matrices, some columns at a time."""
        out = np.zeros((len(rows), len(others)), dtype=np.int64)
        if not out.size:
            return out
        mine, at = self._of(rows)
        theirs, other_at = (mine, at) if same else self._of(others)
        _, column, times = np.unique(mine if same else np.concatenate((mine, theirs)), return_inverse=True, return_counts=True)
        met = times[column] > 1  # an item of one row alone is not shared
        number = np.cumsum(times > 1) - 1
        n_columns = int(number[-1]) + 1 if len(number) else 0
        parts = [(at[met[:len(mine)]], number[column[:len(mine)]][met[:len(mine)]])]
        if not same:
            parts.append((other_at[met[len(mine):]], number[column[len(mine):]][met[len(mine):]]))
        ordered = []
        for r, c in parts:
            order = np.argsort(c, kind="stable")
            ordered.append((r[order], c[order]))
        for lo in range(0, n_columns, _COLUMNS):
            dense = []
            for (r, c), n in zip(ordered, (len(rows), len(others)), strict=False):
                a, b = np.searchsorted(c, (lo, lo + _COLUMNS))
                m = np.zeros((n, min(_COLUMNS, n_columns - lo)), dtype=np.float32)
                m[r[a:b], c[a:b] - lo] = 1
                dense.append(m)
            out += (dense[0] @ dense[-1].T).astype(np.int64)
        return out


def forest(hit: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links (row, column) of ``hit`` that connect all that its links connect, one fewer than there are nodes at most.

    Where ``same``, row k and column k are one node.
    """
    n, m = hit.shape
    reached, other_reached = np.zeros(n, dtype=bool), np.zeros(m, dtype=bool)
    edges: list[tuple[int, int]] = []
    for start in np.flatnonzero(hit.any(axis=1)).tolist():
        if reached[start]:
            continue
        reached[start] = True
        front = np.array([start])
        while len(front):
            left = np.flatnonzero(~(reached if same else other_reached))
            block = hit[np.ix_(front, left)]
            found = block.any(axis=0)
            new = left[found]
            edges.extend(zip(front[block[:, found].argmax(axis=0)].tolist(), new.tolist(), strict=True))
            if same:
                reached[new] = True
                front = new
                continue
            if not len(new):
                break
            other_reached[new] = True
            left = np.flatnonzero(~reached)
            block = hit[np.ix_(left, new)]
            found = block.any(axis=1)
            front = left[found]
            edges.extend(zip(front.tolist(), new[block[found].argmax(axis=1)].tolist(), strict=True))
            reached[front] = True
    return edges


def compared(rows: DataFrame, columns: list[str], compare: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``compare`` on each task's table of dealt ``rows``."""
    return (rows.select("task", "cell", "kind", "left", "right", "block", "guest", *columns)
            .groupBy("task").applyInArrow(compare, schema))
