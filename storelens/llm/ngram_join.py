"""N-gram Jaccard join by grouped prefixes.

A document is its set of distinct word shingles; two documents link when
``100 * |A & B| >= percent * |A | B|``. The steps:

1. A frequency sketch of all shingles (hashed counters whose number follows the
   document count) fixes one global order, rare first. The order only steers the
   work: any order gives the same links.
2. Each document keeps the prefix of its set that must hold a shared shingle with
   any partner. Documents of the same size and prefix are one group, with one
   posting per prefix shingle; shingles of a single group drop out.
3. Groups that share a prefix shingle meet in one cell each (``_group_cells``).
   Pairs of groups pass the length and prefix filters there; groups without a
   possible partner drop out.
4. The other groups are expanded into their members, classes of equal sets, and all
   members of a cell are compared exactly, on whole sets.

A crowded cell is compared in bounded pairs of blocks (``tiles``), as products of
incidence matrices; a pair of blocks hands on at most one link a row, a forest that
connects what its links connect. So nothing grows with the pairs of a group but the
products themselves, and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import BROADCAST_IDS, bounded_batches, keyed_filter, stored
from storelens.llm.components import connected_components
from storelens.llm.shingles import shingle_sets
from storelens.llm.tiles import Items, comparisons, compared, dealt, forest

SHINGLE_WORDS = 5
PERCENT = 80

#: Counters of the sketch: a power of two near SKETCH_PER_DOC a document, within these bounds (16 MB at most).
SKETCH_PER_DOC, SKETCH_BITS = 16, (12, 24)
_SEGMENT = 1 << 12


def sketch_bits(n_docs: int) -> int:
    low, high = SKETCH_BITS
    return min(high, max(low, (n_docs * SKETCH_PER_DOC).bit_length()))


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte on a logarithmic scale, monotone: all that the order needs."""
    return np.minimum(255, np.floor(8 * np.log2(counts.astype(np.float64) + 1))).astype(np.uint8)


def shingle_order(docs: DataFrame, n_docs: int, size: int = SHINGLE_WORDS) -> np.ndarray:
    """One byte for each hash cell: the log-scaled number of documents with a shingle there, over all documents."""
    bits = sketch_bits(n_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(1 << bits, dtype=np.uint32), [], 0

        def flush() -> None:
            np.add.at(total, np.concatenate(waiting), np.uint32(1))
            waiting.clear()

        for batch in batches:
            for s in shingle_sets(batch.column(0).to_pylist(), size):
                waiting.append(_cells(s, bits))
                held += len(s)
                if held > 1 << 20:
                    flush()
                    held = 0
        if waiting:
            flush()
        for k, part in enumerate(total.reshape(-1, _SEGMENT)):
            if part.any():
                narrow = part.astype(np.uint16) if part.max() < 65536 else part
                yield pa.RecordBatch.from_pydict({"segment": [k], "counts": [narrow.tobytes()]})

    def add(parts: pa.Table) -> pa.Table:
        total = np.zeros(_SEGMENT, dtype=np.uint64)
        for raw in parts.column("counts").to_pylist():
            total += np.frombuffer(raw, dtype=np.uint16 if len(raw) == 2 * _SEGMENT else np.uint32)
        return pa.table({"segment": parts.column("segment").slice(0, 1), "ranks": [_ranks(total).tobytes()]})

    rows = (docs.select("text").mapInArrow(count, "segment long, counts binary")
            .groupBy("segment").applyInArrow(add, "segment long, ranks binary").collect())  # 16 MB at most
    order = np.zeros(1 << bits, dtype=np.uint8)
    for r in rows:
        order[r.segment * _SEGMENT:(r.segment + 1) * _SEGMENT] = np.frombuffer(r.ranks, dtype=np.uint8)
    return order


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set of n of which a partner must share at least one."""
    return n - (percent * n + 99) // 100 + 1


def _digests(docs: DataFrame, order, bits: int, size: int, percent: int) -> DataFrame:
    """(doc_id, n, sig, gid, prefix): set size, digest of the set, digest of size and prefix, prefix rare first."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for batch in batches:
            n, sig, gid, prefix = [], [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), size):
                n.append(len(s))
                sig.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                first = s[np.lexsort((s, rank[_cells(s, bits)]))[:prefix_length(len(s), percent)]] if len(s) else s
                gid.append(xxhash.xxh3_64_intdigest(first.tobytes() + len(s).to_bytes(8, "little")) - (1 << 63))
                prefix.append(first.view(np.int64))
            ends = np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(gid, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "n", "sig", "gid", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, sig binary, gid long, prefix array<long>")


def _items(docs: DataFrame, size: int) -> DataFrame:
    """(sig, items): digest and shingle hashes of each text."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(0).to_pylist(), size))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["sig", "items"])

    return docs.select("text").mapInArrow(run, "sig binary, items array<long>")


def _few(df: DataFrame, n: int) -> DataFrame:
    """``df`` (n rows of up to some 100 bytes) as a broadcast side while it is small, else as it is."""
    return F.broadcast(df) if n <= BROADCAST_IDS // 8 else df


def _group_cells(digests: DataFrame, groups: DataFrame) -> DataFrame:
    """(cell, key, guest, items, n, members): groups in the cells where they are compared; key is the group's gid.

    A group's home cell is the most crowded shingle of its prefix. Of two groups that share a shingle either both have
    one home, or their homes differ; then the groups of the less crowded home are guests in the other's cell. So every
    pair of groups that share a prefix shingle meets in exactly one cell.
    """
    reps = groups.select(F.col("g").alias("doc_id"), "gid")
    own = digests.where("n > 0 and doc_id is not null").join(_few(reps, groups.count()), ["doc_id", "gid"], "left_semi")
    postings = stored(own.select("gid", F.explode("prefix").alias("tok")), "postings")
    crowd = postings.groupBy("tok").agg(F.count("*").alias("crowd")).where("crowd > 1")  # one group alone joins nothing
    at = (postings.join(crowd, "tok")
          .unionByName(groups.where("members > 1").select("gid", F.col("gid").alias("tok"), F.lit(0).cast("long").alias("crowd")))
          .groupBy("gid").agg(F.max(F.struct("crowd", "tok")).alias("home"), F.collect_set("tok").alias("items")))
    at = stored(at.join(groups.select("gid", "n", "members"), "gid"), "homes")
    homes = (at.select("home", F.explode("items").alias("tok")).distinct()
             .groupBy("tok").agg(F.sort_array(F.collect_set("home"), asc=False).alias("homes")).where("size(homes) > 1"))
    visits = (homes.select(F.posexplode("homes").alias("place", "host"), "homes")
              .select("host", F.explode(F.slice("homes", F.col("place") + 2, F.size("homes"))).alias("home")).distinct())
    return (at.select(F.col("home.tok").alias("cell"), F.col("gid").alias("key"), F.lit(False).alias("guest"), "items", "n", "members")
            .unionByName(at.join(visits, "home").select(F.col("host.tok").alias("cell"), F.col("gid").alias("key"),
                                                        F.lit(True).alias("guest"), "items", "n", "members")))


def _passing_groups(cells: DataFrame, percent: int) -> DataFrame:
    """(cell, gid, guest) of groups that some group of their cell may link with, or that have several members.

    Length filter: 100 min(n, m) >= percent max(n, m). Prefix filter: two sets share at most the shingles that their
    prefixes share, and as many as stand behind the prefix that ends first.
    """

    def compare(part: pa.Table) -> pa.Table:
        items, n = Items(part.column("items")), part.column("n").to_numpy().astype(np.int64)
        behind = (percent * n + 99) // 100 - 1
        passing = (part.column("members").to_numpy() > 1) & ~part.column("guest").to_numpy()
        for rows, others, same in comparisons(part, part.column("key").to_numpy()):
            x, y = n[rows][:, None], n[others][None, :]
            most = items.shared(rows, others, same) + np.maximum(behind[rows][:, None], behind[others][None, :])
            ok = (np.minimum(x, y) * 100 >= np.maximum(x, y) * percent) & (most * (100 + percent) >= (x + y) * percent)
            if same:
                np.fill_diagonal(ok, False)
            passing[rows[ok.any(axis=1)]] = True
            passing[others[ok.any(axis=0)]] = True
        return part.select(["cell", "key", "guest"]).filter(pa.array(passing)).rename_columns(["cell", "gid", "guest"])

    return compared(dealt(cells, "members > 1"), ["key", "items", "n", "members"], compare,
                    "cell long, gid long, guest boolean").distinct()


def _links(cells: DataFrame, percent: int) -> DataFrame:
    """Of ``cells(cell, key, guest, items, c, copies)``, exactly compared: (sig, n_links) in parts, and links (a, b, shared).

    The links are verified pairs that connect all that the links of a tile connect, at most as many as it has rows.
    """

    def compare(part: pa.Table) -> pa.Table:
        items, c, copies = Items(part.column("items")), part.column("c").to_numpy(), part.column("copies").to_numpy()
        n, counts = np.diff(items.first), np.zeros(len(part), dtype=np.int64)
        a, b, k = [], [], []
        keys = np.array(part.column("key").to_pylist(), dtype="S16")
        for rows, others, same in comparisons(part, keys):
            shared = items.shared(rows, others, same)
            hit = shared * 100 >= (n[rows][:, None] + n[others][None, :] - shared) * percent
            if same:
                np.fill_diagonal(hit, False)
            if hit.any():
                counts[rows] += hit @ copies[others]
                if not same:
                    counts[others] += copies[rows] @ hit
                for r, o in forest(hit, same):
                    a.append(c[rows[r]])
                    b.append(c[others[o]])
                    k.append(shared[r, o])
        some, none = np.flatnonzero(counts), [None] * len(a)
        return pa.table({
            "sig": pa.array(part.column("key").take(pa.array(some)).to_pylist() + none, pa.binary()),
            "n_links": pa.array(counts[some].tolist() + none, pa.int64()),
            "a": pa.array([None] * len(some) + [min(x) for x in zip(a, b, strict=True)], pa.int64()),
            "b": pa.array([None] * len(some) + [max(x) for x in zip(a, b, strict=True)], pa.int64()),
            "shared": pa.array([None] * len(some) + k, pa.int64())})

    return compared(dealt(cells), ["key", "items", "c", "copies"], compare,
                    "sig binary, n_links long, a long, b long, shared long")


def ngram_jaccard_join(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(classes, links) of ``docs(doc_id, text)``; other columns, whatever their names, are not read.

    ``classes``: one row per input row: doc_id, n_shingles, class_id (smallest doc_id with the same set), n_links (other
    rows linked directly), component_id (smallest doc_id reachable by links, itself included).
    ``links``: verified pairs (a, b, shared) of class ids, which connect each component.

    Texts without words, empty or null: no shingle, linked with nothing, component_id = doc_id. Rows without a
    doc_id stay, with null class and component. Rows that share a doc_id are one document with several texts:
    their links meet in that id. Repeated rows are equal sets and link. Very long texts are taken whole; an empty
    table gives empty results.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n_docs = docs.count()
    bits = sketch_bits(n_docs)
    order = spark.sparkContext.broadcast(shingle_order(docs, n_docs, size))
    digests = stored(_digests(docs, order, bits, size, percent), "digests")

    classes = stored(digests.where("n > 0 and doc_id is not null").groupBy("sig", "n").agg(
        F.min("doc_id").alias("c"), F.min("gid").alias("gid"), F.count("*").alias("copies")), "classes")
    groups = stored(classes.groupBy("gid", "n").agg(F.min("c").alias("g"), F.count("*").alias("members")), "groups")
    passing = stored(_passing_groups(stored(_group_cells(digests, groups), "group-cells"), percent), "passing")

    # Only groups with a possible partner are expanded; their members' sets are made anew, once.
    expanded = stored(passing.join(classes.select("gid", "sig", "c", "copies"), "gid").drop("gid"), "members")
    wanted = expanded.select(F.col("c").alias("doc_id")).distinct()
    sets = _items(keyed_filter(docs, wanted, "doc_id", wanted.count()), size)
    cells = (sets.join(_few(expanded, expanded.count()), "sig")
             .select("cell", F.col("sig").alias("key"), "guest", "items", "c", "copies"))
    found = stored(_links(stored(cells, "cells"), percent), "links")
    links = found.where("a is not null").select("a", "b", "shared")
    labels = stored(connected_components(links), "labels")

    of_class = (classes.join(labels.withColumnRenamed("node", "c"), "c", "left")
                .join(found.where("sig is not null").groupBy("sig").agg(F.sum("n_links").alias("n_links")), "sig", "left")
                .select("sig", F.col("c").alias("class_id"), F.coalesce("component", "c").alias("component_id"),
                        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = F.col("doc_id").isNotNull()
    rows = digests.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(of_class, "sig", "left").select(
        "doc_id", "n_shingles", F.when(named, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(named, F.coalesce("n_links", F.lit(0))).alias("n_links"),
        F.when(named, F.coalesce("component_id", "doc_id")).alias("component_id"))
    return rows, links
