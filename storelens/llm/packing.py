"""Best-fit packing of token pieces with Martello-Toth dominance reduction.

Documents become token pieces of at most ``capacity`` tokens. Only the number of
pieces of each length (at most ``capacity`` counts) decides the packing, so the
plan is made from that histogram whatever the number of documents:

* reduction: a set {j, k} is fixed for good when it dominates every other set that
  holds j, i.e. when k alone is at least as large as anything else that fits beside
  j (an exact fill always is). A piece beside which nothing fits is a set alone.
* the remainder goes best-fit, longest first, class by class.

Each piece then finds its place from its rank among the pieces of its length. Ranks
come from counts of hashed buckets of a length plus a number within the bucket, so
one very common length is still many small tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import bounded_batches, stored

CAPACITY = 2048

#: Pieces in a bucket of one length, about: the rows that one window task sorts.
BUCKET_ROWS = 200_000

#: Words whose ids a task remembers; the memory is emptied beyond.
REMEMBERED = 300_000


_LATIN = re.compile("[a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable letter: itself where printable, else 256 and up."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return dict(zip([*same, *sorted(set(range(256)) - set(same))], map(chr, [*same, *range(256, 324)]), strict=True))


@lru_cache(maxsize=1)
def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Token ids (little-endian uint32 bytes) of texts under a byte-level vocabulary that drops white space and case.

    White space only separates there, so a text's ids are those of its space-separated parts in order. A part is
    looked up; else it is a Latin word and what follows it, or goes to the library as it is. One encoder a worker
    process serves all its tasks.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, letters = tokenizer.model, _byte_letters()
    known: dict[str, bytes] = {"": b""}

    def ids(part: str) -> bytes:
        found = known.get(part)
        if found is None:
            if word := _LATIN.match(part):
                if (end := word.end()) == len(part):  # one word: what the library's steps before the merges leave
                    found = [t.id for t in model.tokenize(part.encode().decode("latin-1").translate(letters))]
                    found = np.array(found, dtype="<u4").tobytes()
                elif part[end] in ".,;:!?)\n":  # never joined with a letter before it
                    found = ids(part[:end]) + ids(part[end:])
            if found is None:
                found = np.array(tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if len(part) < 100:
                known[part] = found
        return found

    def encode(texts: list[str]) -> list[bytes]:
        if len(known) > REMEMBERED:
            known.clear()
            known[""] = b""
        out = []
        for text in texts:
            try:
                text.encode("latin-1")
                text = text.lower()  # one letter for one letter in this range
            except UnicodeEncodeError:
                pass
            parts = text.replace("\n", " ").replace("\t", " ").split(" ")
            out.append(b"".join([known.get(w) or ids(w) for w in parts]))
        return out

    return encode


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, uid (and ``ids`` bytes if asked for).

    A null text is an empty one: one piece with the end id alone. ``uid`` numbers the rows of a task.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, uid = word_encoder(vocabulary), TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(ids), 64):
                out: dict[str, list] = defaultdict(list)
                for doc, raw in zip(ids[lo:lo + 64], encode([t or "" for t in texts[lo:lo + 64]]), strict=True):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at:at + 4 * capacity]
                        uid += 1
                        row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part), uid) + ((part,) if with_ids else ())
                        for name, v in zip(schema.names, row, strict=True):
                            out[name].append(v)
                if out:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("uid", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    schema = pa.schema(fields)
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
             + (", ids binary" if with_ids else ""))


Pattern = tuple[tuple[int, int], ...]  # (length, how many) in one sequence


def dominance_reduction(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """(fixed sets with how often each, counts that remain)."""
    left = {n: c for n, c in counts.items() if c}
    fixed: list[tuple[Pattern, int]] = []

    def fix(pattern: Pattern, times: int) -> None:
        fixed.append((pattern, times))
        for n, k in pattern:
            left[n] -= k * times
            if not left[n]:
                del left[n]

    for j in sorted(left, reverse=True):  # exact fills
        k = capacity - j
        if j == capacity:
            fix(((j, 1),), left[j])
        elif j > k and k in left:
            fix(((j, 1), (k, 1)), min(left[j], left[k]))
        elif j == k and left.get(j, 0) > 1:
            fix(((j, 2),), left[j] // 2)
    again = True
    while again:
        again = False
        for j in sorted(left, reverse=True):
            while j in left:
                rest = dict(left)
                rest[j] -= 1
                room = capacity - j
                fit = [n for n, c in rest.items() if c and n <= room]
                if not fit:  # nothing fits beside any of this length
                    fix(((j, 1),), left[j])
                    again = True
                    break
                k = max(fit)
                if _largest_sum(rest, fit, room) > k:
                    break
                times = min(left[j], left[k]) if j != k else left[j] // 2
                fix(((j, 1), (k, 1)) if j != k else ((j, 2),), times)
                again = True
    return fixed, left


def _largest_sum(counts: dict[int, int], lengths: list[int], room: int) -> int:
    """The largest sum up to ``room`` that some of the pieces reach."""
    full, reach = (1 << (room + 1)) - 1, 1
    for n in sorted(lengths):
        c = min(counts[n], room // n)
        step = 1
        while c > 0:
            reach |= (reach << (n * min(step, c))) & full
            c -= step
            step *= 2
        if reach >> room:
            break
    return reach.bit_length() - 1


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Best-fit, longest first, with equal sequences handled together."""
    open_at: dict[int, list[list]] = defaultdict(list)  # free room -> [pattern, how many]
    rooms: list[int] = []  # the keys in order

    def put(room: int, pattern: Pattern, times: int) -> None:
        if times:
            if not open_at[room]:
                rooms.insert(bisect_left(rooms, room), room)
            open_at[room].append([pattern, times])

    for n in sorted(counts, reverse=True):
        c = counts[n]
        while c:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                each = capacity // n
                put(capacity - n * each, ((n, each),), c // each)
                put(capacity - n * (c % each), ((n, c % each),), 1 if c % each else 0)
                break
            room = rooms[at]
            pattern, times = open_at[room].pop()
            if not open_at[room]:
                rooms.pop(at)
            each = min(room // n, c)
            take = min(times, c // each)
            put(room, pattern, times - take)
            put(room - n * each, pattern + ((n, each),), take)
            c -= take * each
    return [(p, t) for groups in open_at.values() for p, t in groups]


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of ranks: first rank, first sequence, how many a sequence, offset of the first there."""
    fixed, left = dominance_reduction(counts, capacity)
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, times in fixed + best_fit(left, capacity):
        offset = 0
        for n, k in pattern:
            runs[n].append((used[n], sequence, k, offset))
            used[n] += k * times
            offset += n * k
        sequence += times
    return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*r, strict=True)) for n, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with length and uid) with sequence_id and offset added.

    Lengths must be 1 to ``capacity``. An empty table stays empty; equal pieces are placed in uid order.
    """
    spark = pieces.sparkSession
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    plan = spark.sparkContext.broadcast(packing_plan(counts, capacity))
    buckets = sum(counts.values()) // BUCKET_ROWS + 1
    at = pieces.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    before = (at.groupBy("length", "bucket").agg(F.count("*").alias("rows"))
              .withColumn("before", F.sum("rows").over(Window.partitionBy("length").orderBy("bucket")) - F.col("rows"))
              .drop("rows"))
    ranked = (at.join(F.broadcast(before) if buckets * len(counts) <= 100_000 else before, ["length", "bucket"])
              .withColumn("rank", F.col("before") - 1
                          + F.row_number().over(Window.partitionBy("length", "bucket").orderBy("uid")))
              .drop("bucket", "before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                first, base, each, start = plan.value[n]
                own = length == n
                run = np.searchsorted(first, rank[own], side="right") - 1
                nth = rank[own] - first[run]
                sequence[own] = base[run] + nth // each[run]
                offset[own] = start[run] + nth % each[run] * n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)],
                                             [*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {t}" for n, t in ranked.dtypes)
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long").drop("rank")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0,
                   with_ids: bool = False) -> DataFrame:
    """Tokens of ``docs(doc_id, text)`` packed into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for). Other
    columns are not read. A null doc_id stays null; repeated rows are packed each. Null or empty texts are one end id.
    """
    return pack(stored(token_pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces"), capacity).drop("uid")
