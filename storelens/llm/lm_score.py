"""Cross-entropy difference of two n-gram models with one vocabulary.

The target model counts the bigrams of chosen documents, the background model those of
all documents; both use the same vocabulary (every word of all documents, or on demand the
most frequent ones, any other word then being one unknown word), the same order and the
same smoothing: absolute discounting takes a part of each observed count, whatever the
model, and gives it to single words, whose counts the background scales to the target's
size. So every observed bigram keeps a chance of its own in either model. A document's score is its mean loss per token under the target model
less that under the background model: the lower, the more it is like the target.

Counts cover all documents and stay distributed: documents fall into blocks, a block sends
its distinct bigrams and words to buckets, a bucket sums them over all blocks and answers
each block. No task and no broadcast holds the model. Words are 64-bit hashes.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import BROADCAST_IDS, bounded_batches, stored

WORD = re.compile(r"\w+")

#: Numbers of the unknown word and of the text begin, the two entries of the vocabulary that are no words.
UNKNOWN, BEGIN = 0, 1

#: What absolute discounting takes off each count: less than one, so that something is left of any.
DISCOUNT = 0.75

#: Characters of text in a block and, of all blocks' texts, in a bucket (about; more blocks and buckets on small inputs).
BLOCK_CHARS, BUCKET_CHARS = 2_500_000, 6_000_000

#: Documents (about) whose frequent first words are spread over buckets, and how many words that may be.
HOT_SAMPLE, HOT_WORDS = 2_000, 5_000

_FLUSH, _REMEMBERED = 500_000, 200_000

#: Rows between blocks and buckets: a bigram bucket's answers, a bucket's words, a block's words there, counts of counts.
ANSWERS, WORDS, ASKED, COUNTS = range(4)


def vocabulary(texts: DataFrame, size: int) -> dict[str, int]:
    """The size - 2 most frequent words of ``texts(text)`` with their numbers; ties to the word that sorts first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(WORD.findall((text or "").lower()))
            if len(found) > _FLUSH:
                yield rows(found)
                found = Counter()
        yield rows(found)

    def rows(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                          ["word", "n"])

    top = (texts.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(size - 2).collect())
    return {r.word: k for k, r in enumerate(top, 2)}


class _Hashes(dict):
    """A word's number: its hash. Remembers the words of one block."""

    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)
        return number


def token_ids(text: str | None, number: Callable[[str], int]) -> list[int]:
    """A text's words as numbers, after the begin mark."""
    return [BEGIN, *map(number, WORD.findall((text or "").lower()))]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(8)).astype(np.int64)


class Block:
    """The distinct words and bigrams of some texts, each in the order of their buckets."""

    def __init__(self, texts: list[str | None], number: Callable[[str], int], buckets: int, hot: tuple[np.ndarray, np.ndarray]):
        flat, lengths = array("q"), []
        for text in texts:
            ids = token_ids(text, number)
            flat.extend(ids)
            lengths.append(len(ids))
        lengths = np.array(lengths, dtype=np.int64)
        self.n_tokens = lengths - 1
        words, at = np.unique(np.frombuffer(flat, np.int64), return_inverse=True)
        at = at.astype(np.int32)
        follows = np.ones(len(at), dtype=bool)
        follows[np.cumsum(lengths) - lengths] = False
        self.next = np.flatnonzero(follows).astype(np.int32)
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), self.n_tokens)
        keys, pair, self.n = np.unique(at[self.next - 1].astype(np.int64) * len(words) + at[self.next],
                                       return_inverse=True, return_counts=True)
        self.pair = pair.astype(np.int32)
        self.first, self.second = np.divmod(keys, max(1, len(words)))  # positions in words
        self.words, self.at = words, at
        self.word_bucket = _mix(words) % buckets
        self.pair_bucket = spread(words[self.first], words[self.second], buckets, hot)
        self.word_order = np.argsort(self.word_bucket, kind="stable")
        self.pair_order = np.argsort(self.pair_bucket, kind="stable")


def spread(first: np.ndarray, second: np.ndarray, buckets: int, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A bigram's bucket: that of its first word, or one of several where the first word is in ``hot`` (words, how many)."""
    home = _mix(first)
    words, ways = hot
    if len(words):
        at = np.minimum(np.searchsorted(words, first), len(words) - 1)
        home = home + np.where(words[at] == first, _mix(second) % ways[at], 0)
    return home % buckets


def _slices(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket of a sorted array with its slice."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
        if b > a:
            yield int(buckets[a]), slice(a, b)


def _hot_words(docs: DataFrame, number_of: Callable[[], Callable[[str], int]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First words with more than a quarter of a bucket's share in a sample, sorted, and the buckets for each.

    Only steers where bigrams are summed: any choice gives the same counts.
    """
    some = max(1, docs.count() // HOT_SAMPLE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        number = number_of()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(token_ids((text or "")[:20_000], number)[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                                         ["word", "n"])

    counts = (docs.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(some)) == 0).select("text")
              .mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 1
    top = (counts.where(F.col("n") * 4 * buckets > total).orderBy(F.desc("n"), "word").limit(HOT_WORDS).collect())
    top = sorted((r.word, min(buckets, -(-4 * buckets * r.n // total))) for r in top)
    return np.array([w for w, _ in top], dtype=np.int64), np.array([k for _, k in top], dtype=np.int64)


def _zip(x: np.ndarray) -> bytes:
    """Compressed numbers, after the length that they have."""
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True) if raw else b""


def _unzip(x: bytes) -> bytes:
    return _ZSTD.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) if x else b""


def _joined(column: pa.ChunkedArray, dtype, zipped: bool = True) -> np.ndarray:
    return np.frombuffer(b"".join([_unzip(x) if zipped else x for x in column.to_pylist()]), dtype)


_ZSTD = pa.Codec("zstd", compression_level=1)
_DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("is_target", pa.bool_())])


def _blocks(docs: DataFrame, chars: int) -> DataFrame:
    """``docs(doc_id, text, is_target)`` as stored rows (block, docs), each with texts of about ``chars`` characters."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0
        for batch in batches:
            begin = 0
            lengths = pc.utf8_length(batch.column(1)).to_pylist()
            for k, n in enumerate(lengths):
                size += n or 0
                if size >= chars:
                    yield row(base + made, [*held, batch.slice(begin, k + 1 - begin)])
                    made, held, size, begin = made + 1, [], 0, k + 1
            held.append(batch.slice(begin))
        if any(len(b) for b in held):
            yield row(base + made, held)

    def row(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(pa.Table.from_arrays(pa.Table.from_batches(held).columns, schema=_DOCS).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                          ["block", "docs"])

    return stored(docs.select("doc_id", "text", "is_target").mapInArrow(pack, "block long, docs binary"), "blocks")


_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("x", pa.binary()), ("y", pa.binary()),
                   ("n0", pa.binary()), ("n1", pa.binary())])
_SUMMED = pa.schema([("kind", pa.int64()), ("at", pa.int64()), ("part", pa.int64()), ("x", pa.binary()), ("y", pa.binary()),
                     ("n0", pa.int64()), ("n1", pa.int64()), ("words", pa.int64())])
_SUMMED_SQL = "kind long, at long, part long, x binary, y binary, n0 long, n1 long, words long"
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int64()), ("part", pa.int64()), ("x", pa.binary()), ("y", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _sum_bigrams(parts: pa.Table, bucket: int, buckets: int) -> list[tuple]:
    """One bucket's bigrams over all blocks: each block's answers, and how often each first word has each count."""
    x, y = _joined(parts.column("x"), np.int64), _joined(parts.column("y"), np.int64, zipped=False)
    order = np.lexsort((y, x))
    new = np.ones(len(x), dtype=bool)
    new[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
    at = np.empty(len(x), dtype=np.int64)
    at[order] = np.cumsum(new) - 1
    first = x[order][new]
    sums = [np.bincount(at, _joined(parts.column(n), np.uint32)).astype(np.int64) for n in ("n0", "n1")]
    out, begin = [], 0
    for block, asked in zip(parts.column("block").to_pylist(), parts.column("y").to_pylist(), strict=True):
        own = at[begin:begin + len(asked) // 8]
        begin += len(own)
        out.append((ANSWERS, block, bucket, _zip(sums[0][own]), _zip(sums[1][own]), 0, 0, 0))
    for model, counts in enumerate(sums):
        words, seen = first[counts > 0], counts[counts > 0]
        order = np.lexsort((seen, words))
        words, seen = words[order], seen[order]
        start = np.flatnonzero(np.concatenate(([True], (np.diff(words) != 0) | (np.diff(seen) != 0)))) if len(words) else []
        times = np.diff(np.append(start, len(words)))
        words, seen = words[start], seen[start]
        home = _mix(words) % buckets
        by_home = np.argsort(home, kind="stable")
        for word_bucket, cut in _slices(home[by_home]):
            own = by_home[cut]
            out.append((COUNTS, word_bucket, 2 * bucket + model, _zip(words[own]),
                        _zip(np.stack((seen[own], times[own])).astype(np.int64)), 0, 0, 0))
    return out


def _sum_words(parts: pa.Table, bucket: int) -> list[tuple]:
    """One bucket's words over all blocks: counts as next and as first word, and where each block's words are among them."""
    words, at = np.unique(_joined(parts.column("x"), np.int64, zipped=False), return_inverse=True)
    sums = np.zeros((4, len(words)), dtype=np.int64)
    out, begin = [], 0
    for block, asked, counts in zip(*[parts.column(c).to_pylist() for c in ("block", "x", "y")], strict=True):
        own = at[begin:begin + len(asked) // 8]
        begin += len(own)
        sums[:, own] += np.frombuffer(_unzip(counts), np.int64).reshape(4, -1)
        out.append((ASKED, bucket, block, _zip(own.astype(np.uint32)), b"", 0, 0, 0))
    out.append((WORDS, bucket, 0, _zip(words), _zip(sums), int(sums[0].sum()), int(sums[1].sum()),
                int((words > BEGIN).sum() + (words < UNKNOWN).sum())))
    return out


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, size: int | None = None) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score for each row of ``docs(doc_id, text)``.

    ``target_ids(doc_id)`` names the target documents; null and repeated ids there change nothing. Losses are means
    per token. Texts without a word, empty or null: zero tokens and null losses and score. Without any target
    document the target model knows no count: every word is as likely. Other columns of ``docs`` are not read.
    Every word of ``docs`` is in the vocabulary; with ``size`` only the size - 2 most frequent ones.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    buckets = max(partitions, chars // BUCKET_CHARS + 1)
    shared = spark.sparkContext.broadcast(vocabulary(docs, size)) if size else None

    def number_of() -> Callable[[str], int]:
        if shared is None:
            return _Hashes().__getitem__
        return lambda word, numbers=shared.value: numbers.get(word, UNKNOWN)

    hot = _hot_words(docs, number_of, buckets)
    marks = target_ids.where("doc_id is not null").select("doc_id").distinct().withColumn("is_target", F.lit(True))
    if marks.count() <= BROADCAST_IDS:
        marks = F.broadcast(marks)
    marked = docs.join(marks, "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    blocks = _blocks(marked, min(BLOCK_CHARS, chars // partitions + 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from send_block(number, pa.ipc.open_stream(packed.as_buffer()).read_all()).to_batches()

    def send_block(number: int, rows: pa.Table) -> pa.Table:
        block = Block(rows.column("text").to_pylist(), number_of(), buckets, hot)
        target = np.array(rows.column("is_target").to_pylist(), dtype=bool)[block.doc]
        order, out = block.pair_order, []
        n = [np.bincount(block.pair[target], minlength=len(block.n)).astype(np.uint32)[order], block.n.astype(np.uint32)[order]]
        x, y = block.words[block.first][order], block.words[block.second][order]
        for bucket, cut in _slices(block.pair_bucket[order]):
            out.append((bucket, number, _zip(x[cut]), y[cut].tobytes(), _zip(n[0][cut]), _zip(n[1][cut])))
        count = lambda at: np.bincount(at, minlength=len(block.words))
        follows, leads = block.at[block.next], block.at[block.next - 1]
        counts = np.stack([count(follows[target]), count(follows), count(leads[target]), count(leads)])[:, block.word_order]
        words = block.words[block.word_order]
        for bucket, cut in _slices(block.word_bucket[block.word_order]):
            out.append((buckets + bucket, number, words[cut].tobytes(), _zip(counts[:, cut].astype(np.int64)), b"", b""))
        return _table(out, _SENT)

    def add(parts: pa.Table) -> pa.Table:
        bucket = parts.column("bucket")[0].as_py()
        rows = _sum_bigrams(parts, bucket, buckets) if bucket < buckets else _sum_words(parts, bucket - buckets)
        return _table(rows, _SUMMED)

    sent = blocks.mapInArrow(send, "bucket long, block long, x binary, y binary, n0 binary, n1 binary")
    summed = stored(sent.groupBy("bucket").applyInArrow(add, _SUMMED_SQL), "bigrams")
    totals = summed.where(F.col("kind") == WORDS).agg(F.sum("n0"), F.sum("n1"), F.sum("words")).first()
    n_tokens = (totals[0] or 0, totals[1] or 0)
    entries = size or (totals[2] or 0) + 2
    matched = (1.0, n_tokens[0] / n_tokens[1] if n_tokens[0] else 1.0)

    def tell(parts: pa.Table) -> pa.Table:
        """Each block's words with their counts as next word, as first word, and the sum and number of their bigrams' counts."""
        rows = sorted(parts.select(["kind", "at", "part", "x", "y"]).to_pylist(), key=lambda r: (r["kind"], r["part"]))
        words = np.frombuffer(_unzip(rows[0]["x"]), np.int64)
        stats = np.zeros((8, len(words)), dtype=np.int64)
        stats[:4] = np.frombuffer(_unzip(rows[0]["y"]), np.int64).reshape(4, -1)
        for r in rows:
            if r["kind"] == COUNTS:
                model = r["part"] % 2
                seen, times = np.frombuffer(_unzip(r["y"]), np.int64).reshape(2, -1)
                at = np.searchsorted(words, np.frombuffer(_unzip(r["x"]), np.int64))
                np.add.at(stats[4 + model], at, seen * times)
                np.add.at(stats[6 + model], at, times)
        return _table([(r["part"], WORDS, r["at"], _zip(stats[:, np.frombuffer(_unzip(r["x"]), np.uint32)]), b"")
                       for r in rows if r["kind"] == ASKED], _ANSWER)

    about_words = summed.where(F.col("kind") != ANSWERS).groupBy("at").applyInArrow(
        tell, "block long, kind long, part long, x binary, y binary")
    answers = (summed.where(F.col("kind") == ANSWERS).select(F.col("at").alias("block"), "kind", "part", "x", "y")
               .unionByName(about_words))

    def judge(packed: pa.Table, told: pa.Table) -> pa.Table:
        rows = pa.ipc.open_stream(packed.column("docs")[0].as_buffer()).read_all()
        block = Block(rows.column("text").to_pylist(), number_of(), buckets, hot)
        told = told.sort_by([("kind", "ascending"), ("part", "ascending")])
        kinds = np.array(told.column("kind").to_pylist(), dtype=np.int64)
        about = told.filter(pa.array(kinds == WORDS))
        stats = np.zeros((8, len(block.words)))
        parts = [np.frombuffer(_unzip(x), np.int64).reshape(8, -1) for x in about.column("x").to_pylist()]
        stats[:, block.word_order] = np.concatenate(parts, axis=1)
        pairs = told.filter(pa.array(kinds == ANSWERS))
        means = []
        for model, name in enumerate(("x", "y")):
            counts = np.empty(len(block.n), dtype=np.int64)
            counts[block.pair_order] = _joined(pairs.column(name), np.int64)
            scale = matched[model]
            single = (stats[model] * scale + 1) / (n_tokens[model] * scale + entries)
            total = stats[2 + model][block.first]
            some = np.where(total > 0, total, 1.0)
            kept = stats[4 + model] - stats[6 + model] * DISCOUNT
            left = np.where(total > 0, 1 - kept[block.first] / some, 1.0)
            loss = -np.log(np.maximum(counts - DISCOUNT, 0) / some + left * single[block.second])
            sums = np.bincount(block.doc, loss[block.pair], minlength=rows.num_rows)
            means.append([s / n if n else None for s, n in zip(sums.tolist(), block.n_tokens.tolist(), strict=True)])
        score = [None if t is None else t - b for t, b in zip(*means, strict=True)]
        return pa.Table.from_arrays(
            [rows.column("doc_id"), pa.array(block.n_tokens, pa.int64()), *[pa.array(v, pa.float64()) for v in (*means, score)]],
            ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        judge, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
