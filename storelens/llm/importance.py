"""Importance resampling towards a target distribution, over hashed n-gram features.

A feature is a run of consecutive words joined by one space; its bucket is the CRC-32 of
its UTF-8 bytes modulo the number of buckets. A document is scanned once: its words,
joined by one space, run through one CRC whose value is stored at each word's begin and
end. The CRC of any run of words then follows from two stored values: shifting the one
at its begin over the run's length (multiplying by a power of x in GF(2)) and adding it
to the one at its end cancels all that stands before.

A bucket's gain is 1000 times the log of its smoothed share of the target's features
against that of all documents', floored. A document's weight is the floored mean of its
features' gains; Gumbel noise from a hash of its doc_id turns the highest scores into a
draw without replacement, with chances in proportion to exp(weight / 1000).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.ascii_words import blocks, words_of
from storelens.llm.common import bounded_batches, stored

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024

#: CRC-32 in its reflected form.
_POLYNOMIAL = 0xEDB88320


def _by_bytes(images: list[int]) -> np.ndarray:
    """A linear map of 32 bits, given by the images of its bits, as one table of 256 entries for each byte."""
    tables = np.zeros((4, 256), dtype=np.uint32)
    for byte in range(4):
        for bit in range(8):
            tables[byte, 1 << bit:2 << bit] = tables[byte, :1 << bit] ^ np.uint32(images[8 * byte + bit])
    return tables


def _mapped(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16 & 255] ^ tables[3][x >> 24])


def _zero_byte() -> list[int]:
    """Images of the 32 bits when a register runs over one zero byte."""
    images = []
    for bit in range(32):
        x = 1 << bit
        for _ in range(8):
            x = x >> 1 ^ (_POLYNOMIAL if x & 1 else 0)
        images.append(x)
    return images


def _shifts(n: int) -> list[np.ndarray]:
    """Maps over 1, 2, 4, ... zero bytes, each the square of the one before."""
    maps = [_by_bytes(_zero_byte())]
    while len(maps) < n:
        maps.append(_by_bytes(_mapped(maps[-1], _mapped(maps[-1], np.uint32(1) << np.arange(32, dtype=np.uint32))).tolist()))
    return maps


_SHIFTS = _shifts(40)


def shifted(x: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC values ``x``, each run over its number of zero bytes."""
    x, left, k = x.copy(), np.asarray(n_bytes, dtype=np.int64), 0
    while len(left) and left.max() >> k:
        on = np.flatnonzero(left >> k & 1)
        x[on] = _mapped(_SHIFTS[k], x[on])
        k += 1
    return x


def prefix_crcs(words: list[bytes]) -> list[int]:
    """Running CRC at the end of each word of the text in which a space stands before each; 0 first."""
    return list(accumulate(words, lambda c, w: crc32(w, crc32(b" ", c)), initial=0))


class Features:
    """Hashed n-gram features of some texts: ``bucket``, and for each text its first entry (``first``, plus the end)."""

    def __init__(self, texts: list[bytes | None], shortest: int, longest: int, buckets: int):
        ends, lengths, n_words = [], [], []
        for text in texts:
            words = words_of(text)
            n_words.append(len(words))
            ends.extend(prefix_crcs(words))
            lengths.append(0)  # the empty prefix
            lengths.extend(map(len, words))
        self.n_words = np.array(n_words, dtype=np.int64)
        crc, size = np.array(ends, dtype=np.uint32), np.array(lengths, dtype=np.int64)
        text_of = np.repeat(np.arange(len(texts)), self.n_words + 1)
        # A run begins behind the space that follows the prefix before it.
        space = np.full(len(crc), crc32(b" "), dtype=np.uint32)
        begin = shifted(crc, np.ones(len(crc), dtype=np.int64)) ^ space
        up_to = np.cumsum(size + 1)
        found, of = [], []
        for n in range(shortest, longest + 1):
            at = np.flatnonzero(text_of[n:] == text_of[:len(text_of) - n]) if len(crc) > n else np.zeros(0, dtype=np.int64)
            run = up_to[at + n] - up_to[at] - 1  # bytes of n words and the spaces between them
            found.append((crc[at + n] ^ shifted(begin[at], run)) % np.uint32(buckets))
            of.append(text_of[at])
        order = np.argsort(np.concatenate(of), kind="stable") if len(of) > 1 else slice(None)
        self.bucket = np.concatenate(found)[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(np.concatenate(of), minlength=len(texts)))))


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def features(docs: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of ``docs(doc_id, text)``: the bucket numbers as packed unsigned integers.

    A null or empty text, or one without words, has no feature. Other columns are not read; repeated rows stay.
    """
    if not 1 <= shortest <= longest or buckets < 1:
        raise ValueError("n-grams of at least one word and at least one bucket are needed")
    bounded_batches(docs.sparkSession)
    width = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch.column(1)):
                f = Features(texts, shortest, longest, buckets)
                raw = f.bucket.astype(width).tobytes()
                cuts = (f.first * width().itemsize).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(f.n_words), pa.array(np.diff(f.first)), packed],
                    ["doc_id", "n_words", "n_features", "buckets"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many of the features of ``found(buckets)`` fall into each bucket, summed on Spark; ``buckets`` numbers come back."""
    width = _width(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                if len(own := np.frombuffer(raw.as_buffer(), width)):
                    total += np.bincount(own, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.collect():  # a row a bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(of_all: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets, in doubles."""
    n, every, target = len(of_all), float(of_all.sum()), float(of_target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (every + n) / ((s + 1.0) * (target + n))))
                     for s, t in zip(of_all.tolist(), of_target.tolist(), strict=True)], dtype=np.int64)


def _weighed(found: DataFrame, gains: np.ndarray) -> DataFrame:
    shared, width = found.sparkSession.sparkContext.broadcast(gains), _width(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for raw in batch.column("buckets"):
                own = np.frombuffer(raw.as_buffer(), width)
                weights.append(int(shared.value[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _noise(seed: int):
    """floor(-1000 ln(-ln(u))) with u in (0, 1) from the SHA-256 of seed and doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296))).cast("long")


def ranked(scored: DataFrame, taking_part, percent: int) -> DataFrame:
    """Stored ``scored(doc_id, score, ...)`` with ``rank``: 1, 2, 3, ... for the floor(percent N / 100) highest scores.

    N counts the rows where ``taking_part`` holds; equal scores are drawn by ascending doc_id. Other rows have a null
    rank. Scores are whole numbers from a narrow range (log ratios and noise in thousandths: about 100,000 values at
    any input size), so a table of rows per score finds the last drawn score, and only rows of one score are sorted
    together; the noise keeps less than one in 2000 rows on one score.
    """
    spark = scored.sparkSession
    each = sorted(((r.score, r["count"]) for r in scored.where(taking_part).groupBy("score").count().collect()), reverse=True)
    wanted, before, drawn = sum(n for _, n in each) * percent // 100, 0, []
    for score, n in each:
        if before >= wanted:
            break
        drawn.append((score, before))
        before += n
    cut = F.lit(drawn[-1][0] if drawn else None).cast("long")
    high = taking_part & F.coalesce(F.col("score") >= cut, F.lit(False))
    offsets = spark.createDataFrame(drawn, "score long, before long")
    place = F.row_number().over(Window.partitionBy("score").orderBy("doc_id")) + F.col("before")
    top = (scored.where(high).join(F.broadcast(offsets), "score").withColumn("rank", place.cast("long"))
           .withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).drop("before"))
    return top.select(*scored.columns, "rank").unionByName(
        scored.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` as (doc_id, n_features, weight, score, rank, n_words).

    ``target(text)`` shows the wanted distribution. ``rank`` numbers the drawn documents, ``percent`` of those with at
    least ``min_words`` words, by descending score; it is null for the others. Null and empty texts, and texts without
    words: no feature, weight 0, scored but (under ``min_words``) not drawn. Rows without a doc_id have no noise: score
    and rank are null and they don't count among those to draw from. Repeated rows are rows of their own. Very long
    texts are taken whole. Without target texts every bucket's gain falls with its count; an empty ``docs`` gives an
    empty result. Other columns, whatever their names, are not read.
    """
    found = stored(features(docs, shortest, longest, buckets), "features")
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), shortest, longest, buckets)
    gains = bucket_gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    scored = stored(_weighed(found, gains).withColumn("score", F.col("weight") + _noise(seed)), "scored")
    taking_part = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    return ranked(scored, taking_part, percent).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
