"""Removal of repeated passages by sliding sentence spans.

A text is cut into sentences: at sentence ends of any script, at line ends, and inside a
sentence where a hash of the last two words meets a condition, so that a passage is cut
alike wherever it stands and however it is fused with the text around it. Every run of
RUN consecutive sentences, extended until it has MIN_WORDS words, is hashed. Runs meet by
hash over all documents. All but the first occurrence (smallest doc_id, then position) of
a run are repeats, and sentences that a repeat covers go.

Words are separated by white space; in scripts written without spaces every character is
a word. Blocks of texts are cut and hashed together, as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.ascii_words import blocks
from storelens.llm.common import BROADCAST_IDS, bounded_batches, stored
from storelens.llm.shingles import byte_numbers, mix, span_hashes

#: Sentences in a run and words that it must have.
RUN, MIN_WORDS = 3, 20

#: One pair of words in so many ends a part of a sentence; words after which a part ends in any case.
CUT_ONE_IN, LONGEST = 4, 32

# What ends a sentence in some script, and what may close it after that.
ENDS = ".!?…。！？｡।॥؟۔։።។။།"
CLOSERS = "\"')]}"

# First and last character of the scripts that are written without spaces (Thai to Lao, Myanmar, Khmer,
# CJK punctuation and kana, the CJK ideographs with their extensions, compatibility and full-width forms).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
            (0xF900, 0xFAFF), (0xFF00, 0xFFEF), (0x20000, 0x3FFFF))

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII_END, _ASCII_CLOSER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_ASCII_END[[ord(c) for c in ENDS if ord(c) < 128]] = True
_ASCII_CLOSER[[ord(c) for c in CLOSERS]] = True
_LONG_ENDS = np.array(sorted(int.from_bytes(c.encode(), "big") for c in ENDS if ord(c) >= 128), dtype=np.int64)
_PAIR = np.uint64(0xD6E8FEB86659FD93)


class Sentences:
    """The sentences of a block of texts: ``start`` and ``end`` of their words, where their parts begin, whose they are."""

    def __init__(self, texts: list[bytes | None]):
        joined = [t or b"" for t in texts]
        data = np.frombuffer(b" ".join(joined) + b" ", dtype=np.uint8)
        lengths = np.array([len(t) + 1 for t in joined], dtype=np.int64)
        self.text_start = np.cumsum(lengths) - lengths
        self.start, self.end = self._words(data)
        self.hashes = span_hashes(byte_numbers(data), self.start, self.end)
        word_text = np.searchsorted(self.text_start, self.start, side="right") - 1
        n = len(self.start)
        last = np.ones(n, dtype=bool)  # of its text
        last[:-1] = word_text[1:] != word_text[:-1]
        ends = last | self._sentence_ends(data)
        pair = np.zeros(n, dtype=bool)
        pair[1:] = mix(self.hashes[:-1] * _PAIR + self.hashes[1:]) % np.uint64(CUT_ONE_IN) == 0
        pair[1:] &= ~last[:-1]
        cuts = np.flatnonzero(ends | pair) + 1
        self.word = self._no_longer(np.concatenate(([0], cuts)) if n else np.zeros(1, dtype=np.int64))
        self.n_parts = len(self.word) - 1  # part k has the words word[k] to word[k + 1]
        self.text = word_text[self.word[:-1]] if n else np.zeros(0, dtype=np.int64)
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))  # parts of each text

    @staticmethod
    def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = ~_SPACE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        stops = ~inside
        stops[1:] &= inside[:-1]
        stops[0] = False
        lead = np.flatnonzero(data >= 0xE0)
        if len(lead):  # characters of three or four bytes: those of unspaced scripts are words of their own
            wide = data[lead] >= 0xF0
            at = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
            code = np.where(wide, (data[lead].astype(np.int64) & 7) << 18 | at[0] << 12 | at[1] << 6 | at[2],
                            (data[lead].astype(np.int64) & 15) << 12 | at[0] << 6 | at[1])
            alone = np.zeros(len(lead), dtype=bool)
            for low, high in UNSPACED:
                alone |= (code >= low) & (code <= high)
            own, after = lead[alone], lead[alone] + 3 + wide[alone]
            glued = own[inside[own - 1] & (own > 0)]  # a word ends where such a character follows at once
            begins[own] = True
            stops[glued] = True
            stops[after] = True
            begins[after[inside[after]]] = True
        return np.flatnonzero(begins), np.flatnonzero(stops)

    def _sentence_ends(self, data: np.ndarray) -> np.ndarray:
        at = self.end - 1
        long = self.end - self.start > 1
        at = np.where(long & _ASCII_CLOSER[data[at]], at - 1, at)
        found = _ASCII_END[data[at]]
        some = np.flatnonzero(data[at] >= 0x80)
        if len(some):
            b = [data[np.maximum(at[some] - k, 0)].astype(np.int64) for k in (0, 1, 2)]
            three, two = b[2] << 16 | b[1] << 8 | b[0], b[1] << 8 | b[0]
            found[some] |= np.isin(three, _LONG_ENDS) | np.isin(two, _LONG_ENDS)
        line = np.concatenate(([0], np.cumsum(data == 0x0A)))
        found[:-1] |= line[self.start[1:]] > line[self.end[:-1]]
        return found

    @staticmethod
    def _no_longer(word: np.ndarray) -> np.ndarray:
        """Parts of more than LONGEST words are cut again, counted from their begin."""
        pieces = -(-np.diff(word) // LONGEST)
        if not len(pieces) or pieces.max() <= 1:
            return word
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        return np.append(np.repeat(word[:-1], pieces) + nth * LONGEST, word[-1])

    def runs(self, run: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first part, end, hash) of every run, the shortest from each part; by first part."""
        a = np.arange(self.n_parts)
        b = np.maximum(a + run, np.searchsorted(self.word, self.word[:-1] + min_words))
        whole = b <= self.first[self.text + 1]
        a, b = a[whole], b[whole]
        return a, b, span_hashes(self.hashes, self.word[a], self.word[b]).view(np.int64)

    def bounds(self, text: int, length: int) -> np.ndarray:
        """Byte offsets in a text where its parts begin, and its end; together the parts cover it."""
        own = self.start[self.word[self.first[text]:self.first[text + 1]]] - self.text_start[text]
        out = np.append(own, length)
        out[0] = 0
        return out


def _dropped(a: np.ndarray, b: np.ndarray, h: np.ndarray, elsewhere: np.ndarray, n_parts: int) -> np.ndarray:
    """Which parts of one text go: those in runs met earlier elsewhere, and in later occurrences of its own runs."""
    _, first, group = np.unique(h, return_index=True, return_inverse=True)  # runs are in order of their begin
    gone = np.isin(h, elsewhere)
    own_later = ~gone & (first[group] != np.arange(len(h)))
    low = np.where(own_later, np.maximum(a, b[first[group]]), a)  # what overlaps the kept first occurrence stays
    use = (gone | own_later) & (low < b)
    steps = np.bincount(low[use], minlength=n_parts + 1) - np.bincount(b[use], minlength=n_parts + 1)
    return np.cumsum(steps)[:n_parts] > 0


def deduplicate_passages(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (all its columns; doc_id and text among them) with repeats gone from ``text``, and two columns more.

    n_removed (sentences) and removed: the removed character ranges (begin, end) of the original text. A text that
    loses all its sentences becomes empty, its row stays. Null texts stay null; empty ones have no sentence. Rows
    that share a doc_id count as one document: none of them loses what only they share; rows without a doc_id
    are one, before all others. Very long texts are taken whole; an empty table gives an empty one. Columns of the new
    names in ``docs`` are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop("n_removed", "removed")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for part, texts in blocks(batch.column(1)):
                cut = Sentences(texts)
                a, _, h = cut.runs(run, min_words)
                text = cut.text[a]
                order = np.lexsort((h, text))
                text, h = text[order], h[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
                at = np.flatnonzero(new)
                again = np.diff(np.append(at, len(h))) > 1
                yield pa.RecordBatch.from_arrays([pa.array(ids[part][text[at]]), pa.array(h[at]), pa.array(again)],
                                                 ["id", "h", "again"])

    # Occurrences within one document are told apart where it is cut, below; here a run counts once for each.
    met = stored(docs.select(key.alias("id"), "text").mapInArrow(spans, "id long, h long, again boolean"), "runs")
    # Both steps shuffle the runs by hash at any size; partial counts and split partitions spare a run met very often.
    several = stored(met.groupBy("h").agg(F.min("id").alias("low"), F.count("*").alias("times")).where("times > 1")
                     .select("h", "low"), "repeats")
    repeated = stored(met.join(several.hint("shuffle_hash"), "h").where("id > low").select("id", "h")
                      .unionByName(met.where("again").select("id", F.lit(None).cast("long").alias("h")).distinct())
                      .groupBy("id").agg(F.collect_set("h").alias("hashes")), "repeated")

    names = docs.columns
    text_at = names.index("text")
    keyed = docs.select(key.alias("__id"), "*")
    of_id = repeated.select(F.col("id").alias("__id"), F.col("hashes").alias("__hashes"))
    ids = of_id.select("__id")
    if repeated.count() <= BROADCAST_IDS:  # documents without a repeat need not move
        untouched = keyed.join(F.broadcast(ids), "__id", "left_anti").drop("__id")
        joined = keyed.join(F.broadcast(ids), "__id", "left_semi").join(of_id.hint("shuffle_hash"), "__id").drop("__id")
    else:
        untouched = None
        joined = keyed.join(of_id.hint("shuffle_hash"), "__id", "left").drop("__id")
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch.column(text_at)):
                hashes = batch.column(len(names))[part].to_pylist()
                out, gone, ranges = [], [], []
                known = Sentences([t if h is not None else None for t, h in zip(texts, hashes, strict=True)])
                a, b, h = known.runs(run, min_words)
                of_text = np.searchsorted(known.text[a], np.arange(len(texts) + 1))
                for k, (text, elsewhere) in enumerate(zip(texts, hashes, strict=True)):
                    here, first = slice(of_text[k], of_text[k + 1]), known.first[k]
                    n_parts = int(known.first[k + 1] - first)
                    drop = _dropped(a[here] - first, b[here] - first, h[here], np.array(elsewhere or [], dtype=np.int64),
                                    n_parts) if text and elsewhere is not None else np.zeros(0, dtype=bool)
                    gone.append(int(drop.sum()))
                    if not gone[-1]:
                        out.append(text)
                        ranges.append([])
                        continue
                    bounds = known.bounds(k, len(text))
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], drop, [False])).astype(np.int8)))
                    cuts = [(int(bounds[x]), int(bounds[y])) for x, y in zip(edge[::2], edge[1::2], strict=True)]
                    kept, chars, at, place = [], [], 0, 0
                    for x, y in cuts:
                        kept.append(text[at:x])
                        begin = place + len(kept[-1].decode())
                        place = begin + len(text[x:y].decode())
                        chars.append({"begin": begin, "end": place})
                        at = y
                    out.append(b"".join([*kept, text[at:]]))
                    ranges.append(chars)
                columns = [c[part] for c in batch.columns[:-1]]
                columns[text_at] = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64()), pa.array(ranges, pa.list_(span))],
                                                 [*names, "n_removed", "removed"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    result = joined.mapInArrow(cut, schema + ", n_removed long, removed array<struct<begin: long, end: long>>")
    if untouched is None:
        return result
    return result.unionByName(untouched.withColumn("n_removed", F.lit(0).cast("long")).withColumn(
        "removed", F.array().cast("array<struct<begin: long, end: long>>")))
