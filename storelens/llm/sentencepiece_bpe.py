"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For every prefix of a text the table holds the last token of that prefix's encoding.
It is unique: a token that ends there (found by an automaton over the vocabulary) is
the one if it is compatible with the last token of the prefix before it, i.e. if
merging the two tokens' characters gives just these two tokens. The ids are then
read backwards from the end of the table.

The vocabulary has no piece in which a space follows another character, so a text is
cut before each run of spaces and every distinct part is encoded once.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import bounded_batches

SPACE = "▁"
_MARKS = ".,;:!?"

#: Parts and token pairs that a task remembers; the memory is emptied beyond.
REMEMBERED_PARTS, REMEMBERED_PAIRS = 600_000, 500_000


class PrefixTable:
    """Encoder and decoder of one vocabulary file (a path that the tasks can open)."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.end_id = model.eos_id()
        self.ids, self.scores, self.bytes_of = {}, {}, []
        self.byte_ids = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i):
                self.bytes_of.append(b"")
            elif model.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.cut = self._cutter()
        self.found = ahocorasick.Automaton()
        for piece in self.ids:
            self.found.add_word(piece, piece)
        self.found.make_automaton()
        self.between = next(c for c in "\n\0\x1e" if c not in self.ids and not any(c in p for p in self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        #: The decimals of a part's ids, and what the ids decode to.
        self.decimals: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        self.tokens = {p: b"%d" % i for p, i in self.ids.items()}
        self.texts = {p: self.bytes_of[i] for p, i in self.ids.items()}
        self.cut = self._cutter()
        self.found = ahocorasick.Automaton()
        for piece in self.ids:
            self.found.add_word(piece, piece)
        self.found.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, tuple[int, bytes, bytes, np.ndarray]] = {}

    def _cutter(self) -> re.Pattern:
        """Finds the parts of a text: cuts where two characters stand that no piece holds side by side."""
        beside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(b == SPACE != a for a, b in beside):
            raise ValueError("a piece goes across a space; texts can't be cut there")
        marks = "".join(m for m in _MARKS if not any(b == m and a.isalnum() for a, b in beside))
        line = "" if any("\n" in p for p in self.ids) else "\n"
        stop = f"(?=[{SPACE}{line}]|$)"
        forms = [f"{SPACE}*[^{SPACE}{line}]+", f"{SPACE}+"]
        if line:
            forms.insert(0, line)
        if marks:  # a word without the marks after it, then marks alone
            forms = [f"{SPACE}*[^\\W_]+(?=[{marks}{SPACE}{line}]|$)", f"[{marks}]+{stop}", *forms]
        return re.compile("|".join(forms))

    def merged(self, text: str) -> list[str]:
        """Characters merged pair by pair, best score first, leftmost among equals: the definition."""
        at, scores = list(text), self.scores
        while len(at) > 1:
            best, where = None, -1
            for i in range(len(at) - 1):
                score = scores.get(at[i] + at[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if best is None:
                break
            at[where:where + 2] = [at[where] + at[where + 1]]
        return at

    def compatible(self, a: str, b: str) -> bool:
        """Whether the characters of the two tokens merge to just these two (of one: to itself)."""
        if len(self.pairs) > REMEMBERED_PAIRS:
            self.pairs.clear()
        known = self.pairs[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def pieces(self, parts: list[str]) -> list[list[str]]:
        """The tokens of each part: prefix tables forwards, in one run of the automaton, then tokens backwards.

        Between two parts stands a character of no piece (nor of a part, unless it is the only one); its entry stays
        empty, so a part begins without a token before it. Characters outside the vocabulary are their own tokens.
        """
        text = self.between.join(parts)
        ends: dict[int, list[str]] = {}
        if len(parts) == 1 or not set(text) <= self.ids.keys() | {self.between}:
            if len(parts) > 1:
                return [self.pieces([p])[0] for p in parts]
            ends = {i: [c] for i, c in enumerate(text) if c not in self.ids}
        table, pairs, compatible = [""] * (len(text) + 1), self.pairs, self.compatible
        found = self.found.iter(text)
        if ends:
            for last, piece in found:
                ends.setdefault(last, []).append(piece)
            found = ((last, piece) for last in sorted(ends) for piece in ends[last])
        for last, piece in found:
            if not table[last + 1]:
                before = table[last + 1 - len(piece)]
                fits = pairs.get((before, piece))
                if compatible(before, piece) if fits is None else fits:
                    table[last + 1] = piece
        out, start = [], 0
        for part in parts:
            at, own = start + len(part), []
            while at > start:
                piece = table[at]
                if not piece:
                    raise ValueError("no token fits: not a merge vocabulary")
                own.append(piece)
                at -= len(piece)
            out.append(own[::-1])
            start += len(part) + 1
        return out

    def learn(self, parts: list[str]) -> None:
        alone = [p for p in parts if self.between in p]
        parts = [p for p in parts if self.between not in p]
        found = (self.pieces(parts) if parts else []) + [self.pieces([p])[0] for p in alone]
        for part, pieces in zip(parts + alone, found, strict=True):
            for p in pieces:
                if p not in self.tokens:  # a character outside the vocabulary: its bytes' ids
                    raw = p.encode("utf-8", "surrogatepass")
                    self.tokens[p], self.texts[p] = b" ".join([b"%d" % self.byte_ids[b] for b in raw]), raw
            self.decimals[part] = b" ".join([self.tokens[p] for p in pieces])
            self.decoded[part] = b"".join([self.texts[p] for p in pieces])

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """For each text the decimals of its ids, joined by spaces, and what these decode to with the first space."""
        if len(self.decimals) > REMEMBERED_PARTS:
            self.decimals.clear()
            self.decoded.clear()
        cut = [self.cut.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(list(set().union(*cut).difference(self.decimals)))
        decimals, decoded = self.decimals.__getitem__, self.decoded.__getitem__
        for c in cut:
            yield b" ".join(map(decimals, c)), b"".join(map(decoded, c))

    def decode(self, ids) -> str:
        """Text of ids: pieces joined, the first space dropped, bytes read as UTF-8."""
        raw = b"".join([self.bytes_of[i] for i in ids])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=1)
def prefix_table(model: str) -> PrefixTable:
    """One table a worker process, with what it has learned, for all the tasks that it runs."""
    return PrefixTable(model)


def _blocks(column: pa.Array, rows: int = 64) -> Iterator[list[str | None]]:
    for at in range(0, len(column), rows):
        yield column.slice(at, rows).to_pylist()


def sentencepiece_encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ``ids`` (array of int, with the end id only) of ``docs(doc_id, text)``; null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        end = table.end_id
        for batch in batches:
            ids = [np.array([*decimals.split(), end], dtype=np.int32)
                   for texts in _blocks(batch.column(1)) for decimals, _ in table.encoded(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def sentencepiece_decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and ``text`` of ``encoded(doc_id, ids)``; null ids: null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in batches:
            texts = [None if ids is None else table.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    bounded_batches(encoded.sparkSession)
    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def sentencepiece_digests(docs: DataFrame, model: str) -> DataFrame:
    """Encoding and decoding without moving ids: doc_id, n_tokens, ids_sha256, decoded_sha256 for each row.

    The ids are those of ``sentencepiece_encode``, the text that of ``sentencepiece_decode``. Null and empty texts
    are the end id alone; rows with a null doc_id stay; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        end = str(table.end_id).encode()
        for batch in batches:
            out = defaultdict(list)
            for texts in _blocks(batch.column(1)):
                for decimals, decoded in table.encoded(texts):
                    ids = decimals + b" " + end if decimals else end
                    out["n"].append(ids.count(b" ") + 1)
                    out["ids"].append(hashlib.sha256(ids).hexdigest())
                    out["text"].append(hashlib.sha256(decoded.removeprefix(b" ")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n"], pa.int64()), pa.array(out["ids"], pa.string()),
                 pa.array(out["text"], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
