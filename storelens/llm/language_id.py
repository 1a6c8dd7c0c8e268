"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. A word that was never seen
falls back to its character n-grams, the longest length of which any is known; so down
to single letters. A text's language has the largest sum over its words. How familiar a
text is, the share of its words that are known or whose n-grams are, tells texts of a
learned language from others.

The model is fitted on a bounded sample of labelled rows (TRAINING_ROWS), which bounds it;
it keeps every word and every n-gram of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import bounded_batches, stored

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"

#: Labelled rows that a model is fitted on, about.
TRAINING_ROWS = 10_000

#: Character n-grams, longest first, of a word between marks of its ends.
GRAMS = (5, 4, 3, 2, 1)

#: Length of the n-grams by which an unknown word is more or less familiar.
FAMILIAR_GRAM = 4

_REMEMBERED = 200_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case: numerals of any script are none, and marks part words."""
    words = WORD.findall(text.lower()) if text else []
    if text and not text.isascii() and not all(map(str.isalpha, words)):  # numerals such as a half or a circled two
        words = "".join([c if c.isalpha() else " " for c in " ".join(words)]).split()
    return words


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


@dataclass
class Model:
    """Log frequencies for each language (columns) of words and, by length, of n-grams (rows)."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def scores(self, word: str) -> np.ndarray:
        at = self.words.get(word)
        if at is not None:
            return self.word_scores[at]
        for n in GRAMS:
            rows = [i for g in grams_of(word, n) if (i := self.grams.get(g)) is not None]
            if rows:
                return self.gram_scores[rows].mean(axis=0)
        return np.zeros(len(self.languages))

    def familiarity(self, word: str) -> float:
        """1 for a known word, else the share of its n-grams of FAMILIAR_GRAM letters (or all of them) that are known."""
        if word in self.words:
            return 1.0
        own = grams_of(word, min(FAMILIAR_GRAM, len(word) + 2))
        return sum(g in self.grams for g in own) / len(own)


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """All rows, or, if there are more than ``limit``, about that many chosen by the hash of ``key``."""
    n = rows.count()
    if n <= limit:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) < int((1 << 30) * limit / n))


def _log_frequencies(table: pa.Table, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies, in each row less their mean: what the item says about the language."""
    at = {item: k for k, item in enumerate(table.column("item").to_pylist())}
    counts = np.zeros((len(at), len(languages)))
    if not at:
        return at, counts
    for k in range(len(languages)):
        counts[:, k] = table.column(f"n{k}").to_numpy()
    logs = np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 0.5 * max(1, len(at)))
    return at, logs - logs.mean(axis=1, keepdims=True)


def fit(labelled: DataFrame, key: str = "doc_id", rows: int = TRAINING_ROWS) -> Model:
    """From ``labelled(text, lang)``; ``key`` only chooses the sample of about ``rows`` rows, which bounds what is collected.

    Null or empty lang or text teaches nothing; repeated rows teach as often as they stand there. Without any labelled
    row the model has no language.
    """
    bounded_batches(labelled.sparkSession)
    sample = bounded_sample(labelled.where("text is not null and lang is not null and lang <> ''"), key, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.update((lang, w) for w in words_of(text))
        yield _rows(found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for size in GRAMS:
                    for g in grams_of(word, size):
                        found[lang, g] += n
            yield _rows(found)

    def _rows(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
             pa.array(list(found.values()), pa.int64())], ["lang", "item", "n"])

    schema = "lang string, item string, n long"
    words = sample.select("text", "lang").mapInArrow(count, schema).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    words = stored(words, "words")  # the sample's words: bounded
    grams = words.mapInArrow(cut, schema)
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())

    def all_of(table: DataFrame) -> pa.Table:
        own = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"n{k}")
               for k, lang in enumerate(languages)]
        return table.groupBy("item").agg(F.sum("n").alias("total"), *own).toArrow()  # the sample's items: bounded

    known, word_scores = _log_frequencies(all_of(words), languages)
    marks, gram_scores = _log_frequencies(all_of(grams), languages)
    return Model(languages, known, word_scores, marks, gram_scores)


def predict(docs: DataFrame, model: Model, with_familiarity: bool = False) -> DataFrame:
    """``docs`` (all its columns, one of them ``text``) with lang_pred and score, and on demand familiarity, added.

    score: the predicted language's share (0 to 1) after all words. familiarity: the mean over its words of how familiar
    they are (0 to 1). ``und`` with both 0: null and empty texts, texts without a letter, or a model without a language.
    Very long texts are read whole, repeated rows each, an empty table gives an empty one. Columns of these names in
    ``docs`` are replaced. Ties go to the language that sorts first.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score", *(["familiarity"] if with_familiarity else [])]
    docs = docs.drop(*added)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        more: dict[str, int] = {}  # words that the model doesn't know, as they are met: their places in the two lists
        extra: list[np.ndarray] = []
        familiar: list[float] = []
        table, known = model.word_scores, model.words
        for batch in batches:
            langs, scores, met = [], [], []
            for text in batch.column(text_at).to_pylist():
                words = words_of(text)
                if not words or not model.languages:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    met.append(0.0)
                    continue
                if len(extra) > _REMEMBERED:
                    more, extra, familiar = {}, [], []
                total, at, mean = np.zeros(len(model.languages)), [], 0.0
                for w in words:
                    k = known.get(w)
                    if k is not None:
                        at.append(k)
                        continue
                    k = more.get(w)
                    if k is None:
                        k = more[w] = len(extra)
                        extra.append(model.scores(w))
                        familiar.append(model.familiarity(w))
                    total = total + extra[k]
                    mean += familiar[k]
                total = total + table[at].sum(axis=0)
                best = int(np.argmax(total))
                langs.append(model.languages[best])
                scores.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
                met.append((len(at) + mean) / len(words))
            found = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(met, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found[:len(added)]], [*batch.schema.names, *added])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, schema + ", lang_pred string, score double" + ", familiarity double" * with_familiarity)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of a key's text, modulo: the fold that a row belongs to (null for a null key)."""
    return F.crc32(F.col(key).cast("string")) % modulus
