"""Toxic passages by maximum-scoring segments.

* A token's score is its log-odds between toxic and clean labelled documents with
  informative Dirichlet priors: a word's prior comes from its five-letter beginning,
  that one's from four letters, that one's from the rate over both classes. A level
  counts only where its log-odds are significant; otherwise the level above speaks.
  Every token pays DRIFT, so that scores are negative on average.
* One linear scan of a document finds all its maximal scoring segments.
* Extreme values calibrate them: on clean documents of n tokens the number of segments
  of at least score s is Poisson with mean K n exp(-L s). A document's evidence is the
  smallest chance, over its r best segments, of r segments that good; a one-variable
  logistic fit on the labelled sample turns it into a score between 0 and 1.

The labelled sample is bounded (TRAINING_ROWS a class), which bounds the token table; it
holds every token of the sample. The model keeps those that are significant.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import bounded_batches
from storelens.llm.language_id import WORD, bounded_sample

TRAINING_ROWS = 10_000

#: Strength of each prior in tokens, the z value that makes log-odds significant among many items, what each token pays.
PRIOR, SIGNIFICANT, DRIFT = 20.0, 4.3, 1.0
BEGINNINGS = (5, 4)

#: Best segments whose joint chance counts; expected clean segments of that score that a passage may have at most.
BEST, PASSAGE_E = 5, 0.01

_REMEMBERED = 200_000


def items_of(word: str) -> list[str]:
    """A word and its beginnings, marked, from the special to the general."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]]


def log_odds(counts: dict[str, tuple[int, int]], tokens: tuple[int, int]) -> dict[str, float]:
    """Score of each item: log-odds (toxic against clean) where significant, else that of the item above."""
    clean_n, toxic_n = max(1, tokens[0]), max(1, tokens[1])
    out: dict[str, float] = {}
    rates: dict[str, tuple[float, float]] = {}

    def solve(item: str) -> tuple[float, tuple[float, float]]:
        if item in out:
            return out[item], rates[item]
        c0, c1 = counts[item]
        stem = item.rstrip("*")
        above = next((f"{stem[:n]}*" for n in BEGINNINGS if n < len(stem) and f"{stem[:n]}*" in counts), None)
        pooled = (c0 + c1) / (clean_n + toxic_n)
        if above is None:
            score, prior = 0.0, (pooled, pooled)
        else:
            score, (p0, p1) = solve(above)
            share = (c0 + c1) / sum(counts[above])
            prior = (p0 * share, p1 * share)
        a0, a1 = c0 + PRIOR * prior[0] * clean_n / (clean_n + PRIOR), c1 + PRIOR * prior[1] * toxic_n / (toxic_n + PRIOR)
        a0, a1 = max(a0, 0.5), max(a1, 0.5)
        rate = (a0 / (clean_n + PRIOR), a1 / (toxic_n + PRIOR))
        delta = math.log(rate[1] / (1 - rate[1])) - math.log(rate[0] / (1 - rate[0]))
        # likelihood ratio of the two counts against the classes' shares of all tokens, as a squared z value
        e0, e1 = pooled * clean_n, pooled * toxic_n
        ratio = 2 * ((c0 * math.log(c0 / e0) if c0 else 0.0) + (c1 * math.log(c1 / e1) if c1 else 0.0))
        out[item] = delta if ratio > SIGNIFICANT ** 2 else score
        rates[item] = rate
        return out[item], rate

    for item in sorted(counts, key=len):
        solve(item)
    return out


def _telling(scores: dict[str, float]) -> dict[str, float]:
    """The items whose score isn't that of the item above them: all that a token's score needs."""
    def above(item: str) -> float:
        stem = item.rstrip("*")
        return next((scores[f"{stem[:n]}*"] for n in BEGINNINGS if n < len(stem) and f"{stem[:n]}*" in scores), 0.0)

    return {item: s for item, s in scores.items() if s != above(item)}


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), in one scan: Ruzzo and Tompa's rules."""
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum at the end
    for i in np.flatnonzero(scores > 0).tolist():
        first, end, low, high = i, i + 1, sums[i], sums[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, end, low, high))
    return [(a, b, float(h - l)) for a, b, l, h in found]


@dataclass
class Model:
    """Token scores, the extreme-value parameters and the logistic curve."""

    scores: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    curve: tuple[float, float] = (-5.0, 1.0)
    _own: dict[str, float] = field(default_factory=dict)

    def token(self, word: str) -> float:
        s = self._own.get(word)
        if s is None:
            if len(self._own) > _REMEMBERED:
                self._own.clear()
            s = self._own[word] = next((self.scores[i] for i in items_of(word) if i in self.scores), 0.0) - DRIFT
        return s

    def scan(self, words: list[str]) -> list[tuple[int, int, float]]:
        token, own = self.token, self._own
        return segments(np.array([own[w] if w in own else token(w) for w in words]))

    def expected(self, n: int, score: float) -> float:
        return self.scale * n * math.exp(-min(700.0, self.rate * score))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """-log10 of the smallest chance that clean text of n tokens has r segments as good as the r-th best."""
        best = 0.0
        for r, score in enumerate(sorted((s for _, _, s in found), reverse=True)[:BEST], 1):
            mean = self.expected(n, score)
            log = r * math.log(max(mean, 1e-300)) - math.lgamma(r + 1) if mean < 0.1 else \
                math.log(max(1e-300, 1 - sum(math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(r))))
            best = max(best, -log / math.log(10))
        return min(best, 50.0)

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.curve[0] + self.curve[1] * evidence))))


def _root(token_scores: np.ndarray, weights: np.ndarray) -> float:
    """L > 0 with the clean tokens' mean of exp(L s) equal to one."""
    if not len(token_scores) or token_scores.max() <= 0:
        return 1.0
    low, high = 1e-6, 1.0
    p = weights / weights.sum()
    value = lambda x: float((p * np.exp(np.minimum(700, x * token_scores))).sum())
    while value(high) < 1 and high < 50:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)
    return high


def _curve(evidence: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of the label on the evidence, with a small ridge so that separable labels stay finite."""
    x = np.stack([np.ones_like(evidence), evidence], axis=1)
    w, ridge = np.zeros(2), np.array([1e-3, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge),
                               x.T @ (weights * (labels - p)) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """From ``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` (0 or 1; null teaches nothing).

    At most about ``rows`` labels of each class are used, chosen by the hash of their doc_id; that bounds what is
    broadcast and collected. In the curve each class weighs as much as all its labels, so that the sampling does not
    move the scores. Without labels of both classes every document scores below one half.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("y"))
    own = own.groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = bounded_sample(own.where("y = 1"), "doc_id", rows).unionByName(
        bounded_sample(own.where("y = 0"), "doc_id", rows))
    counts_of = lambda df: {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    labels_of, used = counts_of(own), counts_of(chosen)
    weight = {y: labels_of[y] / n for y, n in used.items()}
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")  # bounded above

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[y].update(WORD.findall((text or "").lower()))
        for y, words in enumerate(found):
            items: Counter = Counter()
            for w, n in words.items():
                for item in items_of(w):
                    items[item] += n
            items[""] = sum(words.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(items), pa.string()), pa.array([(1 - y) * n for n in items.values()], pa.int64()),
                 pa.array([y * n for n in items.values()], pa.int64())], ["item", "clean", "toxic"])

    table = (sample.mapInArrow(count, "item string, clean long, toxic long").groupBy("item")
             .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    every = table.toArrow()  # the sample's items: bounded
    counts = dict(zip(every.column("item").to_pylist(),
                      zip(every.column("clean").to_pylist(), every.column("toxic").to_pylist(), strict=True), strict=True))
    tokens = counts.pop("", (0, 0))
    if not all(tokens):
        return Model({})
    scores = log_odds(counts, tokens)
    model = Model(_telling(scores))
    words = [i for i in counts if not i.endswith("*")]
    model.rate = _root(np.array([scores[w] - DRIFT for w in words]), np.array([counts[w][0] for w in words], float) + 1e-9)
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                words = WORD.findall((text or "").lower())
                out.append((len(words), sorted([s for _, _, s in shared.value.scan(words)], reverse=True)[:BEST]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n for n, _ in out], pa.int64()),
                 pa.array([s for _, s in out], pa.list_(pa.float64()))], ["y", "n", "best"])

    seen = sample.mapInArrow(measure, "y int, n long, best array<double>").collect()  # the bounded sample
    clean = [r for r in seen if not r.y and r.n]
    mass = sum(r.n * math.exp(-min(700.0, model.rate * (r.best[0] if r.best else 0.0))) for r in clean)
    model.scale = len(clean) / mass if mass else 1.0  # the most likely K of the Gumbel law of clean maxima
    evidence = np.array([model.evidence(r.n, [(0, 0, s) for s in r.best]) if r.n else 0.0 for r in seen])
    model.curve = _curve(evidence, np.array([r.y for r in seen], float), np.array([weight[r.y] for r in seen], float))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (all its columns, one of them ``text``) with toxicity and toxic_passages added.

    toxicity: 0 to 1. toxic_passages: the significant segments as character ranges (begin, end) of the text, with
    their score and the number of such segments to expect in clean text of that length. Texts without words, empty
    or null: the lowest score, no passage. Very long texts are read whole, repeated rows each, an empty table gives an
    empty one. Columns of these names in ``docs`` are replaced.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("toxicity", "toxic_passages")
    at = docs.columns.index("text")
    passage = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(at).to_pylist():
                words = WORD.findall(text.lower()) if text else []
                found = model.scan(words) if words else []
                scores.append(model.score(model.evidence(len(words), found) if found else 0.0))
                own = [(a, b, s, model.expected(len(words), s)) for a, b, s in found]
                own = [p for p in own if p[3] <= PASSAGE_E]
                spans = [m.span() for m in WORD.finditer(text.lower())] if own else []
                passages.append([{"begin": spans[a][0], "end": spans[b - 1][1], "score": s, "expected": e}
                                 for a, b, s, e in own])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(passages, pa.list_(passage))],
                [*batch.schema.names, "toxicity", "toxic_passages"])

    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, schema + ", toxicity double, toxic_passages "
                           "array<struct<begin: long, end: long, score: double, expected: double>>")
