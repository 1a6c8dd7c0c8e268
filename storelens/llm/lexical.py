"""Ranked lexical search over posting lists in geometric blocks.

A document's vector holds, for each asked term, a whole number that grows with the term's
occurrences and shrinks with the document's length; an item's score is the sum of these
times the terms' weights. Documents fall into shards. In a shard each term's posting list
is clustered by the similarity of its documents (few centroids from the list, nearest by
projected cosine), and the clusters are cut into blocks. A block's summary holds, for each
term, the largest number of any of its documents.

An item visits the blocks of its own terms' lists in the order of their bounds: the sum of
weights times the summary is the most that any document in the block can score, exactly,
in whole numbers. A block is skipped only if its bound is below the score of the item's
k-th best document so far; all documents of other blocks are scored in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.ascii_words import blocks, words_of
from storelens.llm.common import bounded_batches, stored

TOP, LENGTH_PERCENT, SATURATION_TENTHS = 20, 25, 12

#: Documents in a shard, and in a block at most; items are taken together up to so many bytes of text.
SHARD_DOCS, BLOCK_DOCS, ITEM_BYTES = 2048, 64, 8_000_000

#: Dimensions of the projection that places documents for clustering; cells of a dense summary that is built at once.
_DIMENSIONS, _CELLS = 16, 1 << 22

#: Stands for a null doc_id while documents are sorted: behind all others.
_NO_ID = (1 << 63) - 1


def item_terms(items: DataFrame) -> list[tuple[int | None, dict[bytes, int]]]:
    """The terms of each item of the bounded table ``items(item_id, text)``, counted; several texts of an item add up."""
    found: dict[int | None, dict[bytes, int]] = {}
    for r in items.distinct().collect():
        own = found.setdefault(r.item_id, {})
        for w in words_of((r.text or "").encode()):
            own[w] = own.get(w, 0) + 1
    return sorted(((i, own) for i, own in found.items() if own), key=lambda x: (x[0] is None, x[0] or 0))


def vectors_of(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, term, tf) of ``docs(doc_id, text)``: n counts all terms, term and tf list those among ``terms``."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, many = shared.value, max(1, len(shared.value))
        for batch in batches:
            for part, texts in blocks(batch.column(1)):
                n, hits, held = [], [], []
                for text in texts:
                    words = words_of(text)
                    n.append(len(words))
                    own = [number[w] for w in words if w in number]
                    hits.extend(own)
                    held.append(len(own))
                flat = np.repeat(np.arange(len(texts)), held) * many + np.array(hits, dtype=np.int64)
                keys, tf = np.unique(flat, return_counts=True)
                cuts = pa.array(np.searchsorted(keys, np.arange(len(texts) + 1) * many).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(cuts, pa.array((keys % many).astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, term array<int>, tf array<int>")


def term_weights(found: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(N, L, weights): documents with a term, all terms of all documents, and floor(1000 ln((2N + 2) / (2 df + 1)))."""
    one = found.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    held = np.zeros(n_terms, dtype=np.int64)
    for r in found.select(F.explode("term").alias("term")).groupBy("term").count().collect():  # a row an asked term
        held[r.term] = r["count"]
    weights = [math.floor(1000 * math.log((2 * one.docs + 2) / (2 * df + 1))) for df in held.tolist()]
    return one.docs, one.terms or 0, np.array(weights, dtype=np.int64)


@dataclass(frozen=True)
class Scoring:
    """All that a document's numbers depend on besides its own counts."""

    n_docs: int
    n_terms: int
    weights: np.ndarray
    length_percent: int = LENGTH_PERCENT
    saturation_tenths: int = SATURATION_TENTHS

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(10^9 tf) div (1000 tf + s m) with m = 100 - b + (b n N) div L, in 64-bit integers."""
        b = self.length_percent
        m = 100 - b + b * n * self.n_docs // max(1, self.n_terms)
        return 1_000_000_000 * tf // (1000 * tf + self.saturation_tenths * m)


def _rows_of(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the given rows of a sparse matrix, and how many each row has."""
    n = first[rows + 1] - first[rows]
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[rows] - ends + n, n), n


class Shard:
    """Documents by row (first, term, impact) with, for each term, its blocks of documents and their summaries by term."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, term: np.ndarray, impact: np.ndarray, weights: np.ndarray,
                 block_docs: int):
        self.ids, self.first, self.term, self.impact = ids, first, term, impact
        doc = np.repeat(np.arange(len(ids)), np.diff(first))
        listed = np.flatnonzero(weights[term] > 0)
        listed = listed[np.argsort(term[listed], kind="stable")]  # postings: by term, then document
        list_term, list_doc = term[listed], doc[listed]
        cluster = self._clusters(doc, list_term, list_doc, weights, block_docs)
        order = np.lexsort((list_doc, cluster, list_term))
        list_term, self.block_doc, cluster = list_term[order], list_doc[order], cluster[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (list_term[1:] != list_term[:-1]) | (cluster[1:] != cluster[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        new |= (np.arange(len(order)) - start) % block_docs == 0  # large clusters, such as copies, are cut further
        self.block_first = np.append(np.flatnonzero(new), len(order))
        self.block_term = list_term[self.block_first[:-1]]
        self._summarise(len(weights))

    def _clusters(self, doc, list_term, list_doc, weights, block_docs) -> np.ndarray:
        """For each posting the centroid, a document of its list, that its document is most like."""
        signs = np.random.default_rng(7).integers(0, 2, (len(weights), _DIMENSIONS)).astype(np.float32) * 2 - 1
        at = np.zeros((len(self.ids), _DIMENSIONS), dtype=np.float32)
        value = (weights[self.term] * self.impact / 1e6).astype(np.float32)
        filled = np.flatnonzero(np.diff(self.first))
        if len(filled):
            at[filled] = np.add.reduceat(signs[self.term] * value[:, None], self.first[filled], axis=0)
        at /= np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)
        out = np.zeros(len(list_doc), dtype=np.int32)
        cuts = np.append(np.flatnonzero(np.diff(list_term, prepend=-1)), len(list_term))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if hi - lo > block_docs:
                own = at[list_doc[lo:hi]]
                centroids = own[:: block_docs]
                out[lo:hi] = np.argmax(own @ centroids.T, axis=1)
        return out

    def _summarise(self, n_terms: int) -> None:
        """Coordinatewise maxima of each block's documents, kept by term: (sum_first, sum_block, sum_max)."""
        at_once, n_blocks = max(1, _CELLS // max(1, n_terms)), len(self.block_first) - 1
        blocks_, terms, tops = [], [], []
        for lo in range(0, n_blocks, at_once):
            hi = min(n_blocks, lo + at_once)
            docs = self.block_doc[self.block_first[lo]:self.block_first[hi]]
            entries, n = _rows_of(self.first, docs)
            block = np.repeat(np.repeat(np.arange(hi - lo), np.diff(self.block_first[lo:hi + 1])), n)
            most = np.zeros((hi - lo) * n_terms, dtype=np.int32)
            np.maximum.at(most, block * n_terms + self.term[entries], self.impact[entries].astype(np.int32))
            there = np.flatnonzero(most)
            blocks_.append((there // n_terms + lo).astype(np.int32))
            terms.append((there % n_terms).astype(np.int32))
            tops.append(most[there])
        block, term, top = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (blocks_, terms, tops))
        order = np.argsort(term, kind="stable")
        self.sum_block, self.sum_max = block[order], top[order]
        self.sum_first = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.list_first = np.searchsorted(self.block_term, np.arange(n_terms + 1))

    def best(self, terms: np.ndarray, wanted: np.ndarray, best: list[tuple[int, int]], k: int,
             seen: np.ndarray, asked: np.ndarray) -> list[tuple[int, int]]:
        """The k best (-score, doc_id) of ``best`` and this shard's documents for one item.

        ``wanted`` are the terms' weights times their repeats. ``seen`` (a false a document) and ``asked`` (a zero a
        term) are lent and given back as they were.
        """
        bound = np.zeros(len(self.block_term), dtype=np.int64)
        for t, w in zip(terms.tolist(), wanted.tolist(), strict=True):
            here = slice(self.sum_first[t], self.sum_first[t + 1])
            bound[self.sum_block[here]] += w * self.sum_max[here].astype(np.int64)
        own, _ = _rows_of(self.list_first, terms)
        own = own[np.argsort(-bound[own], kind="stable")]
        bounds = bound[own]
        asked[terms] = wanted
        scored, at, step = [], 0, 4
        while at < len(own):
            least = -best[k - 1][0] if len(best) >= k else 1
            # Blocks from here on have no larger bound: below the least score, none of their documents can enter.
            stop = at + int(np.searchsorted(-bounds[at:at + step], -least, side="right"))
            if stop == at:
                break
            inside, _ = _rows_of(self.block_first, own[at:stop])
            docs = np.unique(self.block_doc[inside])
            docs = docs[~seen[docs]]
            seen[docs] = True
            scored.append(docs)
            if len(docs):
                entries, n = _rows_of(self.first, docs)
                score = np.add.reduceat(asked[self.term[entries]] * self.impact[entries], np.cumsum(n) - n)
                good = np.flatnonzero(score >= least)
                if len(good) > k:
                    good = good[np.lexsort((self.ids[docs[good]], -score[good]))[:k]]
                if len(good):
                    best = sorted([*best, *zip((-score[good]).tolist(), self.ids[docs[good]].tolist(), strict=True)])[:k]
            at, step = stop, min(256, 2 * step)
        for docs in scored:
            seen[docs] = False
        asked[terms] = 0
        return best


#: A shard as a row: its arrays, as they are.
_ARRAYS = {"ids": np.int64, "first": np.int64, "term": np.int32, "impact": np.int64, "block_doc": np.int64,
           "block_first": np.int64, "block_term": np.int32, "sum_block": np.int32, "sum_max": np.int32, "sum_first": np.int64,
           "list_first": np.int64}
_VECTORS = ["doc_id", "n", "term", "tf"]

#: Asked items: (id, terms, weights times repeats).
Asked = list[tuple[int | None, np.ndarray, np.ndarray]]


def _shards(batches: Iterator[pa.RecordBatch], scoring: Scoring, shard_docs: int, block_docs: int) -> Iterator[Shard]:
    """Shards of consecutive rows (doc_id, n, term, tf)."""
    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < len(batch):
            part = batch.slice(at, shard_docs - rows)
            held.append(part)
            at, rows = at + len(part), rows + len(part)
            if rows == shard_docs:
                yield _shard(held, scoring, block_docs)
                held, rows = [], 0
    if rows:
        yield _shard(held, scoring, block_docs)


def _shard(held: list[pa.RecordBatch], scoring: Scoring, block_docs: int) -> Shard:
    docs = pa.Table.from_batches(held).combine_chunks()
    ids = docs.column("doc_id").fill_null(_NO_ID).to_numpy()
    term, tf = docs.column("term").combine_chunks(), docs.column("tf").combine_chunks()
    cuts = term.offsets.to_numpy().astype(np.int64)
    n = np.repeat(docs.column("n").to_numpy(), np.diff(cuts))
    impact = scoring.impacts(tf.flatten().to_numpy().astype(np.int64), n)
    return Shard(ids, cuts - cuts[0], term.flatten().to_numpy(), impact, scoring.weights, block_docs)


def _answers(shards: Iterator[Shard], asked: Asked, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """Each asked item's k best documents of all the shards, which are searched one after the other.

    An item's k best so far are handed on, so its bounds tighten from shard to shard.
    """
    best: list[list[tuple[int, int]]] = [[] for _ in asked]
    weights = np.zeros(max(1, n_terms), dtype=np.int64)
    for shard in shards:
        seen = np.zeros(len(shard.ids), dtype=bool)
        for q, (_, terms, wanted) in enumerate(asked):
            best[q] = shard.best(terms, wanted, best[q], k, seen, weights)
    rows = [(item, doc, -score) for (item, _, _), own in zip(asked, best, strict=True) for score, doc in own]
    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], pa.int64()) for c in range(3)],
                                     ["item_id", "doc_id", "score"])


def build_index(found: DataFrame, scoring: Scoring, shard_docs: int = SHARD_DOCS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row a shard of ``found(doc_id, n, term, tf)``, to be stored: its vectors, posting blocks and summaries.

    A shard holds consecutive rows of one partition, so nothing is shuffled. Every row with a term is in one shard.
    """
    shared = found.sparkSession.sparkContext.broadcast(scoring)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, shared.value, shard_docs, block_docs):
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.ascontiguousarray(getattr(shard, name), dtype=kind).tobytes()], pa.binary())
                 for name, kind in _ARRAYS.items()], list(_ARRAYS))

    return found.where("size(term) > 0").select(*_VECTORS).mapInArrow(run, ", ".join(f"{x} binary" for x in _ARRAYS))


def search_index(index: DataFrame, asked: Asked, n_terms: int, k: int = TOP) -> DataFrame:
    """(item_id, doc_id, score): for each asked item the k best documents of each task's shards; the global ones are among them."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        for batch in batches:
            for row in range(len(batch)):
                shard = Shard.__new__(Shard)
                for c, (name, kind) in enumerate(_ARRAYS.items()):
                    setattr(shard, name, np.frombuffer(batch.column(c)[row].as_buffer(), kind))
                yield shard

    return index.mapInArrow(lambda batches: _answers(loaded(batches), shared.value, n_terms, k),
                            "item_id long, doc_id long, score long")


def search_once(found: DataFrame, scoring: Scoring, asked: Asked, k: int = TOP, shard_docs: int = SHARD_DOCS,
                block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``search_index`` of ``build_index`` without the rows between them: each shard is built, searched and let go."""
    shared = found.sparkSession.sparkContext.broadcast((scoring, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scoring, asked = shared.value
        return _answers(_shards(batches, scoring, shard_docs, block_docs), asked, len(scoring.weights), k)

    return found.where("size(term) > 0").select(*_VECTORS).mapInArrow(run, "item_id long, doc_id long, score long")


def top_documents(answers: DataFrame, k: int = TOP) -> DataFrame:
    """The k best of each item's ``answers(item_id, doc_id, score)``, numbered; groups of documents are cut first."""
    order = [F.desc("score"), F.col("doc_id").asc()]
    some = answers.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    for keys in (["item_id", "part"], ["item_id"]):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return some.select("item_id", "rank", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def asked_of(items: list[tuple[int | None, dict[bytes, int]]], number: dict[bytes, int], weights: np.ndarray) -> Asked:
    asked = []
    for item, own in items:
        counts = sorted((number[t], n) for t, n in own.items())
        at = np.array([t for t, _ in counts], dtype=np.int64)
        wanted = weights[at] * np.array([n for _, n in counts], dtype=np.int64)
        asked.append((item, at[wanted > 0], wanted[wanted > 0]))
    return asked


def search(docs: DataFrame, items: DataFrame, k: int = TOP, shard_docs: int = SHARD_DOCS, block_docs: int = BLOCK_DOCS,
           item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The k highest-scoring documents of ``docs(doc_id, text)`` for each item of ``items(item_id, text)``.

    (item_id, rank, doc_id, score): rank from 1, highest score first, equal scores by ascending doc_id; only scores
    above 0. Items are taken together in blocks of about ``item_bytes`` of text, so what is broadcast and collected of
    them is bounded; each block is one scan of the documents. Null and empty texts, and texts without terms, match
    nothing; items without terms have no rows. Rows that share an item_id are one item whose texts add up, equal
    ones once. Repeated rows of ``docs`` are documents of their own, ranked one after the other; a row without a doc_id
    counts as a document and comes after equal scores. Very long texts are taken whole. Empty tables give an empty
    result. Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    docs, items = docs.select("doc_id", "text"), items.select(F.col("item_id").cast("long"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks, out = -(-size // item_bytes), None
    for b in range(n_blocks):
        part = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b)
        found = _search_block(docs, item_terms(part), k, shard_docs, block_docs)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def _search_block(docs: DataFrame, items: list[tuple[int | None, dict[bytes, int]]], k: int, shard_docs: int,
                  block_docs: int) -> DataFrame:
    terms = sorted({t for _, own in items for t in own})
    found = stored(vectors_of(docs, terms), "vectors")
    scoring = Scoring(*term_weights(found, len(terms)))
    asked = asked_of(items, {t: i for i, t in enumerate(terms)}, scoring.weights)
    return top_documents(search_once(found, scoring, asked, k, shard_docs, block_docs), k)
