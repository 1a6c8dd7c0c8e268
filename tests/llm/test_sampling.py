"""Importance resampling, licence scan and lexical search against plain definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import importance, lexical, license_scan
from tests.llm import frames

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def odd_rows():
    return [(900, None), (901, ""), (902, " .,! \n"), (903, "Straße ÉTÉ x2 日本 λόγος"), (904, "long word " * 40000),
            (905, "same text twice"), (905, "same text twice"), (None, "no id here at all"), (None, None)]


@pytest.mark.parametrize("shortest, longest", [(1, 1), (1, 3), (2, 2)])
def test_features_by_prefix_crcs(shortest, longest):
    rng = random.Random(longest)
    texts = [None, "", "a", "Ab é日本 x", " ".join(rng.choice("abc") * rng.randrange(1, 90) for _ in range(50))]
    got = importance.Features([t if t is None else t.encode() for t in texts], shortest, longest, 9973)
    for k, t in enumerate(texts):
        w = words(t)
        want = [crc32(" ".join(w[i:i + n]).encode()) % 9973
                for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]
        assert got.bucket[got.first[k]:got.first[k + 1]].tolist() == want
        assert got.n_words[k] == len(w)


@pytest.mark.parametrize("seed", range(3))
def test_shift_cancels_what_stands_before(seed):
    rng = random.Random(seed)
    a, b = rng.randbytes(rng.randrange(0, 70)), rng.randbytes(rng.randrange(0, 5000))
    shifted = importance.shifted(np.array([crc32(a)], dtype=np.uint32), np.array([len(b)]))
    assert int(shifted[0]) ^ crc32(a + b) == crc32(b)


def brute_draw(rows, target, buckets, min_words, percent, longest):
    def features(text):
        w = words(text)
        return [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in {*s, *t}}
    out = []
    for i, text in rows:
        own = features(text)
        weight = math.floor(sum(gain[b] for b in own) / len(own)) if own else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None, len(words(text))])
    order = sorted((r for r in out if r[0] is not None and r[5] >= min_words), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(order[:len(order) * percent // 100], 1):
        r[4] = k
    return out


@pytest.mark.parametrize("longest, percent", [(1, 10), (2, 50), (1, 100), (1, 0)])
def test_resampling_equals_definition(spark, longest, percent):
    rows = frames.corpus(11) + odd_rows()
    target = [frames.corpus(11)[0][1], "alpha beta gamma", None, ""]
    texts = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = importance.resample(frames.docs(spark, rows), texts, longest=longest, buckets=500, min_words=3, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = brute_draw(rows, target, 500, 3, percent, longest)
    found = [tuple(r) for r in got.collect()]
    # rows of one doc_id and text have two ranks in any order
    assert sorted(map(key, found)) == sorted(map(key, map(tuple, want)))


def test_resampling_of_empty_tables(spark):
    none = frames.docs(spark, [])
    some = frames.docs(spark, frames.corpus(2))
    assert importance.resample(none, some.select("text")).count() == 0
    got = importance.resample(some, none.select("text"), min_words=1).collect()
    assert len(got) == some.count() and all(r.weight <= 0 or r.n_features == 0 for r in got if r.n_features > 20)
    with pytest.raises(ValueError):
        importance.features(some, 0, 1)


# Licences


def brute_licences(text, templates, slack):
    w, found = words(text), []
    at = lambda p: [i for i in range(len(w) - len(p) + 1) if tuple(w[i:i + len(p)]) == p]
    for t in templates:
        places = [[i - place for i in at(phrase)] for place, phrase in t.phrases]
        for o in places[0]:
            if all(any(abs(x - o) <= slack for x in other) for other in places[1:]):
                share = sum(0 <= o + i < len(w) and w[o + i] == x for i, x in enumerate(t.words)) / len(t.words)
                found.append((t.label, o, share, t.base))
    base = [(label, o) for label, o, _, b in found if b]
    return (len(w), len(base), min((o for _, o in base), default=None), max((o for _, o in base), default=None),
            ",".join(sorted({x for x, _ in base})), ",".join(sorted({x[0] for x in found})), max((x[2] for x in found), default=0.0))


def licence_rows():
    rng = random.Random(4)
    notices = [" ".join(t.words) for t in license_scan.TEMPLATES]
    rows = odd_rows()
    for k in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            own = rng.choice(notices).split()
            for _ in range(rng.randrange(0, 4)):  # words changed, added, lost
                i = rng.randrange(len(own))
                own[i:i + rng.randrange(0, 2)] = ["other"] * rng.randrange(0, 3)
            parts += [*own, *rng.choices(["mit", "license", "under", "the", "cc", "by", "version", "2", "river"], k=5)]
        rows.append((k, " ".join(parts).title() if k % 2 else ", ".join(parts)))
    return rows + [(950, "Released under the MIT License. Under the mit-license, under THE MIT license"),
                   (951, "cc by nc " * 3000), (952, "the mit license"), (953, "Apache License, Version 2.0; (CC BY-NC 4.0)")]


@pytest.mark.parametrize("slack", [0, 8])
def test_licences_equal_definition(spark, slack):
    rows = licence_rows()
    got = license_scan.scan(frames.docs(spark, rows), slack=slack).collect()
    key = lambda r: tuple((x is None, 0 if x is None else x) for x in r)
    want = sorted([(i, *brute_licences(t, license_scan.TEMPLATES, slack)) for i, t in rows], key=key)
    assert sorted([tuple(r)[:-1] for r in got], key=key) == want
    assert {r.labels for r in got if r.doc_id == 953} == {"apache-2,cc-by-nc"}
    for r in got:
        assert [p.word for p in r.places] == sorted(p.word for p in r.places)
        assert sorted({p.label for p in r.places}) == [x for x in r.labels.split(",") if x]


def test_every_notice_is_found_and_plain_text_is_not(spark):
    rows = [(k, " ".join(t.words)) for k, t in enumerate(license_scan.TEMPLATES)]
    clean = [(1000 + k, t) for k, t in enumerate(["the software is under the table", "license to version 2 of the public", "mit der CC"])]
    got = {r.doc_id: r for r in license_scan.scan(frames.docs(spark, rows + clean)).collect()}
    for k, t in enumerate(license_scan.TEMPLATES):
        assert t.label in got[k].labels.split(",") and got[k].score == 1.0
    assert all(got[i].labels == "" and got[i].score == 0 and got[i].places == [] for i, _ in clean)
    assert license_scan.scan(frames.docs(spark, [])).count() == 0


# Lexical search


def brute_search(rows, items, k):
    docs = [(i, Counter(words(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(words(t))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c, n in docs:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in own.items() if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


ITEMS = [(1, "alpha1 beta2 gamma3 river"), (2, None), (3, ""), (4, "nothing-known zzz"), (5, "same same text no id at all"),
         (5, "same same text no id at all"), (6, "alpha1"), (6, "Stone7 stone7"), (7, "word long 日本"), (-3, "maple3 maple3 cloud5 tiger9")]


@pytest.mark.parametrize("shard_docs, block_docs, item_bytes", [(2048, 64, 8_000_000), (7, 2, 8_000_000), (16, 3, 40)])
def test_search_equals_definition(spark, shard_docs, block_docs, item_bytes):
    rows = frames.corpus(6) + odd_rows()
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("n", F.lit(2))
    got = lexical.search(frames.docs(spark, rows), items, 5, shard_docs, block_docs, item_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_search(rows, ITEMS, 5), key=key)


def test_search_by_a_stored_index(spark):
    rows = frames.corpus(9)
    items = lexical.item_terms(spark.createDataFrame(ITEMS, "item_id long, text string"))
    terms = sorted({t for _, own in items for t in own})
    found = lexical.vectors_of(frames.docs(spark, rows), terms).cache()
    scoring = lexical.Scoring(*lexical.term_weights(found, len(terms)))
    asked = lexical.asked_of(items, {t: k for k, t in enumerate(terms)}, scoring.weights)
    answers = lexical.search_index(lexical.build_index(found, scoring, 10, 2), asked, len(terms), 3)
    got = lexical.top_documents(answers, 3)
    assert sorted(map(tuple, got.collect())) == sorted(brute_search(rows, ITEMS, 3))


def test_blocks_hold_every_posting_and_bound_every_document():
    rng = np.random.default_rng(2)
    n_docs, n_terms = 300, 40
    dense = rng.integers(0, 1000, (n_docs, n_terms)) * (rng.random((n_docs, n_terms)) < 0.2)
    dense[100:180] = dense[100]  # copies
    doc, term = np.nonzero(dense)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    weights = rng.integers(0, 50, n_terms)
    shard = lexical.Shard(np.arange(n_docs), first, term.astype(np.int32), dense[doc, term], weights, 8)
    sizes = np.diff(shard.block_first)
    assert 0 < sizes.min() and sizes.max() <= 8
    at = np.repeat(shard.block_term, sizes)
    assert sorted(zip(at.tolist(), shard.block_doc.tolist(), strict=True)) == \
        sorted((int(t), int(d)) for d, t in zip(doc, term, strict=True) if weights[t] > 0)
    summary = np.zeros((len(sizes), n_terms), dtype=np.int64)
    for t in range(n_terms):
        here = slice(shard.sum_first[t], shard.sum_first[t + 1])
        summary[shard.sum_block[here], t] = shard.sum_max[here]
    for b in range(len(sizes)):
        own = shard.block_doc[shard.block_first[b]:shard.block_first[b + 1]]
        assert (summary[b] == dense[own].max(axis=0)).all()


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(frames.docs(spark, frames.corpus(1)), none).count() == 0
    assert lexical.search(frames.docs(spark, []), items).count() == 0
    assert lexical.search(frames.docs(spark, [(1, None)]), items.where("text is null")).count() == 0
