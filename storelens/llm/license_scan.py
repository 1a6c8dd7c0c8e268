"""Licence scan by a positional index of rare words.

Templates are short licence notices; each has mandatory key phrases at known places. The
scan of a file keeps the positions of its licence words (words of any template). Over all
files they give each licence word's inverse document frequency. A template is looked up
by its anchor, the highest-IDF word of its key phrases: a file without it can't hold the
template. The postings of the highest-IDF word of each further key phrase are intersected
with the anchor's by relative position (words may be added or missing between phrases, so
within SLACK words), and what is left is verified: all key phrases word by word.

A template is found at place o when its first key phrase stands at its place from o on
and every other key phrase within SLACK words of its place. The index only saves work:
no place is missed, and the result doesn't depend on the frequencies.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.ascii_words import blocks, words_of
from storelens.llm.common import bounded_batches, stored

SLACK = 8

# The phrases whose places are counted, and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Label, notice, key phrases of the notice (in its order).
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                 "compliance with the License",
     ("under the apache license", "you may not use this file except in compliance with the license")),
    ("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
              "the following conditions are met",
     ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission",
     ("neither the name of", "endorse or promote products derived from this software")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted",
     ("permission to use copy modify", "distribute this software for any purpose with or without fee")),
    ("gpl-3", "GNU General Public License, version 3", ("gnu general public license version 3",)),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either "
              "version 3 of the License", ("gnu general public license as published by", "version 3 of the license")),
    ("gpl-2", "GNU General Public License, version 2", ("gnu general public license version 2",)),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation, either "
              "version 2 of the License", ("gnu general public license as published by", "version 2 of the license")),
    ("lgpl", "GNU Lesser General Public License", ("gnu lesser general public license",)),
    ("agpl-3", "GNU Affero General Public License", ("gnu affero general public license",)),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("subject to the terms of the mozilla public license", "v 2 0")),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
              "2.0", ("accompanying materials are made available under", "eclipse public license 2 0")),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "public domain")),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software",
     ("provided as is without any express or implied warranty", "in no event will the authors be held liable")),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
            "this software to the public domain",
     ("to the extent possible under law", "related and neighboring rights", "public domain")),
    ("cc-by-sa", "licensed under CC BY-SA", ("cc by sa",)),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial", ("creative commons attribution noncommercial",)),
)


def _place(words: list[str], phrase: list[str], start: int = 0) -> int:
    for at in range(start, len(words) - len(phrase) + 1):
        if words[at:at + len(phrase)] == phrase:
            return at
    raise ValueError(f"{' '.join(phrase)!r} is not in its notice")


@dataclass(frozen=True)
class Template:
    """A notice as words, with the place and the words of each key phrase; ``base`` ones are counted."""

    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[int, tuple[str, ...]], ...]
    base: bool = False

    @staticmethod
    def of(label: str, notice: str, phrases: tuple[str, ...], base: bool = False) -> Template:
        words = [w.decode() for w in words_of(notice.encode())]
        placed, at = [], 0
        for phrase in phrases:
            own = [w.decode() for w in words_of(phrase.encode())]
            at = _place(words, own, at)
            placed.append((at, tuple(own)))
            at += len(own)
        return Template(label, tuple(words), tuple(placed), base)


TEMPLATES = tuple(Template.of(label, phrase, (phrase,), True) for label, phrase in BASE) + tuple(
    Template.of(*notice) for notice in NOTICES)


def occurrences(docs: DataFrame, words: list[str]) -> DataFrame:
    """(doc_id, n_words, at, word): for every row of ``docs(doc_id, text)`` where its ``words`` stand, by their number."""
    bounded_batches(docs.sparkSession)
    number = {w.encode(): k for k, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch.column(1)):
                n_words, at, word, ends = [], [], [], [0]
                for text in texts:
                    own = words_of(text)
                    n_words.append(len(own))
                    here = [k for k, w in enumerate(own) if w in number]
                    at.extend(here)
                    word.extend([number[own[k]] for k in here])
                    ends.append(len(at))
                cuts = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(n_words, pa.int64()),
                     pa.ListArray.from_arrays(cuts, pa.array(at, pa.int32())),
                     pa.ListArray.from_arrays(cuts, pa.array(word, pa.int16()))], ["doc_id", "n_words", "at", "word"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, at array<int>, word array<short>")


class Index:
    """Positional postings: for each anchor word its templates, with the highest-IDF word of each key phrase."""

    def __init__(self, templates: tuple[Template, ...], words: list[str], idf: list[float], slack: int):
        self.number = {w: k for k, w in enumerate(words)}
        self.slack = slack
        rank = lambda w: (-idf[self.number[w]], w)
        self.postings: dict[int, list[tuple[int, int]]] = {}  # anchor -> (template, key phrase that holds it)
        self.templates = []
        for t, template in enumerate(templates):
            phrases = []
            for place, own in template.phrases:
                best = min(range(len(own)), key=lambda k: rank(own[k]))
                phrases.append((place, [self.number[w] for w in own], best))
            anchor = min(range(len(phrases)), key=lambda k: rank(template.phrases[k][1][phrases[k][2]]))
            self.templates.append((template.label, template.base, [self.number[w] for w in template.words], phrases, anchor))
            self.postings.setdefault(phrases[anchor][1][phrases[anchor][2]], []).append((t, anchor))
        self.anchors = np.array(sorted(self.postings), dtype=np.int16)

    def places(self, at: np.ndarray, word: np.ndarray) -> list[tuple[int, int, float]]:
        """(template, place, share of its words that stand at their places) of a file's licence words, all places."""
        listed: dict[int, list[int]] = {}
        for k, p in zip(word.tolist(), at.tolist(), strict=True):
            listed.setdefault(k, []).append(p)
        there = dict(zip(at.tolist(), word.tolist(), strict=True))
        stands = lambda own, p: all(there.get(p + i) == w for i, w in enumerate(own))
        found = []
        for word_number in [a for a in self.anchors.tolist() if a in listed]:
            for t, anchor in self.postings[word_number]:
                _, _, words, phrases, _ = self.templates[t]
                rare = [[p - place - best for p in listed.get(own[best], ())] for place, own, best in phrases]
                if not all(rare):
                    continue
                # A place counts from the first key phrase; any other may be off by the slack.
                for o in rare[0]:
                    near = [own[bisect_left(own, o - self.slack):bisect_right(own, o + self.slack)] for own in rare[1:]]
                    if anchor and not near[anchor - 1]:
                        continue
                    if stands(phrases[0][1], o + phrases[0][0]) and all(
                            any(stands(own, x + place) for x in offs)
                            for offs, (place, own, _) in zip(near, phrases[1:], strict=True)):
                        share = sum(there.get(o + i) == w for i, w in enumerate(words)) / len(words)
                        found.append((t, o, share))
        return found


def _number_of_files(found: DataFrame, n: int) -> tuple[int, list[int]]:
    """How many files there are, and in how many each of the n words stands."""
    total, held = found.count(), [0] * n
    for r in found.select(F.explode(F.array_distinct("word")).alias("word")).groupBy("word").count().collect():
        held[r.word] = r["count"]  # a row a licence word
    return total, held


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, slack: int = SLACK) -> DataFrame:
    """Licences of every row of ``docs(doc_id, text)``.

    (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places): places of base templates are
    counted and their first and last one given (null where there is none); labels are distinct, sorted and joined by
    commas, empty where nothing is found; score is the largest share of a found template's words that stand at their
    places, 0 where none is found; places lists (label, word, score) of all templates found, in order. Null and empty
    texts, and texts without words: no words, no labels. Very long texts are scanned whole, repeated rows each, rows
    without a doc_id as well; an empty table gives an empty one. Other columns, whatever their names, are not read.
    """
    words = sorted({w for t in templates for w in t.words} | {w for t in templates for _, p in t.phrases for w in p})
    found = stored(occurrences(docs, words), "licence-words")
    total, held = _number_of_files(found, len(words))
    idf = [math.log((1 + total) / (1 + n)) for n in held]
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates, words, idf, slack))
    place = pa.struct([("label", pa.string()), ("word", pa.int64()), ("score", pa.float64())])
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ends = batch.column(2).offsets.to_numpy()
            at, word = (batch.column(k).values.to_numpy(zero_copy_only=False) for k in (2, 3))
            before = np.concatenate(([0], np.cumsum(np.isin(word, index.anchors))))
            rows = []
            for lo, hi, hits in zip(ends[:-1].tolist(), ends[1:].tolist(), (before[ends[1:]] - before[ends[:-1]]).tolist(),
                                    strict=True):
                own = index.places(at[lo:hi], word[lo:hi]) if hits else []
                # A base template is its phrase alone, so its place is the phrase's.
                base = [(index.templates[t][0], o) for t, o, _ in own if index.templates[t][1]]
                labels = sorted({index.templates[t][0] for t, _, _ in own})
                rows.append((len(base), min((o for _, o in base), default=None), max((o for _, o in base), default=None),
                             ",".join(sorted({x for x, _ in base})), ",".join(labels), max((s for _, _, s in own), default=0.0),
                             [{"label": index.templates[t][0], "word": o, "score": s}
                              for t, o, s in sorted(own, key=lambda x: (x[1], x[0]))]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(place)]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    return found.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                            "base_labels string, labels string, score double, "
                            "places array<struct<label: string, word: long, score: double>>")
