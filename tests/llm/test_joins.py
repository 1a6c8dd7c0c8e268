"""N-gram join, components, passages and pipeline stages against brute force."""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest

from storelens.llm import ngram_join, substring_dedup, tiles
from storelens.llm.components import connected_components
from tests.llm import frames

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_components(sets):
    """Smallest id reachable by links, of {id: set}."""
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, k) for k in range(1001, 1040)] + [(7, 7), (None, 3), (5, 4), (5, 4)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{k: 1000 for k in range(1000, 1040)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_ngram_join_equals_brute_force(spark, seed):
    rows = frames.corpus(seed)
    got, links = ngram_join.ngram_jaccard_join(frames.docs(spark, rows))
    found = got.collect()
    assert len(found) == len(rows)
    sets = {i: shingles(t) for i, t in rows if i is not None}
    label = brute_components(sets)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), label[r.doc_id]), r.doc_id
    for r in links.collect():
        assert 100 * len(sets[r.a] & sets[r.b]) >= 80 * len(sets[r.a] | sets[r.b])


def near_copies(n, seed=1, words=200, edits=3):
    """Near copies of one text: most pairs differ by too much, yet links connect nearly all."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        own = [f"w{i}" for i in range(words)]
        for _ in range(edits):
            own[rng.randrange(words)] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(own)))
    return rows


def test_ngram_join_crowd_of_near_copies(spark):
    """Components and link counts equal all pairs; the links handed on don't grow with the pairs."""
    handed = {}
    for n in (200, 800):
        rows = near_copies(n)
        got, links = ngram_join.ngram_jaccard_join(frames.docs(spark, rows))
        found = got.collect()
        sets = {i: shingles(t) for i, t in rows}
        label = brute_components(sets)
        assert [r.doc_id for r in found if r.component_id != label[r.doc_id]] == []
        counts = {i: sum(100 * len(s & t) >= 80 * len(s | t) for t in sets.values()) - 1 for i, s in sets.items()}
        assert {r.doc_id: r.n_links for r in found} == counts
        handed[n] = links.count()
        assert handed[n] <= 3 * n < sum(counts.values()) or n == 200


@pytest.mark.parametrize("block_rows", [2, 5])
def test_ngram_join_in_small_blocks(spark, monkeypatch, block_rows):
    """The same classes and links when every cell is dealt to many pairs of blocks."""
    rows = frames.corpus(8) + [(1000 + k, t) for k, t in near_copies(40, words=60, edits=1)]
    monkeypatch.setattr(ngram_join, "dealt", lambda rows, alone="false": tiles.dealt(rows, alone, block_rows=block_rows))
    found = ngram_join.ngram_jaccard_join(frames.docs(spark, rows))[0].collect()
    sets = {i: shingles(t) for i, t in rows if i is not None}
    label = brute_components(sets)
    texts = [shingles(t) for i, t in rows if i is not None]
    for r in found:
        if r.doc_id is not None:
            assert r.component_id == label[r.doc_id]
            own = sets[r.doc_id]
            assert r.n_links == (sum(100 * len(own & t) >= 80 * len(own | t) for t in texts) - 1 if own else 0)


@pytest.mark.parametrize("seed", range(6))
def test_shared_counts_and_forest(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(tiles, "_COLUMNS", 3)
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 12))) for _ in range(30)]
    items = tiles.Items(pa.chunked_array([pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))]))
    rows, others = np.arange(0, 18), np.arange(12, 30)
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in others] for i in rows]
    assert items.shared(rows, others, False).tolist() == want
    own = items.shared(rows, rows, True)
    assert [[own[i, j] for j in range(18) if j != i] for i in range(18)] == \
        [[len(np.intersect1d(sets[i], sets[j])) for j in range(18) if j != i] for i in range(18)]
    square = rng.random((9, 9)) < 0.1
    for hit, same in ((rng.random((9, 7)) < 0.15, False), ((square | square.T) & ~np.eye(9, dtype=bool), True)):
        name = (lambda i, j: (("n", i), ("n", j))) if same else (lambda i, j: (("r", i), ("c", j)))
        edges = tiles.forest(hit, same)
        assert all(hit[e] for e in edges) and len(edges) < sum(hit.shape) + 1
        assert groups_of([name(*e) for e in edges]) == groups_of([name(i, j) for i, j in zip(*np.nonzero(hit), strict=True)])


def groups_of(links):
    label = {}
    for a, b in links:
        x, y = label.setdefault(a, {a}), label.setdefault(b, {b})
        if x is not y:
            x |= y
            for node in y:
                label[node] = x
    return {frozenset(x) for x in label.values()}


def test_ngram_join_empty_table(spark):
    got, links = ngram_join.ngram_jaccard_join(frames.docs(spark, []))
    assert got.count() == 0 and links.count() == 0


def parts_of(text):
    """(begin, end, words) of each sentence in bytes, from the rules as they are stated, a text at a time."""
    data = text.encode()
    spans, at = [], 0
    for m in re.finditer(r"[ \t\n\v\f\r]+|[^ \t\n\v\f\r]+", text):
        if m.group()[0] not in " \t\n\v\f\r":
            own = re.findall("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in substring_dedup.UNSPACED) + "]|[^"
                             + "".join(f"{chr(a)}-{chr(b)}" for a, b in substring_dedup.UNSPACED) + "]+", m.group())
            place = at
            for w in own:
                spans.append((place, place + len(w.encode())))
                place += len(w.encode())
        at += len(m.group().encode())
    words = [data[a:b] for a, b in spans]
    pairs = [cut_behind(words[k], words[k + 1]) for k in range(len(words) - 1)]
    out, first = [], 0
    for k, w in enumerate(words):
        said = w.decode()
        bare = said[:-1] if len(w) > 1 and said[-1] in substring_dedup.CLOSERS else said
        ends = (k + 1 == len(words) or bare[-1:] in substring_dedup.ENDS or b"\n" in data[spans[k][1]:spans[k + 1][0]]
                or (k > 0 and pairs[k - 1]))
        if ends or k + 1 - first == substring_dedup.LONGEST:
            begin = 0 if first == 0 else spans[first][0]
            out.append((begin, len(data) if k + 1 == len(words) else spans[k + 1][0], words[first:k + 1]))
            first = k + 1
    return out


def cut_behind(a, b):
    """Whether a part ends behind these two words: the one thing taken from the operator, on the two words alone."""
    cut = substring_dedup.Sentences([b"x" * 99 + b" " + a + b" " + b + b" " + b"y" * 99])
    return int(cut.start[2] + len(b) + 1) in cut.start[cut.word[:-1]].tolist() if len(cut.start) == 4 else False


def brute_passages(rows):
    """Kept text by id: every run of every document in order of id; a run seen before is a repeat."""
    seen, out = {}, {}
    for i, text in sorted(((i, t) for i, t in rows if t), key=lambda r: r[0]):
        parts = parts_of(text)
        sizes = [len(w) for _, _, w in parts]
        runs = set()
        for a in range(len(parts)):
            b = next((b for b in range(a + substring_dedup.RUN, len(parts) + 1) if sum(sizes[a:b]) >= substring_dedup.MIN_WORDS), None)
            runs |= {(a, b)} if b else set()
        drop, first = set(), {}
        for a, b in sorted(runs):
            key = tuple(w.lower() for _, _, own in parts[a:b] for w in own)
            if key in seen and seen[key] != i:
                drop |= set(range(a, b))
            elif key in first:
                drop |= set(range(max(a, first[key]), b))
            else:
                first[key] = b
        for key in first:
            seen.setdefault(key, i)
        out[i] = b"".join(text.encode()[x:y] for k, (x, y, _) in enumerate(parts) if k not in drop).decode() if parts else text
    return out


def odd_passages():
    """Scripts without spaces, other sentence ends, one line of thousands of words, and repeats inside one text."""
    rng = random.Random(9)
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(120))
    han = "".join(chr(rng.randrange(0x4E00, 0x5000)) for _ in range(90))
    hindi = " ".join("".join(chr(rng.randrange(0x0915, 0x0939)) for _ in range(3)) for _ in range(60))
    rows = [(500, f"one {thai} two"), (501, f"three four {thai}five"), (502, f"«{han}。」 End."), (503, f"so {han} on"),
            (504, f"{hindi}। {hindi}"), (505, f"first {hindi}। last")]
    line = " ".join(f"{rng.choice('abcdef')}{rng.randrange(50)}" for _ in range(3000))
    return rows + [(506, line), (507, f"{line} {line}"), (508, "same " * 5000), (509, "same " * 400), (510, 'Say "yes." (No!) ' * 30)]


@pytest.mark.parametrize("seed", [5, 6])
def test_passages_equal_brute_force(spark, seed):
    rows = list({i: (i, t) for i, t in frames.corpus(seed) + odd_passages() if i is not None}.values())
    df = frames.docs(spark, rows)
    got = {r.doc_id: r for r in substring_dedup.deduplicate_passages(df).collect()}
    assert len(got) == len(rows)
    want = brute_passages(rows)
    for i, text in rows:
        assert got[i].text == want.get(i, text), i
        cut = "".join(text[a:b] for a, b in _outside(text, got[i].removed)) if text else text
        assert cut == got[i].text
    assert len(got[501].text) < 60 and len(got[503].text) < 60 and len(got[507].text) < 200
    assert substring_dedup.deduplicate_passages(df).columns == [*df.columns, "n_removed", "removed"]


def _outside(text, removed):
    at = 0
    for r in removed:
        yield at, r.begin
        at = r.end
    yield at, len(text)


@pytest.mark.parametrize("punctuated", [True, False])
def test_passages_wherever_they_stand(spark, punctuated):
    """Passages of 51 words set at any word of two other texts: nearly all are found, and most of their words go."""
    rng = random.Random(1)

    def text(n):
        words = " ".join(frames.sentence(rng, rng.randrange(5, 25)) for _ in range(n)).split()
        return words if punctuated else [re.sub(r"\W", "", w).lower() for w in words]

    rows, planted = [], {}
    for k in range(150):
        passage = text(12)[7:58]
        for copy in range(2):
            own = text(6)
            at = rng.randrange(len(own))
            rows.append((1000 * copy + k, " ".join(own[:at] + passage + own[at:])))
        planted[1000 + k] = (len(" ".join(own[:at])), passage)
    got = {r.doc_id: r for r in substring_dedup.deduplicate_passages(frames.docs(spark, rows)).collect()}
    assert all(got[k].n_removed == 0 for k in range(150))
    removed = [sum(r.end - r.begin for r in got[i].removed) / len(" ".join(p)) for i, (_, p) in planted.items()]
    assert sum(x > 0 for x in removed) >= 0.95 * len(removed)
    assert sum(removed) / len(removed) >= 0.7
    for i, (at, p) in planted.items():  # and nothing else
        assert all(r.begin >= at and r.end <= at + len(" ".join(p)) + 2 for r in got[i].removed)


def test_sentences_cover_every_text():
    for _, text in frames.corpus(6) + odd_passages():
        if not (text or "").strip():
            continue
        cut = substring_dedup.Sentences([b"before it.", text.encode(), None])
        bounds = cut.bounds(1, len(text.encode())).tolist()
        assert [(a, b) for a, b, _ in parts_of(text)] == list(zip(bounds[:-1], bounds[1:], strict=True))
        assert bounds[0] == 0 and bounds[-1] == len(text.encode()) and bounds == sorted(bounds)
        assert np.diff(cut.word).max() <= substring_dedup.LONGEST


def test_passages_empty_table(spark):
    assert substring_dedup.deduplicate_passages(frames.docs(spark, [])).count() == 0
