"""Graph search and embedding dedup against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from storelens.llm import ann_graph, embedding_dedup, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id long, cell long, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, "z")
                                  for i, v in rows], SCHEMA)


def rows_of(n=700, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[50:90] = x[10] + rng.normal(scale=0.05, size=(40, dim)).astype(np.float32)  # a crowd
    x[100:130] = x[3]  # copies
    x[130] = 2 * x[4]  # the same direction
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, []), (2002, [0.0] * dim), (2003, [math.nan] * dim), (2004, [math.inf] + [1.0] * (dim - 1)),
           (2005, [None] + [1.0] * (dim - 1)), (None, x[3].tolist()), (2006, [1.0, 2.0]), (2007, [1.0, 2.0]), (2008, [2.0, 1.0]),
           (100, x[3].tolist())]
    return rows + odd


def good(rows):
    return {i: np.array(v, dtype=np.float64) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}


@pytest.mark.parametrize("shard", [100, 4096])
def test_search_against_brute_force(spark, shard):
    rows = rows_of()
    df = frame(spark, rows)
    index = ann_graph.build_index(df, shard=shard)
    asked = vectors.usable_vectors(df.where("vec_id % 7 = 0 or vec_id > 1000"), "vec_id", "embedding").distinct()
    got = {}
    for r in ann_graph.search(index, asked, k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    data, hits, total = good(rows), 0, 0
    for q in [i for i in data if i % 7 == 0 or i > 1000]:
        near = sorted((float(np.sqrt(((data[i] - data[q]) ** 2).sum())), i) for i in data
                      if i != q and len(data[i]) == len(data[q]))[:10]
        own = sorted(got.get(q, []))
        assert [r for r, _, _ in own] == list(range(1, len(near) + 1))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        for _, i, s in own:
            assert math.isclose(s, float(np.sqrt(((data[i] - data[q]) ** 2).sum())), rel_tol=1e-12, abs_tol=1e-12)
        hits += len({i for _, i in near} & {i for _, i, _ in own})
        total += len(near)
    assert hits >= 0.97 * total


def test_search_over_many_shards(spark):
    """Twelve shards or more: recall stays, repeated queries are asked once."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 2600)] + rng.normal(scale=0.4, size=(2600, 16))).astype(np.float32)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    index = ann_graph.build_index(df, shard=200)
    assert index.count() >= 12
    asked = vectors.usable_vectors(df.where("vec_id % 20 = 0"), "vec_id", "embedding")
    got = {}
    for r in ann_graph.search(index, asked.unionByName(asked), k=10).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    wide, hits = x.astype(np.float64), 0
    for q in range(0, 2600, 20):
        d = ((wide - wide[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        assert len(got[q]) == len(set(got[q])) == 10
        hits += len(set(got[q]) & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 10 * len(got)


def test_search_of_huge_components_and_too_many_neighbours(spark):
    rows = [(i, [v, 1.0]) for i, v in enumerate([1e30, 2e30, 3e30, 5e30, -1e30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann_graph.build_index(df)
    asked = vectors.usable_vectors(df.where("vec_id = 0"), "vec_id", "embedding")
    got = ann_graph.search(index, asked, k=3).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 4]
    with pytest.raises(ValueError):
        ann_graph.search(index, asked, k=11)
    assert ann_graph.search(ann_graph.build_index(df, ids_kept=12), asked, k=11).count() == 4


def test_search_empty(spark):
    empty = frame(spark, [])
    assert ann_graph.search(ann_graph.build_index(empty), vectors.usable_vectors(empty, "vec_id", "embedding")).count() == 0


@pytest.mark.parametrize(("cell", "threshold"), [(64, 0.95), (2048, 0.95), (64, 0.8)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, cell, threshold):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    rows = rows_of(400)
    got = embedding_dedup.near_duplicates(frame(spark, rows), threshold=threshold, cell=cell).collect()
    assert len(got) == len(rows)
    data = good(rows)
    links = {i: {j for j in data if j != i and len(data[j]) == len(data[i])
                 and data[i] @ data[j] / np.linalg.norm(data[i]) / np.linalg.norm(data[j]) >= threshold} for i in data}
    label = {i: i for i in data}
    for _ in range(len(data)):
        new = {i: min([label[i], *[label[j] for j in links[i]]]) for i in data}
        if new == label:
            break
        label = new
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            own = label.get(r.vec_id, r.vec_id)
            assert (r.n_links, r.component_id, r.kept) == (len(links.get(r.vec_id, ())), own, own == r.vec_id), r.vec_id


@pytest.mark.parametrize("cells", [7, 4096])
def test_guests_by_definition(cells, monkeypatch):
    """Every cell of smaller number whose border is near enough, however many cells there are, some rows at a time."""
    monkeypatch.setattr(embedding_dedup, "NEAR", 40 * cells)
    rng = np.random.default_rng(cells)
    centres, x = (embedding_dedup.unit(rng.normal(size=(n, 6))) for n in (cells, 150))
    home, rows, at = embedding_dedup.guests(x, centres, 0.05)
    found = set(zip(rows.tolist(), at.tolist(), strict=True))
    for i, v in enumerate(x):
        near = centres @ v
        assert home[i] == near.argmax()
        gap = np.sqrt(((centres - centres[home[i]]) ** 2).sum(axis=1))
        sure = {k for k in range(home[i]) if near[home[i]] - near[k] <= 0.05 * gap[k] - 1e-9}
        never = {k for k in range(home[i]) if near[home[i]] - near[k] > 0.05 * gap[k] + 1e-7}
        own = {k for r, k in found if r == i}
        assert sure <= own and not own & never and max(own, default=-1) < home[i]


def test_near_duplicates_empty(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0
