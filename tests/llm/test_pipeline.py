"""The pipeline's stages against brute force, and as a whole."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from storelens.llm import common, substring_dedup
from storelens.llm.packing import CAPACITY
from tests.conftest import SMOKE_DIR
from tests.llm import frames
from tests.llm.test_joins import brute_components, brute_passages, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]


def odd_documents():
    return [(9001, None, None), (9002, "", "en"), (9003, " \n\t ", "en"), (9004, "½ ② 123 --", "en"), (None, "the house and the river", "en"),
            (9005, "the house and the river", "en"), (9005, "the house and the river", "en"), (9006, "the river " * 40000, "en")]


def labelled(rng, n=240):
    """Texts of two learned languages; every fifth is toxic, and labelled so."""
    words = {"en": ["the", "house", "and", "river", "stone", "was"], "de": ["das", "haus", "und", "fluss", "stein", "war"]}
    rows, labels = [], []
    for i in range(n):
        lang = "en" if i % 2 else "de"
        own = rng.choices(words[lang], k=30)
        if i % 5 == 0:
            own[10:10] = ["horrid", "vile"] * 4
        rows.append((i, " ".join(own), lang))
        labels.append((i, 1, int(i % 5 == 0)))
    return rows, labels


def test_toxicity_filter_on_odd_rows(spark, tmp_path):
    rows, labels = labelled(random.Random(3))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = odd_documents() + [(9007, "the house horrid vile horrid vile horrid vile and river", "en")]
    docs = frames.docs(spark, rows + odd).withColumnRenamed("odd name", "toxicity")
    got = corpus_pipeline.toxicity_filter(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = got.collect()
    ids = [r.doc_id for r in kept]
    assert 9007 not in ids and all(i is None or i >= 9000 or i % 5 for i in ids)
    assert sorted(str(i) for i in ids if i is None or i >= 9000) == sorted(str(i) for i, *_ in odd[:-1])
    assert {r.toxicity for r in kept} == {"y"}  # the input's own column
    assert corpus_pipeline.toxicity_filter(spark, docs.limit(0), str(tmp_path)).count() == 0
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.toxicity_filter(spark, docs, f"{tmp_path}/none").count() == docs.count()


def test_language_filter_on_odd_rows_and_unlearned_languages(spark):
    rows, _ = labelled(random.Random(4))
    other = [(8000, "Wszyscy ludzie rodzą się wolni i równi w swojej godności", None), (8001, "Minden emberi lény szabadon születik", None)]
    docs = frames.docs(spark, [(i, t, x) for i, t, x in rows + odd_documents()] + [(i, t, "") for i, t, _ in other])
    got = corpus_pipeline.language_filter(spark, docs, SMOKE_DIR)
    assert got.columns == docs.columns
    kept = got.collect()
    assert {r.score for r in kept} == {0.5}  # the input's own column
    ids = [r.doc_id for r in kept]
    assert sum(i is not None and i < 1000 for i in ids) == len(rows)
    assert sorted(i for i in ids if i is not None and i >= 8000) == [9005, 9005, 9006] and None in ids
    assert corpus_pipeline.language_filter(spark, docs.limit(0), SMOKE_DIR).count() == 0
    assert corpus_pipeline.language_filter(spark, docs.withColumn("lang", F.lit(None).cast("string")), SMOKE_DIR).count() == 0


def test_packing_of_odd_rows(spark):
    odd = odd_documents()
    got = corpus_pipeline.best_fit_packing(spark, frames.docs(spark, odd).select(*COLUMNS), SMOKE_DIR).collect()
    assert {r.doc_id for r in got} == {i for i, *_ in odd}
    assert [r.length for r in got if r.doc_id in (9001, 9002, 9003)] == [1, 1, 1]
    assert sum(r.doc_id == 9005 for r in got) == 2 and sum(r.doc_id == 9006 for r in got) > 10
    used = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= CAPACITY
    assert corpus_pipeline.best_fit_packing(spark, frames.docs(spark, []).select(*COLUMNS), SMOKE_DIR).count() == 0


def test_near_duplicates_leave_one_of_each_group(spark):
    rows = list({i: (i, t) for i, t in frames.corpus(9) if i is not None}.values()) + [(None, "a b c"), (None, None)]
    got = corpus_pipeline.near_duplicate_removal(spark, frames.docs(spark, rows).select(*COLUMNS), SMOKE_DIR)
    label = brute_components({i: shingles(t) for i, t in rows if i is not None})
    assert got.columns == COLUMNS
    kept = [r.doc_id for r in got.collect()]
    assert sorted(k for k in kept if k is not None) == sorted(set(label.values())) and kept.count(None) == 2


def test_passages_go_and_lengths_follow(spark):
    rows = list({i: (i, t) for i, t in frames.corpus(9) if i is not None}.values())
    got = corpus_pipeline.passage_removal(spark, frames.docs(spark, rows).select(*COLUMNS), SMOKE_DIR)
    want = brute_passages(rows)
    left = {i: want.get(i, t) for i, t in rows if not t or want[i].strip() or want[i] == t}
    assert {r.doc_id: r.text for r in got.collect()} == left
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())


def test_whole_run(spark):
    docs = common.table(spark, SMOKE_DIR, "documents")
    before, left = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SMOKE_DIR), f"test-{name}")
        assert docs.columns == COLUMNS
        left[name] = docs.count()
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert docs.count() <= left["ngram_jaccard_join"] <= left["language_id"] <= left["toxicity"] <= before.count()
    assert left["language_id"] >= 0.99 * left["toxicity"]  # texts in a learned language stay
    packed = corpus_pipeline.run(spark, SMOKE_DIR).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}
    used = {}
    for r in packed:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= CAPACITY and len(used) <= -(-sum(used.values()) // CAPACITY) + 2


def test_clean_text_keeps_its_sentences(spark):
    """Runs, not single sentences, are repeats: a line that many texts share stays in each."""
    line = "This work is licensed under the terms of some well known public license."
    rows = [(k, f"Own words {k} come first and differ. {line} Other words {k * 7} follow it here.") for k in range(20)]
    got = substring_dedup.deduplicate_passages(frames.docs(spark, rows)).collect()
    assert sum(r.n_removed for r in got) == 0
