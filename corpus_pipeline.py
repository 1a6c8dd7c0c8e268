"""Corpus pipeline: toxicity filter, language filter, near-duplicate removal, passage removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result to the shared checkpoint folder and the next stage reads it. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import common, language_id, ngram_join, packing, substring_dedup, toxicity
from storelens.llm.queries import vocabulary

#: Documents of at least this toxicity go; documents whose words are less familiar than this go.
TOXIC, FAMILIAR = 0.7, 0.5


def _apart(docs: DataFrame, *added: str) -> tuple[DataFrame, list]:
    """``docs`` with its columns out of the way of those that an operator adds, and what selects them again."""
    names = {c: f"__{c}" for c in docs.columns if c in added}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic by a model of the labelled documents among them; empty and null texts stay.

    Without labels of both classes, as with an empty ``labels`` table, all stay. Rows without a doc_id, repeated rows and
    very long texts are judged like others; an empty table gives an empty one.
    """
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    rows, back = _apart(docs, "toxicity", "toxic_passages")
    return toxicity.score(rows, model).where(F.col("toxicity") < TOXIC).select(*back)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model has learned: most of their words, or of the words' letter runs, are known.

    Texts without a letter (``und``), null and empty ones go, and all go where no document has a ``lang``. Rows without a
    doc_id, repeated rows and very long texts are judged like others; an empty table gives an empty one.
    """
    rows, back = _apart(docs, "lang_pred", "score", "familiarity")
    found = language_id.predict(rows, language_id.fit(docs), with_familiarity=True)
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("familiarity") >= FAMILIAR)).select(*back)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of n-gram Jaccard links; rows without a doc_id stay.

    Rows that repeat a doc_id stay together: they are one document. Null and empty texts are near copies of nothing and
    stay; an empty table gives an empty one.
    """
    rows, _ = ngram_join.ngram_jaccard_join(docs)
    gone = rows.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def passage_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that an earlier document has; n_chars follows; texts left without a word go.

    Null and empty texts, which lose nothing, stay, and so do rows without a doc_id; an empty table gives an empty one.
    """
    cut = substring_dedup.deduplicate_passages(docs)
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    return cut.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", length).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all that is left, packed into sequences of 2048 tokens.

    A null or empty text is its end mark alone; rows without a doc_id are packed with a null one, repeated rows each; an
    empty table gives an empty one.
    """
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("language_id", language_filter),
    ("ngram_jaccard_join", near_duplicate_removal),
    ("substring_dedup", passage_removal),
    ("best_fit_packing", best_fit_packing),
]

#: Models, tokenisers and hashes have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
