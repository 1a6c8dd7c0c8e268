"""The registered queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import (
    ann_graph,
    chat_format,
    common,
    embedding_dedup,
    importance,
    language_id,
    lexical,
    license_scan,
    lm_score,
    ngram_join,
    packing,
    sentencepiece_bpe,
    substring_dedup,
    toxicity,
    vectors,
)


def vocabulary(name: str) -> str:
    """Where the installed tokenizer package has its file ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    asked = vectors.usable_vectors(rows.where("vec_id % 100 = 0"), "vec_id", "embedding")
    return ann_graph.search(ann_graph.build_index(rows), asked, k=10)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.sentencepiece_digests(common.table(spark, sf_dir, "documents"),
                                                   vocabulary("piece_bpe_32k.model"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicate_passages(docs)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ngram_join.ngram_jaccard_join(common.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held_out = language_id.remainder("doc_id", 4) == 2
    model = language_id.fit(docs.where(~held_out))
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return language_id.predict(rows, model).drop("text")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"  # a conversation that is all control strings
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    records = rows.unionByName(extra).select("conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record"))
    return chat_format.digests(chat_format.format_turns(chat_format.canonical_turns(records)))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(common.table(spark, sf_dir, "embeddings")).drop("cell")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held_out = language_id.remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels").where(~held_out))
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return toxicity.score(rows, model).select(
        "doc_id", "held_out", F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"), F.size("toxic_passages").alias("n_passages"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = common.table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.cross_entropy_difference(common.table(spark, sf_dir, "documents"), good)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(common.table(spark, sf_dir, "documents")).drop("places")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


OP7_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), control(s) AS (VALUES ('<|im_start|>'), ('<|im_sep|>'), ('<|im_end|>'), ('<|endoftext|>'), ('<|startoftext|>'),
    ('<s>'), ('</s>'), ('[INST]'), ('[/INST]'), ('<<SYS>>'), ('<</SYS>>'), ('<|system|>'), ('<|user|>'),
    ('<|assistant|>'), ('<|begin_of_text|>'), ('<|eot_id|>'), ('<start_of_turn>'), ('<end_of_turn>')
), extra AS (  -- escaping adds a character for each backslash and each control string
    SELECT t.*, (SELECT sum((length(x) - length(replace(x, s, ''))) // length(s)) FROM control)
             + length(x) - length(replace(x, chr(92), '')) AS added
    FROM (SELECT *, role || chr(0) || text AS x FROM turns) t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(text) + added + 32)::BIGINT AS formatted_chars
FROM extra GROUP BY conv_id
"""


#: All pairs that share a shingle, counted; components by closure of the links.
OP5_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
single AS (SELECT doc_id, unnest(s) AS t FROM sets),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM single a JOIN single b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM sizes UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach WHERE x = doc_id) AS component_id FROM sizes
"""

#: All pairs of usable vectors by cosine in double precision.
OP8_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, v FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
    WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON x = vec_id
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: CRC-32 of each distinct word, byte by byte; the draw by one sort of all documents.
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
of_docs AS (SELECT r, unnest(w) AS word FROM docs),
of_items AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b)) AS step),
buckets AS (
    SELECT word, xor(4294967295, list_reduce(
        list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
    FROM (SELECT word FROM of_docs UNION SELECT word FROM of_items), crc
), s AS (SELECT bucket, count(*) AS s FROM of_docs JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM of_items JOIN buckets USING (word) GROUP BY bucket),
gains AS (
    SELECT word, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM buckets LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), weights AS (
    SELECT r, (sum(gain) - ((sum(gain) % count(*)) + count(*)) % count(*)) // count(*) AS weight
    FROM of_docs JOIN gains USING (word) GROUP BY r
), scored AS (
    SELECT doc_id, len(w) AS n, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (r)
), drawn AS (
    SELECT *, CASE WHEN n >= 20 AND doc_id IS NOT NULL THEN
        row_number() OVER (PARTITION BY n >= 20 AND doc_id IS NOT NULL ORDER BY score DESC, doc_id) END AS place FROM scored
)
SELECT doc_id, n AS n_features, weight, score, n AS n_words,
       CASE WHEN place <= 10 * (SELECT count(place) FROM drawn) // 100 THEN place END AS rank FROM drawn
"""


def _values(rows: list[str]) -> str:
    return ",\n    ".join(rows)


#: Every place of every key phrase, then the places of whole templates; no index and no frequencies.
OP12_SQL = f"""
WITH phrases(t, label, base, words, k, place, phrase) AS (VALUES
    {_values([f"({t}, '{x.label}', {x.base}, {list(x.words)}, {k}, {place}, {list(own)})"
              for t, x in enumerate(license_scan.TEMPLATES) for k, (place, own) in enumerate(x.phrases)])}
), docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
stands AS (
    SELECT r, t, k, i - 1 - place AS o FROM starts JOIN phrases ON word = phrase[1] JOIN docs USING (r)
    WHERE w[i:i + len(phrase) - 1] = phrase
), whole AS (
    SELECT r, t, o FROM stands a WHERE k = 0 AND (SELECT count(*) FROM phrases p WHERE p.t = a.t) = 1 + (
        SELECT count(DISTINCT b.k) FROM stands b WHERE b.r = a.r AND b.t = a.t AND b.k > 0 AND b.o BETWEEN a.o - 8 AND a.o + 8)
), found AS (
    SELECT r, label, base, o, list_sum(list_transform(range(1, len(words) + 1), lambda q:
        (CASE WHEN o + q > 0 AND w[o + q] = words[q] THEN 1 ELSE 0 END)))::DOUBLE / len(words) AS share
    FROM whole JOIN (SELECT DISTINCT t, label, base, words FROM phrases) USING (t) JOIN docs USING (r)
), by_doc AS (
    SELECT r, count(*) FILTER (base) AS n_base, min(o) FILTER (base) AS first_word, max(o) FILTER (base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM docs LEFT JOIN by_doc USING (r)
"""

#: Every item's score of every document that shares a term.
OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, totals GROUP BY term, docs),
asked AS (SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest({_WORDS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
scores AS (
    SELECT item_id, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (r), totals GROUP BY item_id, r
), placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scores JOIN sizes USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_ngram_jaccard_join": OP5_SQL, "op7_chat_format": OP7_SQL, "op8_embedding_dedup": OP8_SQL,
            "op11_importance_resampling": OP11_SQL, "op12_license_scan": OP12_SQL, "op13_lexical_search": OP13_SQL}
