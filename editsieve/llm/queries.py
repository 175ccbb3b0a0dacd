"""The query of each operator, with production parameters over the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from editsieve.llm import forest, html, jaccard, languages, negatives, packing, pieces, pitmanyor, quality, spelling, substrings, topk, toxicity
from editsieve.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query()
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(oracle=r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    sets AS (
        SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS shingle
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
        FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ),
    links AS (
        SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
        WHERE 100 * c >= 80 * (s.n + t.n - c)
    ),
    reached AS (
        SELECT doc_id AS x, doc_id AS y FROM words
        UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
    )
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM words w LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
""")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query()
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(oracle=r"""
    WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos,
               unnest(list_transform(range(1, len(w) - 11), lambda i: md5(array_to_string(w[i:i + 12], ' ')))) AS held
        FROM words WHERE len(w) >= 13
    ),
    firsts AS (SELECT held, min(doc_id) AS first_id FROM windows GROUP BY held),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
        FROM windows JOIN firsts USING (held) WHERE first_id < doc_id
    ),
    placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
        FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model, prior = quality.fit_form(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, prior).select("doc_id", "quality_score", "is_good")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, toxicity.of_labels(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    return toxicity.predict(docs, chain).select("doc_id", "p_poor", "p_toxic", "is_toxic")


@query(oracle="""
    WITH held AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
        FROM held a JOIN held b ON a.vec_id <> b.vec_id AND len(a.vec) = len(b.vec) WHERE a.vec_id % 50 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5
""")
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score(table(spark, sf_dir, "documents"))


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query(oracle="""
    WITH held AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
        FROM held a JOIN held b ON a.vec_id <> b.vec_id AND len(a.vec) = len(b.vec)
        WHERE a.vec_id % 50 = 0
    ),
    positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
           s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id
    WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
    QUALIFY rank <= 3
""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.held_out(table(spark, sf_dir, "documents"))
