"""One query per operator, over its whole table, with production parameters; SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercast.llm import ann, answers, centroids, conversations, embedding_dedup, exact_dedup, line_dedup, lm_scoring, near_dedup, packing, quality, secret_scans, sentencepiece_codec, suffix_dedup
from tiercast.llm.tables import read


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(read(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.clean(read(spark, sf_dir, "documents"))
    return made.select("_row.doc_id", "_row.text", "_lines.n_lines", "_lines.n_removed")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sentencepiece_codec.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return made.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "parity", "restored")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffix_dedup.dedup(read(spark, sf_dir, "documents"), kept=False)
    return made.drop("kept")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return made.select("doc_id", "evidence", "host_rate", "path_rate", "bad", "keep")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(ann.index(vectors), vectors.where("vec_id % 20 = 0"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.report(read(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(read(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.classes(read(spark, sf_dir, "embeddings"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(read(spark, sf_dir, "conversations"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_near_dedup": op3_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_nearest": op8_nearest,
    "op9_secret_scans": op9_secret_scans,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_conversations": op12_conversations,
    "op13_centroids": op13_centroids,
}

ORACLES = {
    "op2_lm_scoring": r"""
WITH words AS (
  SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM (
    SELECT doc_id, unnest(parts) AS w, unnest(range(len(parts))) AS i FROM (
      SELECT doc_id, string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+') AS parts FROM documents))
  WHERE w <> ''
), grams AS (
  SELECT doc_id, i, w AS g1,
         CASE WHEN i > 1 THEN lag(w) OVER d || ' ' || w END AS g2,
         CASE WHEN i > 2 THEN lag(w, 2) OVER d || ' ' || lag(w) OVER d || ' ' || w END AS g3
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), totals AS (SELECT doc_id, count(*) AS n, sum(count(*)) OVER () AS total FROM words GROUP BY doc_id),
outside AS (
  SELECT doc_id, i,
         count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
         CASE WHEN g2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) END AS c2,
         CASE WHEN g3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) END AS c3
  FROM grams
), chained AS (
  SELECT *, lag(c1) OVER d AS p1, lag(c2) OVER d AS p2, least(i - 1, 2) AS depth
  FROM outside WINDOW d AS (PARTITION BY doc_id ORDER BY i)
)
SELECT d.doc_id, coalesce(max(t.n), 0) AS n_words,
       coalesce(sum(CAST(round(1000000 * CASE
         WHEN c3 > 0 THEN ln(c3::DOUBLE / p2)
         WHEN c2 > 0 THEN ln(c2::DOUBLE / p1) + (depth - 1) * ln(0.4::DOUBLE)
         ELSE ln(greatest(c1, 1)::DOUBLE / greatest(t.total - t.n, 1)) + depth * ln(0.4::DOUBLE) END) AS BIGINT)), 0)::BIGINT AS score_micro
FROM documents d LEFT JOIN chained USING (doc_id) LEFT JOIN totals t USING (doc_id)
GROUP BY d.doc_id
""",
    "op4_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), keyed AS (SELECT doc_id, source, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
spread AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT coalesce(source, '')) >= 5
), numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL
), marked AS (
  SELECT n.*, s.k IS NOT NULL AS gone
  FROM numbered n LEFT JOIN spread s ON trim(n.line, ' ' || chr(9) || chr(13)) = s.k
)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(m.line, chr(10) ORDER BY m.i) FILTER (NOT m.gone), '') END AS text,
       count(m.i) AS n_lines, count(*) FILTER (m.gone) AS n_removed
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id
GROUP BY d.doc_id, d.text
""",
    "op10_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
""",
    "op11_embedding_dedup": answers.VECTOR_DEDUP,
    "op12_conversations": answers.CONVERSATIONS,
    "op13_centroids": answers.CENTROIDS,
}
