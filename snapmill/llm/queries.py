"""Registered queries of the training-data operators over the driver's tables.

Hard negatives and common lines have an equivalent SQL. The others have none that ends in reasonable time on
whole tables (models, indexes, graphs and file formats); their tests compare them with brute force, exact
round trips or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmill.llm import (anngraph, decontam, hardneg, langid, lineindex, packing, pagetext, quality, runindex, simhash, tokenfile,
                          toxicity, wordindex)
from snapmill.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anngraph.nearest(read(spark, sf_dir, "embeddings"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = tokenfile.token_file(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.main_text(read(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(read(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordindex.variants(read(spark, sf_dir, "documents"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineindex.drop_common_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_decontaminate, op4_neighbours, op5_suffix_dedup,
                                               op6_tokens, op7_quality, op8_html, op9_packing, op10_language, op11_hard_negatives, op12_spelling,
                                               op13_lines)}
ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id != b.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
             AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
    "op13_lines": """
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
        k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        c AS (SELECT key FROM k WHERE key != '' GROUP BY key HAVING count(DISTINCT row) >= 10)
        SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN c ON k.key = c.key GROUP BY k.row, k.doc_id""",
}
