"""The operators' queries, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chunk_dedup, conversation_repair, decontaminate, ngram_join, pattern_packing, pii, secret_scan, sentencepiece_scan,
               suffix_dedup, toxicity, voronoi_knn, warc, whitening)
from .common import read

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PSEUDONYM_KEY = "query key; a real one belongs in a secret store"


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.pages_as_responses(read(spark, sf_dir, "pages")))


def op2_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    changed = pii.pseudonymise(docs.withColumn("n_found", F.size(pii.personal_values())), PSEUDONYM_KEY)
    return changed.select("doc_id", "n_found", "text")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(read(spark, sf_dir, "documents")))


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.deduplicate(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    terms = toxicity.learn_terms(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.withColumn("held_out", toxicity.held_out()), terms)
    return scored.select("doc_id", "held_out", "score", "predicted", "n_clauses")


def op6_sentencepiece_scan(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    vocabulary = sentencepiece_scan.load_vocabulary(model)
    encoded = sentencepiece_scan.encode_texts(read(spark, sf_dir, "documents"), vocabulary)
    back = sentencepiece_scan.decode_ids(encoded, vocabulary)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "score", "ids",
                       (F.col("decoded") == F.col("text")).alias("round_trip"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op9_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where(voronoi_knn.valid(F.col("embedding")))
    return voronoi_knn.top_k(rows.select("vec_id", voronoi_knn.quantised(F.col("embedding")).alias("v")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("l")).groupBy("doc_id", F.col("l.item_id").alias("item_id")) \
        .agg(F.max("l.cosine").alias("cosine"), F.max("l.lcs").alias("lcs"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where(whitening.valid(F.col("embedding")))
    return whitening.whiten(rows.select("vec_id", whitening.quantised(F.col("embedding")).alias("x")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    report, repaired = conversation_repair.repair(conversation_repair.damage(rows))
    return conversation_repair.report_all(rows, report, conversation_repair.digests(repaired))


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc_derivatives, op2_pii_feistel, op3_secret_scan, op4_chunk_dedup, op5_toxicity, op6_sentencepiece_scan,
    op7_suffix_dedup, op8_ngram_jaccard, op9_voronoi_knn, op10_decontaminate, op11_whitening, op12_conversation_repair,
    op13_pattern_packing, pipeline)}

# components are floats of at most 64 terms: the products are exact integers in double precision
ORACLES: dict[str, str] = {
    "op9_voronoi_knn": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20""",
}
