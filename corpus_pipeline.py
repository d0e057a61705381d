"""A corpus pipeline: five stages, each by one of the operators of ``marquee.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the columns of documents (the last one adds its result).
Null texts are passed on as empty by the operators; a table without rows stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate, ngram_join, pii, sentencepiece_scan, toxicity
from marquee.llm.common import read, stage
from marquee.llm.queries import MODEL, PSEUDONYM_KEY
from marquee.session import free_unread, recording, release


_scratch: list = []     # tables that the stages stored and nobody has finished with


def _stage(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that deletes what earlier stages stored, unless ``docs`` still reads it, and records what it stores itself.

    So a stage's result is to be written, or passed on to the next stage, before another one is called.
    """
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_unread(_scratch, docs)
        with recording(_scratch):
            return step(spark, docs, sf_dir)
    run.__name__, run.__doc__ = step.__name__, step.__doc__
    return run


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row as one column beside the text: operators may add columns of any name."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the grammar's insults are learned from labels that are not held out."""
    terms = toxicity.learn_terms(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_documents(_packed(docs), terms).where("predicted = 0").select("_row.*")


@_stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates one row stays, that with the least doc_id; documents without words all stay."""
    return ngram_join.one_of_each(docs)


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.find_leaks(_packed(docs), read(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("_row.*")


@_stage
def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values in the texts are replaced."""
    return pii.pseudonymise(docs, PSEUDONYM_KEY).select(*(F.col(f"`{c}`") for c in docs.columns))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, token ids and their number; decoding gives the text back."""
    encoded = sentencepiece_scan.encode_texts(docs, sentencepiece_scan.load_vocabulary(MODEL))
    return encoded.select("doc_id", "text", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", one_of_each_group), ("benchmark decontamination", drop_leaks),
          ("PII", pseudonymise), ("SentencePiece encoding", encode)]

# SQL has no grammar learning, similarity join or best-path encoding: tests compare with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's rows are written and read again, and deleted when the next stage's are there."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            release(before)
        before = docs
    free_unread(_scratch, docs)
    return docs
