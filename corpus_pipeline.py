"""From raw documents to tokens: toxicity, line dedup, near-dedup, mixing to target weights, BPE encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartrail.llm import bpe, line_dedup, mixing, simhash, toxicity
from cartrail.llm.common import table, written
from cartrail.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.drop_toxic(docs, model)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their hosts' boilerplate; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs)
    length = F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, ids, decoded_sha256`` of every document, as often as the mix holds it."""
    coded = bpe.encode_documents(docs, vocabulary_path(), [F.col(c) for c in ("doc_id", "source", "lang")])
    return coded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: the learned model, XXH64 and the merges have no form in SQL; tests/llm holds the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
