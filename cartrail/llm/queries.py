"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartrail.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    filter_audit,
    host_quality,
    line_dedup,
    mixing,
    secret_scan,
    sharding,
    simhash,
    topk,
    toxicity,
    url_lists,
)
from cartrail.llm.common import hash_key, table

#: environment variable that names another folder of tokenizer files
TOKENIZERS = "CARTRAIL_TOKENIZERS"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    folder = os.environ.get(TOKENIZERS)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def captures(pages: DataFrame) -> DataFrame:
    """The pages as captures of a year: the day follows from the page's id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries that follow from hashes of the pages' hosts, parent domains and first folders."""
    host, folder = url_lists.host_of(F.col("url")), url_lists.folder_of(F.col("url"))
    named = pages.select(F.explode(url_lists.patterns_of(host, folder)).alias("p")).select("p.pattern").distinct()
    each = named.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))

    def draw(what: str, sides: int) -> Column:
        return F.pmod(hash_key(what, F.col("pattern"), F.col("turn")), F.lit(sides)).cast("int")

    actions = F.array(*[F.lit(a) for a in ("block", "allow", "remove", "block")])
    listed = each.where(draw("entry", 3) == 0)
    day = F.date_add(F.lit("2024-01-01").cast("date"), draw("day", 365))
    return listed.select("pattern", F.get(actions, draw("action", 4)).alias("action"), day.alias("listed_at"))


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_lists.judge_captures(captures(pages), list_entries(pages))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model, [F.col("doc_id")])
    predicted = (F.col("toxicity") >= toxicity.LIMIT).cast("int")
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        predicted.alias("predicted"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = secret_scan.span_text(F.col("secrets"), strong_only=True)
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(F.col("secrets"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.span_text(F.col("secrets")).alias("spans"),
        secret_scan.credential_text(F.col("secrets")).alias("credentials"),
    )


def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "source", "text", "lines_dropped")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), [F.col("doc_id")])
    decoded = F.sha2(F.col("decoded"), 256).alias("decoded_sha256")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded)


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with damage that follows from a checksum of conversation and turn; ``harm`` 0 means that a row goes."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    harm = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    held = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), harm.alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    return held.select("conv_id", "turn", role.alias("role"), text.alias("text"), "harm", copies.alias("copy"))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    reports = conversation_repair.repair(rows.where("harm != 0").select("conv_id", "turn", "role", "text"))
    gone = rows.groupBy("conv_id").agg(F.max("harm").alias("harm")).where("harm = 0")
    return reports.unionByName(gone.select(*conversation_repair.untouched(F.col("conv_id"))))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = [
        op1_host_quality,
        op2_url_lists,
        op3_mix_sources,
        op4_toxicity,
        op5_simhash,
        op6_secrets,
        op7_rendezvous_shards,
        op8_line_dedup,
        op9_bpe,
        op10_exact_topk,
        op11_decontaminate,
        op12_repair_conversations,
        op13_filter_audit,
    ]
    return {query.__name__: query for query in numbered}
