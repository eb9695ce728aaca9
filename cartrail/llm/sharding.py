"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import KEY_DIGITS, hash_key, running_totals, settled

SHARDS = 8


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard that draws the highest score for ``key``: ``weight / -ln(u)``, u a hash of key and shard.

    Scores of a shard don't depend on the other shards. So a new shard, put last, takes rows only into itself,
    and a shard gets its weight's share of the keys. Equal scores go to the smaller shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    steps = float(2 ** (4 * KEY_DIGITS))

    def score(shard: int, weight: float) -> Column:
        u = (hash_key("shard", str(shard), key) + F.lit(0.5)) / F.lit(steps)
        return F.struct((F.lit(float(weight)) / -F.ln(u)).alias("score"), F.lit(-shard).alias("minus"))

    return (-F.array_max(F.array(*[score(i, w) for i, w in enumerate(weights)]))["minus"]).cast("int")


def shard(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * SHARDS,
    grown: Sequence[float] | None = (1.0,) * (SHARDS + 1),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` of every document; ``grown_shard`` under ``grown``.

    The shard depends on the id and the weights alone. ``slot`` counts the rows of a shard from 0 without gaps,
    in the order of a hash of id and text, so reruns agree; equal rows take neighbouring slots. A shard is
    numbered in pieces, never by one task. NULL ids are one key like any other; NULL texts count as empty: size
    1, checksum 0. Repeated ids share a shard. An empty table gives no rows; other columns are not looked at.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ident = F.col(f"`{doc_id}`")
    sized = docs.select(
        ident.alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        hash_key("slot", ident, F.md5(content)).alias("key"),
    )
    number = shard_of(F.col("doc_id"), weights)
    more = shard_of(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")
    rows = settled(sized.withColumn("shard", number).withColumn("grown_shard", more).withColumn("one", F.lit(1)))
    placed = running_totals(rows, "shard", "key", "one", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "shard", F.col("before").alias("slot"), "grown_shard")
