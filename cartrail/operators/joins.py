"""Joins of single fact rows to a table that holds one row per key.

Reports aggregate before they join wherever the result allows it, so most joins here see one row per key on
both sides. What is left goes through ``lookup_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: a key is hot when it holds more than this share of the rows, so there are fewer than 1/HOT_SHARE of them
HOT_SHARE = 1 / 1000


def _splits_skew(spark: SparkSession) -> bool:
    """Whether adaptive execution is set to split skewed join partitions (it is by default)."""
    settings = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(name, "true").lower() == "true" for name in settings)


def lookup_join(fact: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], how: str = "inner") -> DataFrame:
    """Join fact rows to ``lookup`` on ``key`` without leaving a hot key to one task.

    Spark broadcasts the lookup when its size is within ``spark.sql.autoBroadcastJoinThreshold``, as estimated
    before and measured during the run; then no fact row moves. A larger one is shuffled, and adaptive
    execution splits the partition of a hot key over many tasks, without a pass over the data beforehand. It
    can do so only where both sides come straight from a shuffle and nothing groups by ``key`` right after the
    join; a ``lookup`` that is itself an aggregate by ``key`` needs ``salted_join``. In a session that has
    splitting switched off, the hot keys are salted instead.
    """
    if _splits_skew(fact.sparkSession):
        return fact.join(lookup, key, how)
    return salted_join(fact, lookup, key, spread_by, how)


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of all keyed rows: exact, and fewer than ``1 / share`` rows."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(F.col("_rows") > total * F.lit(share)).select(key)


def salted_join(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "inner",
    salts: int | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Shuffle join in which every hot key is spread over ``salts`` partitions; results equal the plain join.

    Fact rows of a hot key get a salt from a hash of ``spread_by``; the lookup row of that key is repeated
    once per salt. Rows without a key match nothing, so they are spread as well. The salt depends on row
    values only, so a recomputed task sends every row where it went before. Only the hot keys are broadcast,
    fewer than ``1 / share`` rows.
    """
    if salts is None:
        salts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(fact, key, share).withColumn("_hot", F.lit(True))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted_fact = fact.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(copies))
    joined = salted_fact.drop("_hot").join(salted_lookup.drop("_hot"), [key, "_salt"], how)
    return joined.drop("_salt")
