"""Per-key summaries of the facts: the only form in which one fact meets another.

A report that joins two facts on ProductID multiplies their rows. The multiplied counts are part of the
result, the multiplied rows are not: with ``a`` rows on one side and ``b`` on the other, the pair count of a key
is ``a * b`` and a sum over the left side is ``sum * b`` (``sum * max(b, 1)`` under a left join). So each fact is
first reduced to one row per key, inside each task before the shuffle, and a key that holds a third of
either fact contributes one row to the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartrail.functions.metrics import is_checkout_purchase, is_purchase


def journeys_per(journey: DataFrame, *keys: str) -> DataFrame:
    """``journeys`` (rows), ``purchases`` and ``checkout_purchases`` per key."""
    return journey.groupBy(*keys).agg(
        F.expr("count(*) AS journeys"),
        F.count_if(is_purchase()).alias("purchases"),
        F.count_if(is_checkout_purchase()).alias("checkout_purchases"),
    )


def purchases_per(journey: DataFrame, *keys: str) -> DataFrame:
    """``purchases`` per key, keys without one left out; the predicate reaches the scan."""
    return journey.where(is_purchase()).groupBy(*keys).agg(F.expr("count(*) AS purchases"))


def ratings_per(reviews: DataFrame, *keys: str) -> DataFrame:
    """``reviews`` (rows), ``rated`` (rows with a rating) and ``stars`` (their sum) per key."""
    return reviews.groupBy(*keys).agg(
        F.expr("count(*) AS reviews"), F.expr("count(Rating) AS rated"), F.expr("sum(CAST(Rating AS BIGINT)) AS stars")
    )


def engagement_per(engagement: DataFrame, *keys: str) -> DataFrame:
    """``engagements`` (rows), value counts and sums of Views and Clicks, sum of Likes per key."""
    return engagement.groupBy(*keys).agg(
        F.expr("count(*) AS engagements"),
        F.expr("count(Views) AS viewed"),
        F.expr("sum(CAST(Views AS BIGINT)) AS views"),
        F.expr("count(Clicks) AS clicked"),
        F.expr("sum(CAST(Clicks AS BIGINT)) AS clicks"),
        F.expr("sum(CAST(Likes AS BIGINT)) AS likes"),
    )
