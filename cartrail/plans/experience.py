"""Customer-experience reports: review sentiment, complaints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.functions.metrics import (
    NEGATIVE,
    NEUTRAL,
    POSITIVE,
    rating_sentiment,
    rating_sentiment_label,
    rounded_ratio,
    score_label,
)
from cartrail.operators.joins import lookup_join
from cartrail.operators.membership import key_filter
from cartrail.operators.summaries import ratings_per
from cartrail.sources.sinks import work_dir
from cartrail.star import Star

#: characters of a text that go with its digest
START = 16


def _named_reviews(star: Star, reviews: DataFrame) -> DataFrame:
    return lookup_join(reviews, star.products.select("ProductID", "ProductName"), "ProductID", ["ReviewID"])


def review_sentiment(star: Star) -> DataFrame:
    """Every review with the -1/0/1 sentiment of its rating."""
    return _named_reviews(star, star.reviews).select(
        "ProductID", "ProductName", "ReviewText", "Rating", rating_sentiment("Rating").alias("Sentiment")
    )


def sentiment_distribution(star: Star) -> DataFrame:
    """Share of reviews per sentiment label, in percent, by label."""
    names = (NEGATIVE, NEUTRAL, POSITIVE)
    labelled = star.reviews.select("ProductID", rating_sentiment("Rating").alias("Sentiment"))
    labelled = labelled.select("ProductID", score_label("Sentiment").alias("Category"))
    per_product = labelled.groupBy("ProductID").agg(*[F.expr(f"count_if(Category = '{n}') AS {n}") for n in names])
    total = per_product.join(star.products.select("ProductID"), "ProductID").agg(*[F.sum(n).alias(n) for n in names])
    everything = " + ".join(names)
    shares = ", ".join(f"'{n}', CAST({n} AS DOUBLE) / CAST({everything} AS DOUBLE) * 100D" for n in names)
    shared = total.where(f"{everything} > 0").selectExpr(f"stack({len(names)}, {shares}) AS (Category, Percentage)")
    return shared.where("Percentage > 0").orderBy("Category")


def sentiment_summary(star: Star) -> DataFrame:
    """Reviews and average rating per sentiment label of the rating."""
    per_product = ratings_per(star.reviews, "ProductID", "Rating").join(star.products.select("ProductID"), "ProductID")
    totals = per_product.groupBy(rating_sentiment_label("Rating").alias("Sentiment")).agg(
        F.sum("reviews").alias("Total_Reviews"), F.sum("stars").alias("stars"), F.sum("rated").alias("rated")
    )
    scored = totals.select(
        "Sentiment", "Total_Reviews", rounded_ratio("stars", "rated", 2).alias("Avg_Rating")
    )
    return scored.orderBy(F.desc("Avg_Rating"), "Sentiment")


def is_low_rated(max_rating: int = 2) -> Column:
    return F.col("Rating") <= max_rating


def negative_reviews(star: Star, max_rating: int = 2) -> DataFrame:
    low = star.reviews.where(is_low_rated(max_rating))
    return _named_reviews(star, low).select("ReviewID", "ProductID", "ProductName", "ReviewText", "Rating")


def _mentions(star: Star, reviews: DataFrame, text: list[str]) -> DataFrame:
    """How often the ``text`` columns occur for a product name; equal ones of a product are counted before the join."""
    counted = reviews.groupBy("ProductID", *text).agg(F.expr("count(*) AS mentions"))
    named = lookup_join(counted, star.products.select("ProductID", "ProductName"), "ProductID", text[:1])
    return named.groupBy(*text, "ProductName").agg(F.sum("mentions").alias("Frequency"))


def _may_be_common(star: Star, reviews: DataFrame, k: int) -> Column:
    """False only for reviews whose text is none of the ``k`` most frequent; computed when called, from digests.

    A text's first characters go with its digest, because equal frequencies are ordered by the text. Texts that
    agree in both with the k-th are let through as well, so the order among them is decided by the whole texts.
    """
    spark = reviews.sparkSession
    digest = F.unhex(F.sha2("ReviewText", 256))
    start = F.substring("ReviewText", 1, START).alias("start")
    path = work_dir(spark)
    counts = _mentions(star, reviews.select("ProductID", digest.alias("digest"), start), ["digest", "start"])
    counts.write.parquet(path)
    stored = spark.read.schema(counts.schema).parquet(path)
    first = stored.orderBy(F.desc("Frequency"), "start").select("Frequency", "start").limit(k).collect()
    if len(first) < k:
        return F.lit(True)
    least, border = first[-1]
    tied = F.col("start").isNull() if border is None else F.col("start").isNull() | (F.col("start") <= F.lit(border))
    ahead = (F.col("Frequency") > least) | ((F.col("Frequency") == least) & tied)
    return key_filter(stored.where(ahead).select("digest")).may_contain(digest)


def common_complaints(star: Star, k: int = 10, max_rating: int = 2, wide: bool = False) -> DataFrame:
    """Texts of low-rated reviews by how often they occur for a product name.

    Equal texts of a product are counted before the join, so only distinct ones travel. ``wide`` is for long texts that
    are mostly different: their SHA-256 digests are counted first, when called, and only texts that may be among the
    ``k`` move, counted anew, so a false hit of the filter changes nothing. The reviews are read twice then. Texts that
    ignore case are compared by no digest and go the plain way.
    """
    low = star.reviews.where(is_low_rated(max_rating)).select("ProductID", "ReviewText")
    if wide and k > 0 and dict(low.dtypes)["ReviewText"] == "string":
        low = low.where(_may_be_common(star, low, k))
    return _mentions(star, low, ["ReviewText"]).orderBy(F.desc("Frequency"), "ReviewText", "ProductName").limit(k)


def negatively_reviewed_products(star: Star) -> DataFrame:
    """Distinct names of products with at least one review of negative sentiment."""
    ids = star.reviews.where(rating_sentiment("Rating") < 0).select("ProductID").distinct()
    return ids.join(star.products, "ProductID").select("ProductName").distinct()
