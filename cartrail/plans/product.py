"""Product reports: popularity, conversion, ratings, drop-off."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.functions.metrics import is_checkout_purchase, is_drop_off, pct, rounded_ratio
from cartrail.operators.joins import lookup_join
from cartrail.operators.profile import correlation_matrix
from cartrail.operators.summaries import journeys_per, purchases_per, ratings_per
from cartrail.star import Star


def top_products(star: Star, k: int = 5) -> DataFrame:
    """Product names by number of journeys."""
    named = journeys_per(star.journey, "ProductID").join(star.products, "ProductID")
    counted = named.groupBy("ProductName").agg(F.sum("journeys").alias("Total_Interactions"))
    return counted.orderBy(F.desc("Total_Interactions"), "ProductName").limit(k)


def product_conversion(star: Star) -> DataFrame:
    """Checkout purchases per distinct customer, by product name; the price is averaged over journeys."""
    visits = star.journey.groupBy("ProductID", "CustomerID").agg(
        F.expr("count(*) AS visits"), F.count_if(is_checkout_purchase()).alias("bought")
    )
    catalogue = star.products.selectExpr("ProductID", "ProductName", "CAST(Price * 100 AS BIGINT) AS cents")
    named = lookup_join(visits, catalogue, "ProductID", spread_by=["CustomerID"])
    totals = named.groupBy("ProductName").agg(
        F.expr("sum(cents * visits) AS cents"),
        F.expr("sum(if(cents IS NULL, 0, visits)) AS priced"),
        F.count_distinct("CustomerID").alias("Unique_Customers"),
        F.sum("bought").alias("Total_Purchases"),
    )
    rated = totals.select(
        "ProductName",
        rounded_ratio("cents", "(priced * 100)", 2).alias("Avg_Price"),
        "Unique_Customers",
        "Total_Purchases",
        pct("Total_Purchases", "Unique_Customers").alias("Conversion_Rate"),
    )
    return rated.orderBy(F.desc("Conversion_Rate"), F.desc("Total_Purchases"), "ProductName")


def _purchase_share(star: Star) -> DataFrame:
    """Journeys and purchases per journey, by product name."""
    named = journeys_per(star.journey, "ProductID").join(star.products, "ProductID")
    totals = named.groupBy("ProductName").agg(
        F.sum("journeys").alias("interactions"), F.sum("purchases").alias("purchases")
    )
    return totals.withColumn("conversion_rate", pct("purchases", "interactions"))


def flagship_product(star: Star, k: int = 1) -> DataFrame:
    """The product name with the highest share of journeys that are purchases."""
    best = _purchase_share(star).orderBy(F.desc("conversion_rate"), "ProductName").limit(k)
    return best.select("ProductName", "conversion_rate")


def top_converting_products(star: Star, k: int = 5) -> DataFrame:
    """As ``flagship_product``, with the number of journeys."""
    best = _purchase_share(star).orderBy(F.desc("conversion_rate"), "ProductName").limit(k)
    return best.select("ProductName", "interactions", "conversion_rate")


def product_purchases(star: Star) -> DataFrame:
    """Checkout purchases per product."""
    named = journeys_per(star.journey, "ProductID").join(star.products, "ProductID")
    return named.groupBy("ProductID", "ProductName").agg(F.sum("checkout_purchases").alias("Total_Purchases"))


def _ratings_by(star: Star, *keys: str) -> DataFrame:
    named = ratings_per(star.reviews, "ProductID").join(star.products, "ProductID")
    return named.groupBy(*keys).agg(
        F.sum("reviews").alias("reviews"), F.sum("rated").alias("rated"), F.sum("stars").alias("stars")
    )


def _average(digits: int = 4) -> Column:
    return rounded_ratio("stars", "rated", digits)


def highest_rated_products(star: Star, k: int = 5) -> DataFrame:
    rated = _ratings_by(star, "ProductID", "ProductName").withColumn("AvgRating", _average())
    best = rated.orderBy(F.desc("AvgRating"), "ProductID", "ProductName").limit(k)
    return best.select("ProductID", "ProductName", "AvgRating")


def lowest_rated_products(star: Star, k: int = 5) -> DataFrame:
    rated = _ratings_by(star, "ProductID", "ProductName").withColumn("AvgRating", _average())
    worst = rated.orderBy(F.asc_nulls_first("AvgRating"), "ProductID", "ProductName").limit(k)
    return worst.select("ProductID", "ProductName", "AvgRating", F.col("reviews").alias("ReviewCount"))


def top_rated_by_name(star: Star, k: int = 5) -> DataFrame:
    rated = _ratings_by(star, "ProductName").select("ProductName", _average(1).alias("AvgRating"))
    return rated.orderBy(F.desc("AvgRating"), "ProductName").limit(k)


def top_rated_ids(star: Star, k: int = 5) -> DataFrame:
    rated = ratings_per(star.reviews, "ProductID").select("ProductID", _average().alias("AvgRating"))
    return rated.orderBy(F.desc("AvgRating"), "ProductID").limit(k)


def lowest_rated_ids(star: Star, k: int = 5) -> DataFrame:
    rated = ratings_per(star.reviews, "ProductID").select(
        "ProductID", _average().alias("AvgRating"), F.col("reviews").alias("ReviewCount")
    )
    return rated.orderBy(F.asc_nulls_first("AvgRating"), "ProductID").limit(k)


def reviews_per_product(star: Star) -> DataFrame:
    rated = _ratings_by(star, "ProductID", "ProductName").select(
        "ProductID", "ProductName", F.col("reviews").alias("ReviewCount"), _average().alias("AvgRating")
    )
    return rated.orderBy(F.desc("ReviewCount"), "ProductID", "ProductName")


def product_ratings(star: Star) -> DataFrame:
    return _ratings_by(star, "ProductID", "ProductName").select(
        "ProductID", "ProductName", _average(2).alias("Avg_Rating"), F.col("reviews").alias("Review_Count")
    )


def rating_purchase_correlation(star: Star) -> DataFrame:
    """Pearson correlation of average rating and checkout purchases over products: one row.

    NULL when either side does not vary.
    """
    paired = product_ratings(star).join(product_purchases(star), ["ProductID", "ProductName"])
    spread = "stddev_pop(Avg_Rating) * stddev_pop(Total_Purchases)"
    return paired.agg(
        F.expr("count(*) AS products"),
        F.expr(f"try_divide(covar_pop(Avg_Rating, Total_Purchases), {spread}) AS correlation"),
    )


def product_correlations(star: Star) -> DataFrame:
    """Correlations of price, ratings and purchases over products; those without a review or journey count where they can."""
    rated = product_ratings(star).select("ProductID", "Avg_Rating", "Review_Count")
    bought = product_purchases(star).select("ProductID", "Total_Purchases")
    every = star.products.select("ProductID", "Price").join(rated, "ProductID", "left").join(bought, "ProductID", "left")
    return correlation_matrix(every, "Price", "Avg_Rating", "Review_Count", "Total_Purchases")


def dropoff_rate(star: Star) -> DataFrame:
    """Share of a stage's journeys that are drop-offs."""
    per_stage = star.journey.groupBy("Stage").agg(
        F.expr("count(*) AS Total_Visits"), F.count_if(is_drop_off()).alias("Dropoffs")
    )
    rated = per_stage.withColumn("Dropoff_Rate", pct("Dropoffs", "Total_Visits"))
    return rated.orderBy(F.desc("Dropoff_Rate"), "Stage")


def dropoff_counts(star: Star) -> DataFrame:
    counted = star.journey.where(is_drop_off()).groupBy("Stage").agg(F.expr("count(*) AS DropOffCount"))
    return counted.orderBy(F.desc("DropOffCount"), "Stage")


def avg_stage_duration(journey: DataFrame) -> DataFrame:
    """Journeys with a duration and their average, by stage.

    Takes the journey table itself because the answer depends on which one: cleaning turns a missing
    duration into 0, so on the cleaned table the filter keeps every row.
    """
    timed = journey.where(F.col("Duration").isNotNull())
    per_stage = timed.groupBy("Stage").agg(
        F.expr("count(*) AS Total_Visits"), F.expr("round(avg(Duration), 2) AS Avg_Duration_Seconds")
    )
    return per_stage.orderBy(F.desc("Avg_Duration_Seconds"), "Stage")


def best_sellers(star: Star, k: int = 3) -> DataFrame:
    """The ``k`` product ids with the most purchases."""
    sold = purchases_per(star.journey, "ProductID")
    return sold.orderBy(F.desc("purchases"), "ProductID").limit(k).select("ProductID")


def outside_best_sellers(star: Star, k: int = 3) -> DataFrame:
    """Products that are not among the ``k`` best sellers (at most ``k`` rows are broadcast)."""
    return star.products.join(F.broadcast(best_sellers(star, k)), "ProductID", "left_anti")


def discount_candidates(
    star: Star, k: int = 1, max_rating: float = 3.5, min_reviews: int = 5, best: int = 3
) -> DataFrame:
    """Lowest rated product names with enough reviews, best sellers left out."""
    rated = outside_best_sellers(star, best).join(ratings_per(star.reviews, "ProductID"), "ProductID", "left")
    per_name = rated.groupBy("ProductName").agg(
        F.sum("stars").alias("stars"),
        F.sum("rated").alias("rated"),
        F.expr("coalesce(sum(reviews), 0) AS review_count"),
    )
    # the exact average decides, in whole numbers; it is rounded for output only
    low = per_name.where(f"stars < {Decimal(str(max_rating))}BD * rated AND review_count > {min_reviews}")
    kept = low.select("ProductName", _average().alias("avg_rating"), "review_count")
    return kept.orderBy(F.asc_nulls_first("avg_rating"), "ProductName").limit(k)
