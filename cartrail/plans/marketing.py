"""Marketing reports: channels, engagement and the products behind them.

Every report here joins two or three facts on ProductID and counts the multiplied rows. All of them work on
per-key summaries (``operators.summaries``), never on the multiplied rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartrail.functions.metrics import at_least_one, pct, rounded_ratio, wide, wide_sum
from cartrail.operators.joins import salted_join
from cartrail.operators.summaries import engagement_per, journeys_per, purchases_per, ratings_per
from cartrail.star import Star


def _distinct_engagements(engagement: DataFrame) -> DataFrame:
    return engagement.groupBy("ContentType").agg(F.count_distinct("EngagementID").alias("Total_Engagements"))


def _with_engagements(fanned: DataFrame, distinct: DataFrame) -> DataFrame:
    """Put the distinct engagement count next to the fanned-out sums; both have one row per content type."""
    same = F.col("fanned.ContentType").eqNullSafe(F.col("counted.ContentType"))
    return fanned.alias("fanned").join(distinct.alias("counted"), same).select("counted.Total_Engagements", "fanned.*")


def engagement_conversion(star: Star) -> DataFrame:
    """Checkout purchases of the product per distinct engagement, by content type."""
    visited = journeys_per(star.journey, "ProductID").select("ProductID", "checkout_purchases")
    fanned = (
        engagement_per(star.engagement, "ProductID", "ContentType")
        .join(visited, "ProductID")
        .groupBy("ContentType")
        .agg(wide_sum(f"{wide('engagements')} * {wide('checkout_purchases')}").alias("Total_Purchases"))
    )
    # an aggregate between its shuffle and the join keeps adaptive execution from splitting a hot product
    seen = salted_join(
        star.engagement.select("ProductID", "ContentType", "EngagementID"),
        star.journey.select("ProductID").distinct(),
        "ProductID",
        spread_by=["EngagementID"],
    )
    rated = _with_engagements(fanned, _distinct_engagements(seen)).select(
        "ContentType",
        "Total_Engagements",
        "Total_Purchases",
        pct("Total_Purchases", "Total_Engagements").alias("Conversion_Rate"),
    )
    return rated.orderBy(F.desc("Conversion_Rate"), "ContentType")


def engagement_likes(star: Star) -> DataFrame:
    """As ``engagement_conversion`` with likes, keeping engagements whose product was never visited."""
    visited = journeys_per(star.journey, "ProductID").select("ProductID", "journeys", "checkout_purchases")
    fanned = (
        engagement_per(star.engagement, "ProductID", "ContentType")
        .join(visited, "ProductID", "left")
        .groupBy("ContentType")
        .agg(
            wide_sum(f"likes * {at_least_one('journeys')}").alias("Total_Likes"),
            wide_sum(f"{wide('engagements')} * {wide('checkout_purchases')}").alias("Total_Purchases"),
        )
    )
    rated = _with_engagements(fanned, _distinct_engagements(star.engagement)).select(
        "ContentType",
        "Total_Engagements",
        "Total_Likes",
        "Total_Purchases",
        pct("Total_Purchases", "Total_Engagements").alias("Conversion_Rate"),
    )
    return rated.orderBy(F.desc("Conversion_Rate"), "ContentType")


def underperforming_products(star: Star, k: int = 5) -> DataFrame:
    """Product names by average rating, then purchases, lowest first; unrated names lead."""
    bought = at_least_one("purchases")
    per_name = (
        star.products.select("ProductID", "ProductName")
        .join(ratings_per(star.reviews, "ProductID"), "ProductID", "left")
        .join(purchases_per(star.journey, "ProductID"), "ProductID", "left")
        .groupBy("ProductName")
        .agg(
            wide_sum(f"{wide('stars')} * {bought}").alias("stars"),
            wide_sum(f"{wide('rated')} * {bought}").alias("rated"),
            wide_sum(f"{at_least_one('reviews')} * {wide('purchases')}").alias("PurchaseCount"),
        )
    )
    scored = per_name.select(
        "ProductName", rounded_ratio("stars", "rated", 4).alias("AvgRating"), "PurchaseCount"
    )
    return scored.orderBy(F.asc_nulls_first("AvgRating"), "PurchaseCount", "ProductName").limit(k)


def geo_performance(star: Star) -> DataFrame:
    """Purchases by place, multiplied by the reviews of the bought product, and the average of those reviews."""
    sums = [wide_sum(name).alias(name) for name in ("bought", "stars", "rated")]
    homes = star.customers.select("CustomerID", "GeographyID")
    # a product has a row per place at most when it meets its ratings, however often it is bought
    sold = (
        purchases_per(star.journey, "CustomerID", "ProductID")
        .join(homes, "CustomerID")
        .groupBy("GeographyID", "ProductID")
        .agg(F.sum("purchases").alias("purchases"))
    )
    rated = sold.join(ratings_per(star.reviews, "ProductID"), "ProductID", "left")
    per_place = rated.groupBy("GeographyID").agg(
        wide_sum(f"{wide('purchases')} * {at_least_one('reviews')}").alias("bought"),
        wide_sum(f"{wide('purchases')} * {wide('stars')}").alias("stars"),
        wide_sum(f"{wide('purchases')} * {wide('rated')}").alias("rated"),
    )
    per_city = star.geography.join(per_place, "GeographyID", "left").groupBy("Country", "City").agg(*sums)
    scored = per_city.select(
        "Country",
        "City",
        F.expr(f"{wide('bought')} AS Purchases"),
        rounded_ratio("stars", "rated", 4).alias("AvgRating"),
    )
    return scored.orderBy(F.desc("Purchases"), F.desc("AvgRating"), "Country", "City")


def poorly_converting_products(star: Star, ratio: float = 0.1) -> DataFrame:
    """Product names with clicks but fewer purchases than ``ratio`` of them."""
    per_name = (
        star.products.select("ProductID", "ProductName")
        .join(engagement_per(star.engagement, "ProductID"), "ProductID", "left")
        .join(purchases_per(star.journey, "ProductID"), "ProductID", "left")
        .groupBy("ProductName")
        .agg(
            wide_sum(f"clicks * {at_least_one('purchases')}").alias("TotalClicks"),
            wide_sum(f"{at_least_one('engagements')} * {wide('purchases')}").alias("Purchases"),
        )
    )
    kept = per_name.where(f"TotalClicks > 0 AND Purchases < {Decimal(str(ratio))}BD * TotalClicks")
    return kept.orderBy("Purchases", F.desc("TotalClicks"), "ProductName")


def _channel_totals(star: Star) -> DataFrame:
    bought = at_least_one("purchases")
    return (
        engagement_per(star.engagement, "ProductID", "ContentType")
        .join(purchases_per(star.journey, "ProductID"), "ProductID", "left")
        .groupBy("ContentType")
        .agg(
            wide_sum(f"{wide('views')} * {bought}").alias("views"),
            wide_sum(f"{wide('viewed')} * {bought}").alias("viewed"),
            wide_sum(f"{wide('clicks')} * {bought}").alias("clicks"),
            wide_sum(f"{wide('clicked')} * {bought}").alias("clicked"),
            wide_sum(f"{wide('engagements')} * {wide('purchases')}").alias("Purchases"),
        )
    )


def _channel_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        "ContentType",
        rounded_ratio("views", "viewed", 4).alias("AvgViews"),
        rounded_ratio("clicks", "clicked", 4).alias("AvgClicks"),
        "Purchases",
    )


def channel_performance(star: Star) -> DataFrame:
    """Average views and clicks and the purchases of the product, by content type."""
    return _channel_columns(_channel_totals(star)).orderBy(F.desc("Purchases"), "ContentType")


def underperforming_channels(star: Star, ratio: float = 0.05) -> DataFrame:
    """Content types with fewer than ``ratio`` purchases per average click, lowest first."""
    per_click = F.expr("try_divide(CAST(Purchases AS DOUBLE) * CAST(clicked AS DOUBLE), CAST(clicks AS DOUBLE))")
    totals = _channel_totals(star).withColumn("_ratio", per_click)
    weak = totals.where(F.col("_ratio") < ratio).orderBy("_ratio", "ContentType")
    return _channel_columns(weak)


def channel_roi(star: Star) -> DataFrame:
    """Clicks and purchases over all engagement and journey pairs of a product, by content type."""
    visited = journeys_per(star.journey, "ProductID").select("ProductID", "journeys", "purchases")
    totals = (
        engagement_per(star.engagement, "ProductID", "ContentType")
        .join(visited, "ProductID")
        .groupBy("ContentType")
        .agg(
            wide_sum(f"clicks * {wide('journeys')}").alias("total_clicks"),
            wide_sum(f"{wide('engagements')} * {wide('purchases')}").alias("conversions"),
        )
    )
    rated = totals.withColumn("conversion_rate", pct("conversions", "total_clicks"))
    return rated.orderBy(F.desc("conversion_rate"), "ContentType")


def top_channel_roi(star: Star, k: int = 1) -> DataFrame:
    best = channel_roi(star).orderBy(F.desc("conversion_rate"), "ContentType").limit(k)
    return best.select("ContentType", "conversion_rate")


def rating_vs_engagement(star: Star) -> DataFrame:
    """Average rating next to views and clicks multiplied by the number of reviews, per product id."""
    paired = ratings_per(star.reviews, "ProductID").join(engagement_per(star.engagement, "ProductID"), "ProductID")
    scored = paired.select(
        "ProductID",
        rounded_ratio("stars", "rated", 1).alias("AvgRating"),
        F.expr(f"CAST(views * {wide('reviews')} AS DECIMAL(38,0)) AS TotalViews"),
        F.expr(f"CAST(clicks * {wide('reviews')} AS DECIMAL(38,0)) AS TotalClicks"),
    )
    return scored.orderBy(F.desc("AvgRating"), "ProductID")
