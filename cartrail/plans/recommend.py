"""Recommendation rules: report tables in, one row per line out.

Lines come as ``(rule, section, sort_key, sort_name, line)``; ordering by section, sort_key and sort_name gives
the reading order, also when a list is long, so no rule has to number its lines in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartrail.plans import customer, experience, marketing, product, wording
from cartrail.plans.text import negative_polarity_gate
from cartrail.star import Star

READING_ORDER = ("section", "sort_key", "sort_name")


def _text(value: str) -> str:
    """SQL text: a string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _fill(template: str, *values: str) -> str:
    """SQL text: the template with every value, itself SQL text, as text; a missing one reads ``None``."""
    filled = [f"coalesce(CAST({value} AS STRING), 'None')" for value in values]
    return f"format_string({', '.join([_text(template), *filled])})"


def _four_digits(name: str) -> str:
    return f"CAST({name} AS DECIMAL(38,4))"


def _say(df: DataFrame, rule: str, section: int | str, line: str, sort_key: str = "0", sort_name: str = "''") -> DataFrame:
    return df.selectExpr(
        f"'{rule}' AS rule",
        f"{section} AS section",
        f"CAST({sort_key} AS DOUBLE) AS sort_key",
        f"({sort_name}) COLLATE UTF8_BINARY AS sort_name",
        f"({line}) COLLATE UTF8_BINARY AS line",
    )


def _fixed(spark: SparkSession, rule: str, section: int, line: str) -> DataFrame:
    return _say(spark.range(1), rule, section, _text(line))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _listed(best: DataFrame, order: str, name: str) -> DataFrame:
    """Names of a few rows as one comma-separated text, ordered; no row when there are none."""
    names = best.selectExpr(f"array_sort(collect_list(struct({order} AS o, {name} AS n))).n AS names")
    return names.where("size(names) > 0").selectExpr("array_join(names, ', ') AS names")


def _best(df: DataFrame, rate: str, name: str) -> DataFrame:
    return df.orderBy(F.desc(rate), name).limit(1)


def _with_header(
    rows: DataFrame, order: list[Column], rule: str, section: int, header: str, line: str, sort_key: str, sort_name: str
) -> DataFrame:
    """A line per row, and a header in the section before where there is a row; ``rows`` are a few, limited ones."""
    numbered = rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    item = f"struct({section + 1} AS at, {line} AS said, CAST({sort_key} AS DOUBLE) AS sort_key, {sort_name} AS sort_name)"
    first = f"struct({section} AS at, {_text(header)} AS said, 0D AS sort_key, '' AS sort_name)"
    both = numbered.selectExpr(f"inline(if(place = 1, array({first}, {item}), array({item})))")
    return _say(both, rule, "at", "said", "sort_key", "sort_name")


def strategic(star: Star) -> DataFrame:
    """Best converting products, content and age band, negatively reviewed products, and the checkout line."""
    spark = star.journey.sparkSession
    rule = "strategic"
    products = product.product_conversion(star).orderBy(F.desc("Conversion_Rate"), "ProductName").limit(3)
    content = _best(marketing.engagement_conversion(star), "Conversion_Rate", "ContentType")
    ages = _best(customer.age_conversion(star), "Conversion_Rate", "Group_Value")
    listed = _listed(products, "-Conversion_Rate", "ProductName")
    negative = experience.negatively_reviewed_products(star).where("ProductName IS NOT NULL")
    return _all(
        [
            _say(listed, rule, 1, _fill(wording.TOP_CONVERTING, "names")),
            _say(content, rule, 2, _fill(wording.BEST_CONTENT, "ContentType")),
            _say(ages, rule, 3, _fill(wording.BEST_AGE, "Group_Value")),
            _say(negative, rule, 4, _fill(wording.NEGATIVE_PRODUCTS, "ProductName"), "0", "ProductName"),
            _fixed(spark, rule, 5, wording.CHECKOUT),
        ]
    )


def marketing_lines(star: Star, k: int = 5) -> DataFrame:
    """One line per underperforming product and per channel."""
    rule = "marketing"
    weak = marketing.underperforming_products(star, k)
    improve = _fill(wording.IMPROVE_PRODUCT, "ProductName", _four_digits("AvgRating"), "PurchaseCount")
    then = "concat_ws('|', lpad(CAST(PurchaseCount AS STRING), 38, '0'), ProductName)"
    channels = marketing.channel_performance(star)
    averages = [_four_digits("AvgViews"), _four_digits("AvgClicks")]
    boost = _fill(wording.BOOST_CHANNEL, "ContentType", *averages, "Purchases")
    return _all(
        [
            _say(weak, rule, 1, improve, "AvgRating", then),
            _say(channels, rule, 2, boost, "-Purchases", "ContentType"),
        ]
    )


def experience_lines(
    star: Star, lexicon: DataFrame, k: int = 5, complaints: int = 10, purchase: Column | None = None
) -> DataFrame:
    """Dissatisfaction alert, lowest-rated products, one-time purchasers, complaints; empty parts are left out."""
    rule = "experience"
    alert = negative_polarity_gate(star.reviews, lexicon).where("dissatisfied")
    lowest = product.lowest_rated_products(star, k)
    two_digits = "CAST(bround(CAST(AvgRating AS DECIMAL(20,4)), 2) AS DECIMAL(20,2))"
    rated = _fill(wording.LOWEST_ITEM, "ProductName", "ProductID", two_digits, "ReviewCount")
    once = customer.one_time_purchasers(star, purchase).selectExpr("count(*) AS n").where("n > 0")
    repeated = experience.common_complaints(star, complaints)
    by_rating, padded_id = [F.asc_nulls_first("AvgRating"), F.col("ProductID")], "lpad(CAST(ProductID AS STRING), 20, '0')"
    heard = _fill(wording.COMPLAINT_ITEM, "ReviewText", "ProductName", "Frequency")
    return _all(
        [
            _say(alert, rule, 1, _text(wording.DISSATISFIED)),
            _with_header(lowest, by_rating, rule, 2, wording.LOWEST_HEADER, rated, "AvgRating", padded_id),
            _say(once, rule, 4, _fill(wording.ONE_TIME, "n")),
            _with_header(
                repeated, [F.desc("Frequency"), F.col("ReviewText"), F.col("ProductName")], rule, 5,
                wording.COMPLAINT_HEADER, heard, "-Frequency", "concat_ws('|', ReviewText, ProductName)",
            ),
        ]
    )


def business(star: Star) -> DataFrame:
    """Flagship product, best demographic, region and channel, and a discount candidate or the fallback line."""
    rule, rate = "business", "conversion_rate"
    discount = _fill(wording.DISCOUNT, "ProductName", "avg_rating", "review_count")
    decided = product.discount_candidates(star).selectExpr(
        f"coalesce(max({discount}), {_text(wording.NO_DISCOUNT)}) AS decision"
    )
    best_group = _fill(wording.DEMOGRAPHIC, "age_group", "Gender", "Country", rate)
    best_region = _fill(wording.REGION, "ProductName", "Country", "sales")
    return _all(
        [
            _say(product.flagship_product(star), rule, 1, _fill(wording.FLAGSHIP, "ProductName", rate)),
            _say(customer.top_demographic(star), rule, 2, best_group),
            _say(customer.top_region_product(star), rule, 3, best_region),
            _say(marketing.top_channel_roi(star), rule, 4, _fill(wording.CHANNEL, "ContentType", rate)),
            _say(decided, rule, 5, "decision"),
        ]
    )


def text_report_lines(star: Star) -> DataFrame:
    """The closing lines of the text report: best customers, products and content, and three products to look at."""
    spark = star.journey.sparkSession
    rule = "text_report"
    products = product.product_conversion(star).orderBy(F.desc("Conversion_Rate"), "ProductName").limit(3)
    content = _best(marketing.engagement_conversion(star), "Conversion_Rate", "ContentType")
    negative = experience.negatively_reviewed_products(star).orderBy("ProductName").limit(3)
    top = _listed(products, "-Conversion_Rate", "ProductName")
    disliked = _listed(negative, "ProductName", "ProductName")
    return _all(
        [
            _say(customer.top_demographic(star), rule, 1, _fill(wording.REPORT_AGE, "age_group", "Country")),
            _say(top, rule, 2, _fill(wording.REPORT_TOP, "names")),
            _say(content, rule, 3, _fill(wording.REPORT_CONTENT, "ContentType")),
            _fixed(spark, rule, 4, wording.REPORT_CHECKOUT),
            _say(disliked, rule, 5, _fill(wording.REPORT_NEGATIVE, "names")),
        ]
    )


def findings(star: Star, k: int = 5) -> DataFrame:
    """Drop-offs per stage and the best rated product ids."""
    spark = star.journey.sparkSession
    rule = "findings"
    lost, best = product.dropoff_counts(star), product.top_rated_ids(star, k)
    rated = _fill(wording.RATED_ITEM, "ProductID", _four_digits("AvgRating"))
    return _all(
        [
            _fixed(spark, rule, 1, wording.DROP_OFF_HEADER),
            _say(lost, rule, 2, _fill(wording.DROP_OFF_ITEM, "Stage", "DropOffCount"), "-DropOffCount", "Stage"),
            _fixed(spark, rule, 3, ""),
            _fixed(spark, rule, 4, wording.RATED_HEADER),
            _say(best, rule, 5, rated, "-AvgRating", "lpad(CAST(ProductID AS STRING), 20, '0')"),
        ]
    )
