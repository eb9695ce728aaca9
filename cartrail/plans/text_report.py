"""The sectioned plain-text report, as ``(section, sort_key, sort_name, line)`` rows for the text sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartrail.plans import customer, experience, marketing, product, recommend, wording
from cartrail.star import Star

COLUMN_WIDTH = 20


def _cell(name: str) -> str:
    """SQL text: right-aligned in ``COLUMN_WIDTH``; a longer value is never cut."""
    text = f"coalesce(CAST(`{name}` AS STRING) COLLATE UTF8_BINARY, 'NULL')"
    return f"lpad({text}, greatest(length({text}), {COLUMN_WIDTH}), ' ')"


def _heading(spark: SparkSession, section: int, *lines: str) -> DataFrame:
    cells = [F.struct(F.lit(float(i)).alias("sort_key"), F.lit(line).alias("line")) for i, line in enumerate(lines)]
    listed = spark.range(1).select(F.inline(F.array(*cells)))
    return listed.selectExpr(f"{section} AS section", "sort_key", "'' AS sort_name", "line")


def _table(df: DataFrame, section: int, sort_key: str, sort_name: str, *columns: str) -> DataFrame:
    return df.selectExpr(
        f"{section} AS section",
        f"CAST({sort_key} AS DOUBLE) AS sort_key",
        f"{sort_name} COLLATE UTF8_BINARY AS sort_name",
        f"concat_ws(' ', {', '.join(_cell(name) for name in columns)}) AS line",
    )


def _header(*columns: str) -> str:
    return " ".join(name.rjust(COLUMN_WIDTH) for name in columns)


def text_report(star: Star, title: str = "Customer & Marketing Analysis Report") -> DataFrame:
    """All sections; order by ``recommend.READING_ORDER`` to read them."""
    spark = star.journey.sparkSession
    best = product.product_conversion(star).orderBy(
        F.desc("Conversion_Rate"), F.desc("Total_Purchases"), "ProductName"
    )
    tables = [
        (wording.CHAPTER_TRENDS, wording.TABLE_PRODUCTS, product.top_products(star),
         "-Total_Interactions", "ProductName", ("ProductName", "Total_Interactions")),
        ("", wording.TABLE_REGIONS, customer.top_regions(star),
         "-Total_Purchases", "Country", ("Country", "Total_Purchases")),
        ("", wording.TABLE_RETENTION, customer.customer_retention(star),
         "0", "Customer_Type", ("Customer_Type", "Count")),
        (wording.CHAPTER_SEGMENTS, wording.TABLE_DEMOGRAPHICS, customer.demographics_conversion(star),
         "array_position(array('Age Range', 'Gender', 'Country'), Group_By)", "Group_Value",
         ("Group_By", "Group_Value", "Total_Customers", "Total_Purchases", "Conversion_Rate")),
        (wording.CHAPTER_DRIVERS, wording.TABLE_CONVERSION, best.limit(5),
         "-Conversion_Rate", "ProductName",
         ("ProductName", "Avg_Price", "Unique_Customers", "Total_Purchases", "Conversion_Rate")),
        ("", wording.TABLE_ENGAGEMENT, marketing.engagement_conversion(star),
         "-Conversion_Rate", "ContentType",
         ("ContentType", "Total_Engagements", "Total_Purchases", "Conversion_Rate")),
        (wording.CHAPTER_SENTIMENT, wording.TABLE_SENTIMENT, experience.sentiment_distribution(star),
         "0", "Category", ("Category", "Percentage")),
    ]
    rule = "=" * 60
    parts = [_heading(spark, 0, rule, title, rule)]
    for number, (chapter, caption, df, sort_key, sort_name, columns) in enumerate(tables):
        lines = ["", *([chapter, ""] if chapter else []), caption, _header(*columns)]
        parts.append(_heading(spark, 10 + 2 * number, *lines))
        parts.append(_table(df, 11 + 2 * number, sort_key, sort_name, *columns))
    parts.append(_heading(spark, 90, "", wording.CHAPTER_CLOSING, ""))
    closing = recommend.text_report_lines(star)
    parts.append(closing.selectExpr("section + 90 AS section", "sort_key", "sort_name", "line"))
    return reduce(DataFrame.unionByName, parts)
