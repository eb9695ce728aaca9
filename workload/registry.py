"""Every query by name, over the generated test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartrail import Star, schemas
from cartrail.functions.metrics import (
    AGE_GROUPS,
    AGE_RANGES,
    age_band,
    is_checkout_purchase,
    rating_sentiment,
    score_label,
)
from cartrail.operators import clean, keys, profile
from cartrail.plans import customer, experience, marketing, product, recommend, text, text_report
from cartrail.sources import readers, sinks
from cartrail.sources.versions import VersionedTables
from workload import binding

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Result types that compare across engines: decimals as doubles, dates as text."""
    casts = {"decimal": "double", "date": "string"}
    columns = [
        F.col(name).cast(casts[kind.split("(")[0]]).alias(name) if kind.split("(")[0] in casts else F.col(name)
        for name, kind in df.dtypes
    ]
    return df.select(*columns)


def _report(function: Callable[..., DataFrame], **params: object) -> Query:
    return lambda spark, sf_dir: comparable(function(binding.star(spark, sf_dir), **params))


def _raw(table: str, step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(step(binding.raw_tables(spark, sf_dir)[table]))


def _profile(step: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(step(_profiled(spark, sf_dir)))


def _profiled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = binding.raw_tables(spark, sf_dir)
    return {**tables, "customers": tables["customers"].drop("arrival")}


# --- cleaning -------------------------------------------------------------------------------------------------


def _clean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = binding.raw_tables(spark, sf_dir)["customer_journey"]
    filled = clean.fill_missing(raw, {"Duration": clean.MISSING_DURATION})
    return filled.select("JourneyID", "Duration")


def _clean_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = binding.raw_tables(spark, sf_dir)
    lowered = clean.lower_case(raw["customer_journey"], "Stage", "Action")
    raised = clean.upper_case(raw["engagement_data"], "ContentType")
    named = clean.capitalise(raw["customers"], "Gender")
    parts = [
        lowered.select(F.lit("Stage").alias("column_name"), F.col("Stage").alias("value")),
        lowered.select(F.lit("Action").alias("column_name"), F.col("Action").alias("value")),
        raised.select(F.lit("ContentType").alias("column_name"), F.col("ContentType").alias("value")),
        named.select(F.lit("Gender").alias("column_name"), F.col("Gender").alias("value")),
    ]
    values = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def _clean_split(raw: DataFrame) -> DataFrame:
    unpacked = clean.split_pair(raw, "ViewsClicksCombined", "Views", "Clicks")
    return unpacked.select("EngagementID", "ProductID", "Views", "Clicks")


def _cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return clean.clean_all(binding.raw_tables(spark, sf_dir), "arrival")


def _clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per cleaned table: rows, sum of the key, sum of one cleaned number, length of one cleaned text."""
    measures = {
        "customer_journey": ("round(sum(Duration * 100))", "concat(Stage, Action)"),
        "customer_reviews": ("sum(Rating)", "ReviewText"),
        "customers": ("sum(Age)", "Gender"),
        "engagement_data": ("sum(coalesce(Views, 0)) + sum(coalesce(Clicks, 0))", "ContentType"),
        "geography": ("sum(GeographyID)", "concat(Country, City)"),
        "products": ("round(sum(Price) * 100)", "ProductName"),
    }
    summaries = []
    for name, df in _cleaned(spark, sf_dir).items():
        number, words = measures[name]
        summaries.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("rows"),
                F.sum(schemas.PRIMARY_KEYS[name]).alias("keys"),
                F.expr(number).cast("bigint").alias("number"),
                F.expr(f"sum(length({words}))").alias("letters"),
            )
        )
    result = summaries[0]
    for summary in summaries[1:]:
        result = result.unionByName(summary)
    return result


# --- CSV files in, rows out ---


def _from_csv(table: str, cleaned: Callable[[DataFrame], DataFrame]) -> Query:
    """A raw table written as CSV, read back with its declared schema and cleaned: every row."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{sinks.work_dir(spark)}/{table}"
        raw = binding.raw_tables(spark, sf_dir)[table]
        # customers come in the order in which they arrived
        filed = raw.orderBy("arrival").drop("arrival") if "arrival" in raw.columns else raw
        sinks.write_csv(filed, path)
        read = readers.read_csv_tables(spark, {table: path}, multi_line=True)[table]
        return comparable(cleaned(readers.with_ingest_order(read) if "arrival" in raw.columns else read))

    return query


def _clean_filed_customers(raw: DataFrame) -> DataFrame:
    return clean.clean_customers(raw, readers.INGEST_ORDER).select(schemas.CLEAN["customers"].names)


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV lines, some of them broken: the good ones by id, the bad ones as they stand."""
    path = f"{sinks.work_dir(spark)}/customers_with_faults"
    fault = """CASE WHEN CustomerID % 17 = 0 THEN 'id' WHEN CustomerID % 19 = 0 THEN 'age' WHEN CustomerID % 23 = 0 THEN 'long'
        WHEN CustomerID % 29 = 0 THEN 'short' WHEN CustomerID % 31 = 0 THEN 'place' ELSE '' END AS fault"""
    line = """if(fault = 'short', concat_ws(',', string(CustomerID), CustomerName), concat(
        if(fault = 'id', 'A', ''),
        concat_ws(',', string(CustomerID), CustomerName, Email, Gender, if(fault = 'age', 'abc', string(Age)), if(fault = 'place', '1.5.2', string(GeographyID))),
        if(fault = 'long', ',x', ''))) AS line"""
    lines = binding.star(spark, sf_dir).customers.selectExpr("*", fault).selectExpr(line)
    # one value per line; the text writer puts a header on no file, so every file gets its own line of names
    header = ",".join(schemas.RAW["customers"].names)
    named = lines.withColumn("file", F.pmod(F.xxhash64("line"), F.lit(3))).unionByName(
        spark.range(3).select(F.lit(header).alias("line"), F.col("id").alias("file"))
    )
    ordered = named.repartition(3, "file").sortWithinPartitions("file", F.col("line") != header)
    ordered.select("file", "line").write.partitionBy("file").text(path)
    read = [readers.read_csv_checked(spark, "customers", f"{path}/file={i}") for i in range(3)]
    good, bad = (reduce(DataFrame.unionByName, side) for side in zip(*read, strict=True))
    loaded = good.select(F.lit("loaded").alias("status"), "CustomerID", F.lit(None).cast("string").alias("bad_line"))
    return loaded.unionByName(bad.select(F.lit("rejected").alias("status"), F.lit(None).cast("bigint").alias("CustomerID"), "bad_line"))


def _sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries by purchases, asked in SQL of the tables under their names."""
    readers.register_views(binding.Views(spark, sf_dir))
    return spark.sql(
        """SELECT Country, count(*) AS Total_Purchases FROM customer_journey JOIN customers USING (CustomerID)
        JOIN geography USING (GeographyID) WHERE Action = 'purchase' GROUP BY Country
        ORDER BY Total_Purchases DESC, Country LIMIT 5"""
    )


def _sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any sample of six: rows, distinct rows, and rows that the table has."""
    places = binding.star(spark, sf_dir).geography
    drawn = profile.sample_rows(places, 6, seed=7)
    known = places.withColumn("known", F.lit(1))
    return drawn.join(known, places.columns, "left").agg(
        F.count(F.lit(1)).alias("drawn"),
        F.count_distinct("GeographyID").alias("distinct_keys"),
        F.count("known").alias("members"),
    )


def _sampled(**options: object) -> Query:
    """Customers drawn by their id."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        people = binding.star(spark, sf_dir).customers.select("CustomerID", "Gender", "Age")
        if "strata" in options:
            return profile.sample_strata(people, 7, by=["CustomerID"], seed=7, **options)
        return profile.sample_rows(people, 40, seed=7, by=["CustomerID"], **options)

    return query


def _sketch_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and NULLs of every column, and whether the estimate of its distinct values is within the stated error."""
    tables = {name: df for name, df in _profiled(spark, sf_dir).items() if name in ("customer_journey", "customers", "products")}
    exact = []
    for name, df in tables.items():
        one = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])
        cells = ", ".join(f"'{c}', `{c}`" for c in df.columns)
        exact.append(one.selectExpr(f"'{name}' AS table_name", f"stack({len(df.columns)}, {cells}) AS (column_name, exact)"))
    sketched = profile.sketch_profile(tables).join(reduce(DataFrame.unionByName, exact), ["table_name", "column_name"])
    close = F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") * profile.DISTINCT_ERROR
    return sketched.select("table_name", "column_name", "rows", "nulls", close.alias("close"))


def _retention_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each month and those of them who are there in the next, from stored states."""
    path = f"{sinks.work_dir(spark)}/customer_states"
    customer.customer_states(binding.star(spark, sf_dir)).write.parquet(path)
    return comparable(customer.retention_by_period(spark.read.parquet(path)))


def _customers_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers of the whole time, from the states of its days."""
    bought = customer.customer_states(binding.star(spark, sf_dir), "day", visits=F.col("Action") == "purchase")
    return customer.customers_of(bought)


# --- sinks ----------------------------------------------------------------------------------------------------


def _load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw journeys, replaced by the cleaned ones, read back."""
    path = sinks.work_dir(spark) + "/customer_journey"
    sinks.write_table(binding.raw_tables(spark, sf_dir)["customer_journey"], path)
    sinks.write_table(_cleaned(spark, sf_dir)["customer_journey"], path)
    return comparable(readers.read_parquet_tables(spark, {"customer_journey": path})["customer_journey"])


def _load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.load_tables(spark, _cleaned(spark, sf_dir), sinks.work_dir(spark))


def _load_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables loaded, then cleaned ones, then a load that fails for one table: the journeys and products that stand."""
    tables = VersionedTables(spark, sinks.work_dir(spark))
    raw, cleaned = binding.raw_tables(spark, sf_dir), _cleaned(spark, sf_dir)
    names = ("customer_journey", "products")
    tables.load({name: raw[name] for name in names}, "raw")
    tables.load({name: cleaned[name] for name in names}, "cleaned")
    broken = cleaned["customer_journey"].withColumn("Stage", F.raise_error(F.lit("no")).cast("string"))
    tables.load({"customer_journey": broken, "products": tables.snapshot()["products"].where("Price > 1000")}, "broken")
    held = tables.snapshot()
    journeys = held["customer_journey"].selectExpr("'customer_journey' AS table_name", "JourneyID AS key", "Stage AS value")
    return journeys.unionByName(held["products"].selectExpr("'products' AS table_name", "ProductID AS key", "ProductName AS value"))


def _load_versions_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a load that ran twice under its name."""
    tables = VersionedTables(spark, sinks.work_dir(spark))
    cleaned = _cleaned(spark, sf_dir)
    tables.load({"geography": binding.raw_tables(spark, sf_dir)["geography"]}, "before")
    tables.load(cleaned, "all")
    return tables.load(cleaned, "all")


def _key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad rows of the raw tables, some journeys without a key: rows and sum of the keys by reason."""
    tables = _profiled(spark, sf_dir)
    tables["customer_journey"] = tables["customer_journey"].withColumn("JourneyID", F.expr("nullif(JourneyID, JourneyID DIV 97 * 97)"))
    parts = []
    for name, df in keys.quarantine(tables).told.items():
        reason = F.coalesce("reason", F.lit("good")).alias("reason")
        counted = df.groupBy(reason).agg(F.count(F.lit(1)).alias("rows"), F.sum(schemas.PRIMARY_KEYS[name]).alias("keys"))
        parts.append(counted.select(F.lit(name).alias("table_name"), "reason", "rows", "keys"))
    return reduce(DataFrame.unionByName, parts)


def _reviews_scored_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.work_dir(spark) + "/reviews_scored"
    scored = text.scored_reviews(binding.scored_documents(spark, sf_dir), binding.lexicon(spark))
    sinks.write_csv(scored.select("ReviewID", "ProductID", "Rating", "ReviewText", "Sentiment"), path)
    schema = "ReviewID bigint, ProductID bigint, Rating int, ReviewText string, Sentiment double"
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def _recs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.work_dir(spark) + "/marketing_recommendations"
    sinks.write_lines(recommend.marketing_lines(binding.star(spark, sf_dir)), path, *recommend.READING_ORDER)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _findings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.work_dir(spark) + "/findings"
    sinks.write_lines(recommend.findings(binding.star(spark, sf_dir)), path, *recommend.READING_ORDER)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _text_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.work_dir(spark) + "/report"
    sinks.write_lines(text_report.text_report(binding.star(spark, sf_dir)), path, *recommend.READING_ORDER)
    return spark.read.text(path).withColumnRenamed("value", "line")


# --- text -----------------------------------------------------------------------------------------------------


def _text_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.text_polarity(binding.documents(spark, sf_dir), binding.lexicon(spark))


def _text_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.text_sentiment(binding.documents(spark, sf_dir), binding.lexicon(spark))


def _polarity_gate(spark: SparkSession, sf_dir: str, threshold: float = -0.2) -> DataFrame:
    return text.negative_polarity_gate(binding.rated_documents(spark, sf_dir), binding.lexicon(spark), threshold=threshold)


def _modified_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.text_sentiment(binding.documents(spark, sf_dir), binding.modified_lexicon(spark))


def _modified_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short reviews, some of them twice, with their scores."""
    reviews = binding.raw_tables(spark, sf_dir)["customer_reviews"].select("ReviewID", "Rating", "ReviewText")
    return text.scored_reviews(reviews, binding.modified_lexicon(spark))


def _modified_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.negative_polarity_gate(binding.star(spark, sf_dir).reviews, binding.modified_lexicon(spark), threshold=-0.1)


def _experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, words = binding.star(spark, sf_dir), binding.lexicon(spark)
    return recommend.experience_lines(star, words, purchase=is_checkout_purchase())


# --- bands ----------------------------------------------------------------------------------------------------


def _band_age(star: Star) -> DataFrame:
    return star.customers.select(
        "CustomerID", age_band("Age", AGE_RANGES).alias("Age_Range"), age_band("Age", AGE_GROUPS).alias("age_group")
    )


def _rating_sentiment(star: Star) -> DataFrame:
    rated = star.reviews.select("ReviewID", "ProductID", "Rating", rating_sentiment("Rating").alias("Sentiment"))
    return rated.withColumn("Category", score_label("Sentiment"))


def _checkout(function: Callable[..., DataFrame], param: str) -> Query:
    """The report with the stricter of the two purchase predicates."""
    return lambda spark, sf_dir: comparable(function(binding.star(spark, sf_dir), **{param: is_checkout_purchase()}))


def _dropoff_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop-off rates of the raw journeys, Stage and Action in any case."""
    raw = Star({"customer_journey": binding.raw_tables(spark, sf_dir)["customer_journey"]})
    rates = product.dropoff_rate(raw.ignoring_case())
    return rates.withColumn("Stage", F.lower(F.collate("Stage", "UTF8_BINARY")))


def _value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(_profiled(spark, sf_dir)["customers"])


def _rating_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(binding.star(spark, sf_dir).reviews, "Rating")


def _head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    journey = binding.star(spark, sf_dir).journey
    first = profile.head(journey, 5, "JourneyID").withColumn("part", F.lit("head"))
    return comparable(first.unionByName(profile.tail(journey, 10, "JourneyID").withColumn("part", F.lit("tail"))))


def _as_text(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        for name, df in _profiled(spark, sf_dir).items()
    }


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "load_overwrite": _load_overwrite,
        "load_report": _load_report,
        "load_versions": _load_versions,
        "load_versions_report": _load_versions_report,
        "key_check": _key_check,
        "csv_rejects": _csv_rejects,
        "clean_customers": _from_csv("customers", _clean_filed_customers),
        "clean_reviews": _from_csv("customer_reviews", clean.clean_reviews),
        "clean_engagement": _from_csv("engagement_data", clean.clean_engagement),
        "clean_geography": _from_csv("geography", clean.clean_geography),
        "clean_products": _from_csv("products", clean.clean_products),
        "sql_over_views": _sql_over_views,
        "reviews_scored_csv": _reviews_scored_csv,
        "recs_text": _recs_text,
        "findings_text": _findings_text,
        "text_report": _text_report,
        # cleaning
        "clean_fill": _clean_fill,
        "clean_case": _clean_case,
        "clean_strip": _raw(
            "customer_reviews",
            lambda raw: clean.strip_blanks(clean.fill_missing(raw, {"ReviewText": clean.MISSING_REVIEW}), "ReviewText"),
        ),
        "clean_clip": _raw(
            "customers", lambda raw: clean.clip(raw, "Age", *clean.AGE_LIMITS).select("CustomerID", "Age")
        ),
        "clean_price_filter": _raw("products", lambda raw: clean.keep_positive(raw, "Price")),
        "clean_distinct": _raw("geography", clean.drop_duplicate_rows),
        "clean_dedup_key": _raw("customers", lambda raw: clean.keep_first_per_key(raw, "CustomerID", "arrival")),
        "clean_split_pair": _raw("engagement_data", _clean_split),
        "clean_malformed_pairs": _raw(
            "engagement_data",
            lambda raw: clean.malformed_pairs(raw, "ViewsClicksCombined").select("EngagementID", "ViewsClicksCombined"),
        ),
        "clean_all": _clean_all,
        # profiling
        "profile_nulls": _profile(profile.null_counts),
        "profile_duplicates": _profile(profile.duplicate_counts),
        "profile_types": lambda spark, sf_dir: profile.inferred_types(_as_text(spark, sf_dir)),
        "profile_unique": _profile(lambda tables: profile.key_uniqueness(tables, schemas.PRIMARY_KEYS)),
        "profile_value_counts": _value_counts,
        "profile_rating_counts": _rating_counts,
        "profile_info": _profile(profile.table_info),
        "profile_head_tail": _head_tail,
        "profile_sample": _sample_check,
        "profile_sample_rows": _sampled(),
        "profile_sample_weighted": _sampled(weight="Age"),
        "profile_sample_strata": _sampled(strata=["Gender"]),
        "profile_sketch": _sketch_check,
        # expressions and joins
        "band_age": _report(_band_age),
        "rating_sentiment": _report(_rating_sentiment),
        "join_integrated": _report(customer.integrated_journeys),
        "anti_top_products": _report(product.outside_best_sellers),
        # customers
        "top_products": _report(product.top_products),
        "top_regions": _report(customer.top_regions),
        "customer_retention": _report(customer.customer_retention),
        "checkout_retention": _checkout(customer.customer_retention, "visits"),
        "retention_by_month": _retention_by_month,
        "customers_over_days": _customers_over_days,
        "demographics_conversion": _report(customer.demographics_conversion),
        "product_conversion": _report(product.product_conversion),
        "engagement_conversion": _report(marketing.engagement_conversion),
        "review_sentiment": _report(experience.review_sentiment),
        "sentiment_distribution": _report(experience.sentiment_distribution),
        # marketing
        "underperforming_products": _report(marketing.underperforming_products),
        "geo_performance": _report(marketing.geo_performance),
        "poorly_converting_products": _report(marketing.poorly_converting_products, ratio=0.02),
        "channel_performance": _report(marketing.channel_performance),
        "underperforming_channels": _report(marketing.underperforming_channels, ratio=400.0),
        # customer experience
        "negative_reviews": _report(experience.negative_reviews),
        "lowest_rated_products": _report(product.lowest_rated_products),
        "retention_rate": _report(customer.retention_rate),
        "checkout_retention_rate": _checkout(customer.retention_rate, "visits"),
        "common_complaints": _report(experience.common_complaints),
        "common_complaints_wide": _report(experience.common_complaints, wide=True),
        "one_time_purchasers": _report(customer.one_time_purchasers),
        "one_time_checkout_purchasers": _checkout(customer.one_time_purchasers, "purchase"),
        # business
        "flagship_product": _report(product.flagship_product),
        "top_demographic": _report(customer.top_demographic),
        "top_region_product": _report(customer.top_region_product),
        "top_channel_roi": _report(marketing.top_channel_roi),
        "discount_candidates": _report(product.discount_candidates),
        "top_converting_products": _report(product.top_converting_products),
        "demographic_performance": _report(customer.demographic_performance),
        "channel_roi": _report(marketing.channel_roi),
        # further reports
        "dropoff_rate": _report(product.dropoff_rate),
        "dropoff_rate_ignoring_case": _dropoff_ignoring_case,
        "dropoff_counts": _report(product.dropoff_counts),
        "avg_stage_duration": _report(lambda star: product.avg_stage_duration(star.journey)),
        "avg_stage_duration_filled": _report(
            lambda star: product.avg_stage_duration(
                clean.fill_missing(star.journey, {"Duration": clean.MISSING_DURATION})
            )
        ),
        "highest_rated_products": _report(product.highest_rated_products),
        "top_rated_by_name": _report(product.top_rated_by_name),
        "top_rated_ids": _report(product.top_rated_ids),
        "lowest_rated_ids": _report(product.lowest_rated_ids),
        "reviews_per_product": _report(product.reviews_per_product),
        "product_ratings": _report(product.product_ratings),
        "product_purchases": _report(product.product_purchases),
        "rating_purchase_corr": _report(
            lambda star: product.rating_purchase_correlation(star).withColumn("correlation", F.round("correlation", 6))
        ),
        "correlation_matrix": _report(
            lambda star: product.product_correlations(star).select(
                "column_name", *[F.round(c, 6).alias(c) for c in ("Price", "Avg_Rating", "Review_Count", "Total_Purchases")]
            )
        ),
        "regional_product_sales": _report(customer.regional_product_sales),
        "journey_geography": _report(customer.journey_geography),
        "rating_vs_engagement": _report(marketing.rating_vs_engagement),
        "sentiment_summary": _report(experience.sentiment_summary),
        "engagement_likes": _report(marketing.engagement_likes),
        # text
        "text_polarity": _text_polarity,
        "text_sentiment_class": _text_sentiment,
        "negative_polarity_gate": _polarity_gate,
        "negative_polarity_gate_open": lambda spark, sf_dir: _polarity_gate(spark, sf_dir, 0.9),
        "text_polarity_in_order": _modified_polarity,
        "scored_reviews_in_order": _modified_reviews,
        "negative_polarity_gate_in_order": _modified_gate,
        # recommendations
        "recs_strategic": _report(recommend.strategic),
        "recs_marketing": _report(recommend.marketing_lines),
        "recs_experience": _experience,
        "recs_business": _report(recommend.business),
        "recs_text_report": _report(recommend.text_report_lines),
    }
