"""Customer reports: regions, demographics, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartrail.functions.metrics import AGE_GROUPS, AGE_RANGES, age_band, is_purchase, pct
from cartrail.operators.joins import lookup_join
from cartrail.operators.summaries import journeys_per, purchases_per
from cartrail.star import Star


def integrated_journeys(star: Star) -> DataFrame:
    """Every journey with its customer and place."""
    people = star.customers.select("CustomerID", "CustomerName", "Gender", "Age", "GeographyID")
    with_people = lookup_join(star.journey, people, "CustomerID", spread_by=["JourneyID"])
    return lookup_join(with_people, star.geography, "GeographyID", spread_by=["JourneyID"])


def journey_geography(star: Star, k: int = 10) -> DataFrame:
    """Where the first ``k`` journeys (by id) came from."""
    placed = star.customers.join(star.geography.select("GeographyID"), "GeographyID", "left_semi").select("CustomerID")
    known = star.journey.join(placed, "CustomerID", "left_semi")
    # customers and places are met again for these rows only
    first = known.orderBy("JourneyID", "CustomerID", "Stage", "Action", "VisitDate").limit(k)
    homes = star.customers.select("CustomerID", "GeographyID")
    columns = ["JourneyID", "CustomerID", "Country", "City", "Stage", "Action", "VisitDate"]
    found = homes.join(F.broadcast(first), "CustomerID").join(star.geography, "GeographyID").select(*columns)
    return found.orderBy(*columns).limit(k).drop("JourneyID")


def top_regions(star: Star, k: int = 5) -> DataFrame:
    """Countries by purchases."""
    homes = star.customers.select("CustomerID", "GeographyID")
    per_place = (
        purchases_per(star.journey, "CustomerID")
        .join(homes, "CustomerID")
        .groupBy("GeographyID")
        .agg(F.sum("purchases").alias("purchases"))
    )
    per_country = per_place.join(star.geography, "GeographyID").groupBy("Country")
    counted = per_country.agg(F.sum("purchases").alias("Total_Purchases"))
    return counted.orderBy(F.desc("Total_Purchases"), "Country").limit(k)


def _regional_sales(star: Star) -> DataFrame:
    """Purchases by country and product name.

    After the first step a place holds at most one row per product, and a product one per country: too few
    rows on any key to need salting.
    """
    bought = star.journey.where(is_purchase()).select("JourneyID", "CustomerID", "ProductID")
    homes = star.customers.select("CustomerID", "GeographyID")
    per_place = (
        lookup_join(bought, homes, "CustomerID", spread_by=["JourneyID"])
        .groupBy("GeographyID", "ProductID")
        .agg(F.expr("count(*) AS sold"))
    )
    placed = per_place.join(star.geography.select("GeographyID", "Country"), "GeographyID")
    per_country = placed.groupBy("Country", "ProductID").agg(F.sum("sold").alias("sold"))
    named = per_country.join(star.products.select("ProductID", "ProductName"), "ProductID")
    return named.groupBy("Country", "ProductName").agg(F.sum("sold").alias("sales"))


def top_region_product(star: Star, k: int = 1) -> DataFrame:
    return _regional_sales(star).orderBy(F.desc("sales"), "Country", "ProductName").limit(k)


def regional_product_sales(star: Star, k: int = 10) -> DataFrame:
    return top_region_product(star, k).withColumnRenamed("sales", "SalesCount")


def customer_retention(star: Star, visits: Column | None = None) -> DataFrame:
    """Customers with more than one visit date, and the others. ``visits`` limits which journeys count."""
    retained = F.expr("if(returned, 'Retained', 'One-Time') AS Customer_Type")
    return _returning(star, visits).groupBy(retained).agg(F.expr("count(*) AS Count"))


def retention_rate(star: Star, visits: Column | None = None) -> DataFrame:
    """One row: customers, those with more than one visit date, and their share."""
    totals = _returning(star, visits).agg(
        F.count("CustomerID").alias("Total_Customers"),
        F.count_if("returned").alias("Retained_Customers"),
    )
    return totals.withColumn("Retention_Rate", pct("Retained_Customers", "Total_Customers"))


def _returning(star: Star, visits: Column | None) -> DataFrame:
    """More than one distinct date is the same as first date before last: no distinct set per customer."""
    counted = star.journey if visits is None else star.journey.where(visits)
    several = F.expr("coalesce(min(VisitDate) < max(VisitDate), false) AS returned")
    return counted.groupBy("CustomerID").agg(several)


def customer_states(star: Star, unit: str = "month", visits: Column | None = None) -> DataFrame:
    """``(period, state)``: a sketch of the customers of each period, to be stored and put together later.

    A state is a theta sketch of 4,096 entries: exact up to so many customers, and about 1.6 % off (one standard
    deviation) beyond. States of days make those of months: ``theta_union_agg``.
    """
    counted = star.journey if visits is None else star.journey.where(visits)
    period = F.trunc("VisitDate", unit).alias("period")
    return counted.where("VisitDate IS NOT NULL").groupBy(period).agg(F.theta_sketch_agg("CustomerID").alias("state"))


def customers_of(states: DataFrame) -> DataFrame:
    """One row, ``customers``: distinct customers of all the periods together, without a look at the journeys."""
    return states.agg(F.theta_sketch_estimate(F.theta_union_agg("state")).alias("customers"))


def retention_by_period(states: DataFrame) -> DataFrame:
    """``(period, customers, returning)``: customers of each period, and those who are there in the next one, too.

    An estimate from the states of ``customer_states``. There is a row per period, however many customers.
    """
    following = F.lead("state").over(Window.orderBy("period"))
    again = F.theta_sketch_estimate(F.theta_intersection("state", "next"))
    return states.withColumn("next", following).select(
        "period",
        F.theta_sketch_estimate("state").alias("customers"),
        F.when(F.col("next").isNotNull(), again).alias("returning"),
    )


def _customer_totals(star: Star) -> DataFrame:
    """Journey totals per customer, with the customer's age, gender and place.

    One row per customer from here on, and still partitioned by customer: the distinct customer counts
    above it need no further shuffle of customers.
    """
    people = star.customers.select("CustomerID", "Age", "Gender", "GeographyID")
    return journeys_per(star.journey, "CustomerID").join(people, "CustomerID")


def _placed(star: Star, per_customer: DataFrame) -> DataFrame:
    countries = star.geography.select("GeographyID", "Country")
    return lookup_join(per_customer, countries, "GeographyID", spread_by=["CustomerID"])


def _conversion(members: DataFrame) -> DataFrame:
    totals = members.groupBy("Group_By", "Group_Value").agg(
        F.count_distinct("CustomerID").alias("Total_Customers"),
        F.sum("checkout_purchases").alias("Total_Purchases"),
    )
    return totals.withColumn("Conversion_Rate", pct("Total_Purchases", "Total_Customers"))


def age_conversion(star: Star) -> DataFrame:
    """The age branch of ``demographics_conversion``."""
    band = age_band("Age", AGE_RANGES)
    return _conversion(
        _customer_totals(star).select(
            F.lit("Age Range").alias("Group_By"), band.alias("Group_Value"), "CustomerID", "checkout_purchases"
        )
    )


def demographics_conversion(star: Star) -> DataFrame:
    """Checkout purchases per distinct customer by age band, by gender and by country.

    Age and gender come from one pass. The country rows need a known place, which must not drop anyone
    from the other two, so they are aggregated apart and appended.
    """
    people = _customer_totals(star)
    band = age_band("Age", AGE_RANGES).cast(people.schema["Gender"].dataType)
    traits = F.array(
        F.struct(F.lit("Age Range").alias("Group_By"), band.alias("Group_Value")),
        F.struct(F.lit("Gender").alias("Group_By"), F.col("Gender").alias("Group_Value")),
    )
    by_trait = people.select("CustomerID", "checkout_purchases", F.inline(traits))
    by_country = _placed(star, people).select(
        "CustomerID", "checkout_purchases", F.lit("Country").alias("Group_By"), F.col("Country").alias("Group_Value")
    )
    return _conversion(by_trait).unionByName(_conversion(by_country))


def demographic_performance(star: Star, k: int = 5) -> DataFrame:
    """Journeys and purchases per distinct customer by age group, gender and country; the best ``k``."""
    grouped = _placed(star, _customer_totals(star)).groupBy(
        age_band("Age", AGE_GROUPS).alias("age_group"), "Gender", "Country"
    )
    totals = grouped.agg(
        F.sum("journeys").alias("interactions"),
        F.sum("purchases").alias("purchases"),
        F.count_distinct("CustomerID").alias("customers"),
    )
    rated = totals.select(
        "age_group",
        "Gender",
        "Country",
        "interactions",
        pct("purchases", "customers").alias("conversion_rate"),
    )
    return rated.orderBy(F.desc("conversion_rate"), "age_group", "Gender", "Country").limit(k)


def top_demographic(star: Star) -> DataFrame:
    return demographic_performance(star, 1).drop("interactions")


def one_time_purchasers(star: Star, purchase: Column | None = None) -> DataFrame:
    """Known customers with exactly one purchase journey.

    One distinct journey is the same as first id equal to last id: no distinct set per customer.
    """
    bought = star.journey.where(is_purchase() if purchase is None else purchase)
    span = bought.groupBy("CustomerID").agg(F.min("JourneyID").alias("_first"), F.max("JourneyID").alias("_last"))
    once = span.where("_first = _last")
    known = once.join(star.customers.select("CustomerID"), "CustomerID", "left_semi")
    return known.selectExpr("CustomerID", "1L AS PurchaseCount")
