"""Declared schemas of the six tables: three facts, three dimensions.

Fixed values: column names, their order and their types are the data model every query relies on.
The keys are checked by ``operators.keys.quarantine`` before a load, and counted by ``operators.profile.key_uniqueness``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_LONG, _INT, _TEXT, _DATE = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
_DOUBLE, _MONEY = T.DoubleType(), T.DecimalType(10, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


JOURNEY = _schema(
    JourneyID=_LONG, CustomerID=_LONG, ProductID=_LONG, VisitDate=_DATE, Stage=_TEXT, Action=_TEXT, Duration=_DOUBLE
)
REVIEWS = _schema(
    ReviewID=_LONG, CustomerID=_LONG, ProductID=_LONG, ReviewDate=_DATE, Rating=_INT, ReviewText=_TEXT
)
CUSTOMERS = _schema(
    CustomerID=_LONG, CustomerName=_TEXT, Email=_TEXT, Gender=_TEXT, Age=_INT, GeographyID=_LONG
)
ENGAGEMENT = _schema(
    EngagementID=_LONG, ContentID=_LONG, ContentType=_TEXT, Likes=_INT, EngagementDate=_DATE,
    CampaignID=_LONG, ProductID=_LONG, Views=_INT, Clicks=_INT,
)
GEOGRAPHY = _schema(GeographyID=_LONG, Country=_TEXT, City=_TEXT)
PRODUCTS = _schema(ProductID=_LONG, ProductName=_TEXT, Category=_TEXT, Price=_MONEY)

#: engagement arrives with both counts packed into one "views-clicks" string
ENGAGEMENT_RAW = _schema(
    EngagementID=_LONG, ContentID=_LONG, ContentType=_TEXT, Likes=_INT, EngagementDate=_DATE,
    CampaignID=_LONG, ProductID=_LONG, ViewsClicksCombined=_TEXT,
)

RAW: dict[str, T.StructType] = {
    "customer_journey": JOURNEY,
    "customer_reviews": REVIEWS,
    "customers": CUSTOMERS,
    "engagement_data": ENGAGEMENT_RAW,
    "geography": GEOGRAPHY,
    "products": PRODUCTS,
}

CLEAN: dict[str, T.StructType] = {**RAW, "engagement_data": ENGAGEMENT}

PRIMARY_KEYS: dict[str, str] = {
    "customer_journey": "JourneyID",
    "customer_reviews": "ReviewID",
    "customers": "CustomerID",
    "engagement_data": "EngagementID",
    "geography": "GeographyID",
    "products": "ProductID",
}

#: columns that name a row of another table; that table's primary key has the same name
FOREIGN_KEYS: dict[str, dict[str, str]] = {
    "customers": {"GeographyID": "geography"},
    "customer_journey": {"CustomerID": "customers", "ProductID": "products"},
    "customer_reviews": {"CustomerID": "customers", "ProductID": "products"},
    "engagement_data": {"ProductID": "products"},
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: declared names, order and types; a missing column is an error."""

    def typed(field: T.StructField) -> Column:
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[typed(field) for field in schema])
