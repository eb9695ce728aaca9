"""The six tables of the star as views over the generated test tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartrail import Star
from cartrail.operators.joins import lookup_join

STAGES = ("homepage", "productpage", "checkout")

#: words that occur in the generated texts, with made-up polarities
LEXICON = {
    "the": 0.1, "of": -0.1, "and": 0.2, "to": 0.05, "in": -0.05, "de": -0.3, "en": 0.25, "la": 0.4,
    "is": 0.15, "for": 0.3, "on": -0.2, "with": 0.35, "as": -0.15, "by": -0.25, "at": 0.45, "from": -0.35,
    "not": -0.6, "all": 0.5, "no": -0.7, "best": 0.9, "complaint": -0.5, "type": -0.1, "café": 0.8, "it's": -0.8,
}

#: a lexicon with phrases and modifiers, made up from words and runs of words that occur
MODIFIED_LEXICON = [
    *[(word, "polarity", polarity) for word, polarity in LEXICON.items() if word not in ("not", "no", "all", "is", "it's", "of")],
    ("not", "negation", -0.5), ("no", "negation", -0.8), ("ne", "negation", -1.0), ("nicht", "negation", -0.75),
    ("all", "intensifier", 1.5), ("is", "intensifier", 0.7), ("it's", "intensifier", 1.3), ("the on", "intensifier", 1.2),
    ("good", "polarity", 0.7), ("of the", "polarity", -0.45), ("in the", "polarity", 0.55), ("no reply at all", "polarity", -0.9),
    ("of", "intensifier", 0.9), ("de la", "polarity", -0.65), ("not as shown", "polarity", -0.85), ("not only", "intensifier", 1.4),
    ("en de", "negation", -0.6), ("for the with", "polarity", 0.95),
]

#: review texts, one for each last digit of a supplier; words of the lexicon and runs of blanks occur
PHRASES = (
    "no  reply at all", "complaint  type of the", "not  as shown", "best of  all", "the usual",
    "from the  box, not good", "all good", "is not  for me", "it's  the best", "café  on la plage",
)


#: declared, so that building a plan starts no job to read file footers
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"""("{word}", {polarity}D)""" for word, polarity in LEXICON.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(word, polarity)")


def modified_lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"""("{word}", "{kind}", {polarity}D)""" for word, kind, polarity in MODIFIED_LEXICON)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(word, kind, polarity)")


_LINE_ID = "l_orderkey * 10 + l_linenumber"


def journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = ", ".join(f"'{stage}'" for stage in STAGES)
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS JourneyID",
        "user_id AS CustomerID",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS ProductID",
        "to_date(ts) AS VisitDate",
        f"element_at(array({stages}), CAST(event_id % 3 + 1 AS INT)) AS Stage",
        "if(event_type <=> 'error', 'drop-off', event_type) AS Action",
        "if(event_type <=> 'error', NULL, value) AS Duration",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS CustomerID",
        "c_name AS CustomerName",
        "concat('c', c_custkey, '@example.com') AS Email",
        "concat(substring(c_mktsegment, 1, 1), lower(substring(c_mktsegment, 2))) AS Gender",
        "CAST(c_custkey % 70 + 18 AS INT) AS Age",
        "CAST(c_nationkey AS BIGINT) AS GeographyID",
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    placed = table(spark, sf_dir, "nation").join(region, "n_regionkey")
    return placed.selectExpr("CAST(n_nationkey AS BIGINT) AS GeographyID", "r_name AS Country", "n_name AS City")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS ProductID",
        "p_name AS ProductName",
        "p_type AS Category",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS Price",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a line names the reviewer; the optimizer drops this join where no one asks for the reviewer."""
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    buyers = orders.groupBy("l_orderkey").agg(F.expr("min(o_custkey) AS o_custkey"))
    return lookup_join(lines, buyers, "l_orderkey", ["l_linenumber", "l_partkey"], "left").selectExpr(
        f"{_LINE_ID} AS ReviewID",
        "o_custkey AS CustomerID",
        "l_partkey AS ProductID",
        "to_date(l_shipdate) AS ReviewDate",
        "CAST(floor((l_quantity - 1) / 10) + 1 AS INT) AS Rating",
        f"""element_at(array({', '.join(f'"{phrase}"' for phrase in PHRASES)}), int(l_suppkey % 10) + 1) AS ReviewText""",
    )


def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").selectExpr(
        f"{_LINE_ID} AS EngagementID",
        "l_suppkey AS ContentID",
        "l_returnflag AS ContentType",
        "CAST(round(l_tax * 100) AS INT) AS Likes",
        "to_date(l_shipdate) AS EngagementDate",
        "CAST(l_linenumber AS BIGINT) AS CampaignID",
        "l_partkey AS ProductID",
        "CAST(floor(l_extendedprice) AS INT) AS Views",
        "CAST(l_quantity AS INT) AS Clicks",
    )


class Views(Mapping[str, DataFrame]):
    """The six views by table name, each built when first asked for."""

    _builders = {
        "customer_journey": journey,
        "customer_reviews": reviews,
        "customers": customers,
        "engagement_data": engagement,
        "geography": geography,
        "products": products,
    }

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._source = (spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](*self._source)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The cleaned star."""
    return Star(Views(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long review texts: every document."""
    return table(spark, sf_dir, "documents").selectExpr("doc_id AS ReviewID", "text AS ReviewText")


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews of products, some without an id and some twice."""
    return _doubled(table(spark, sf_dir, "documents"), "doc_id % 20 = 0").selectExpr(
        "nullif(doc_id, doc_id DIV 7 * 7) AS ReviewID",
        "doc_id % 200 AS ProductID",
        "CAST(doc_id % 5 AS INT) + 1 AS Rating",
        "text AS ReviewText",
    )


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels, the labels turned into a rating."""
    labels = table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS ReviewID",
        "CASE WHEN toxic = 1 AND quality <> 1 THEN 1 WHEN quality <> 1 THEN 2 WHEN toxic = 1 THEN 3 ELSE 5 END AS Rating",
    )
    return documents(spark, sf_dir).join(labels, "ReviewID")


def _doubled(df: DataFrame, marked: str) -> DataFrame:
    """Emit the marked rows twice, the second time with ``copy`` 1."""
    return df.withColumn("copy", F.expr(f"explode(if({marked}, array(0, 1), array(0)))"))


def _cased(column: str, by: str) -> str:
    return f"CASE ({by}) % 3 WHEN 0 THEN upper({column}) WHEN 1 THEN lower({column}) ELSE initcap({column}) END"


def _raw_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(journey(spark, sf_dir), "JourneyID % 10 = 0").selectExpr(
        "JourneyID",
        "CustomerID",
        "ProductID",
        "VisitDate",
        f"{_cased('Stage', 'JourneyID')} AS Stage",
        f"{_cased('Action', 'JourneyID + 1')} AS Action",
        "Duration",
    )


def _raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(reviews(spark, sf_dir), "ReviewID % 10 = 0").selectExpr(
        "ReviewID",
        "CustomerID",
        "ProductID",
        "ReviewDate",
        "Rating",
        """CASE WHEN ReviewID % 7 = 0 THEN NULL
        WHEN ReviewID % 5 = 0 THEN concat(' \t', ReviewText, '\n ') ELSE ReviewText END AS ReviewText""",
    )


def _raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(customers(spark, sf_dir), "CustomerID % 10 = 0").selectExpr(
        "CustomerID",
        "CustomerName",
        "Email",
        f"{_cased('Gender', 'CustomerID')} AS Gender",
        "if(CustomerID % 7 = 0, NULL, CAST(CustomerID % 130 + copy AS INT)) AS Age",
        "GeographyID",
        "CustomerID * 2 + copy AS arrival",
    )


def _raw_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(engagement(spark, sf_dir), "EngagementID % 10 = 0").selectExpr(
        "EngagementID",
        "ContentID",
        f"{_cased('ContentType', 'EngagementID')} AS ContentType",
        "Likes",
        "EngagementDate",
        "CampaignID",
        "ProductID",
        """CASE WHEN EngagementID % 11 = 0 THEN CAST(Views AS STRING)
        WHEN EngagementID % 13 = 0 THEN concat(Views, '-x') ELSE concat(Views, '-', Clicks) END AS ViewsClicksCombined""",
    )


def _raw_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(geography(spark, sf_dir), "GeographyID % 4 = 0").drop("copy")


def _raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(products(spark, sf_dir), "ProductID % 10 = 0").selectExpr(
        "ProductID",
        "ProductName",
        "Category",
        """CAST(CASE WHEN ProductID % 11 = 0 THEN 0 WHEN ProductID % 13 = 0 THEN -Price ELSE Price END
        AS DECIMAL(10,2)) AS Price""",
    )


class RawViews(Views):
    """The same tables with the irregularities that cleaning removes; customers carry an ``arrival`` order."""

    _builders = {
        "customer_journey": _raw_journey,
        "customer_reviews": _raw_reviews,
        "customers": _raw_customers,
        "engagement_data": _raw_engagement,
        "geography": _raw_geography,
        "products": _raw_products,
    }


def raw_tables(spark: SparkSession, sf_dir: str) -> RawViews:
    return RawViews(spark, sf_dir)
