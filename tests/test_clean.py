import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartrail import schemas
from cartrail.operators import clean
from tests.shop import rows

DAY = datetime.date(2024, 1, 1)


def raw_shop(spark):
    data = {
        "customer_journey": [
            (1, 1, 1, DAY, "Checkout", "Drop-off", None),
            (1, 1, 1, DAY, "CHECKOUT", "drop-OFF", 0.0),
            (2, 1, 1, DAY, "homepage", "View", 3.5),
        ],
        "customer_reviews": [
            (1, 1, 1, DAY, 5, "\t good  item \n"),
            (1, 1, 1, DAY, 5, "good  item"),
            (2, 1, 1, DAY, 4, None),
        ],
        "customers": [
            (1, "Ann", "a", "fEMALE", 5, 1),
            (1, "Ann B", "b", "male", 50, 2),
            (2, "Bob", "b", "MALE", 150, 1),
            (3, "Cid", "c", "male", None, None),
        ],
        "engagement_data": [
            (1, 1, "Blog", 1, DAY, 1, 1, "100-10"),
            (1, 1, "BLOG", 1, DAY, 1, 1, "100-10"),
            (2, 1, "video", 1, DAY, 1, 1, "5"),
            (3, 1, "video", 1, DAY, 1, 1, "1x-2"),
            (4, 1, "video", 1, DAY, 1, 1, None),
            (5, 1, "video", 1, DAY, 1, 1, "1-2-3"),
        ],
        "geography": [(1, "Austria", "Vienna"), (1, "Austria", "Vienna"), (2, "Spain", "Madrid")],
        "products": [
            (1, "Kayak", "Sport", Decimal("9.99")),
            (1, "Kayak", "Sport", Decimal("9.99")),
            (2, "Free", "Sport", Decimal("0.00")),
            (3, "Odd", "Sport", Decimal("-1.00")),
        ],
    }
    tables = {name: spark.createDataFrame(part, schemas.RAW[name]) for name, part in data.items()}
    tables["customers"] = tables["customers"].coalesce(1).withColumn("arrival", F.monotonically_increasing_id())
    return tables


def test_whole_pipeline(spark):
    cleaned = clean.clean_all(raw_shop(spark), "arrival")
    assert rows(cleaned["customer_journey"]) == [
        (1, 1, 1, DAY, "checkout", "drop-off", 0.0),
        (2, 1, 1, DAY, "homepage", "view", 3.5),
    ]
    assert rows(cleaned["customer_reviews"]) == [(1, 1, 1, DAY, 5, "good  item"), (2, 1, 1, DAY, 4, "No review")]
    assert rows(cleaned["customers"]) == [
        (1, "Ann", "a", "Female", 18, 1),
        (2, "Bob", "b", "Male", 100, 1),
        (3, "Cid", "c", "Male", None, None),
    ]
    assert rows(cleaned["engagement_data"].select("EngagementID", "ContentType", "Views", "Clicks")) == [
        (1, "BLOG", 100, 10),
        (2, "VIDEO", None, None),
        (3, "VIDEO", None, None),
        (4, "VIDEO", None, None),
        (5, "VIDEO", None, None),
    ]
    assert rows(cleaned["geography"]) == [(1, "Austria", "Vienna"), (2, "Spain", "Madrid")]
    assert rows(cleaned["products"].select("ProductID", "ProductName")) == [(1, "Kayak")]
    for name, schema in schemas.CLEAN.items():
        assert sorted(cleaned[name].columns) == sorted(schema.names)


def test_cleaning_again_changes_nothing(spark):
    cleaned = clean.clean_all(raw_shop(spark), "arrival")
    assert rows(clean.clean_journey(cleaned["customer_journey"])) == rows(cleaned["customer_journey"])
    assert rows(clean.clean_reviews(cleaned["customer_reviews"])) == rows(cleaned["customer_reviews"])
    assert rows(clean.clean_products(cleaned["products"])) == rows(cleaned["products"])


def test_strip_removes_every_kind_of_edge_blank(spark):
    text = "  \x1f a  b \r\n\x85"
    df = spark.createDataFrame([(text,), ("",), (None,), (" \t",)], "t string")
    assert [r.t for r in clean.strip_blanks(df, "t").collect()] == [text.strip(), "", None, ""]


def test_capitalise_touches_the_first_letter_only(spark):
    df = spark.createDataFrame([("new YORK city",), ("",), (None,)], "t string")
    assert [r.t for r in clean.capitalise(df, "t").collect()] == ["New york city", "", None]


def test_malformed_pairs_and_strict_mode(spark):
    raw = raw_shop(spark)["engagement_data"]
    assert rows(clean.malformed_pairs(raw, "ViewsClicksCombined").select("EngagementID")) == [(2,), (3,), (4,), (5,)]
    with pytest.raises(PySparkException, match="not a pair"):
        clean.clean_engagement(raw, strict=True).collect()


def test_pair_out_of_range_is_malformed(spark):
    df = spark.createDataFrame([("99999999999-1",), (" 7 - 8 ",)], "p string")
    assert rows(clean.split_pair(df, "p", "a", "b")) == [(7, 8), (None, None)]
    assert clean.malformed_pairs(df, "p").count() == 1


def test_first_row_per_key_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS arrival", "concat('row', id) AS v")
    kept = clean.keep_first_per_key(df, "k", "arrival")
    found = {r.k: r.v for r in kept.collect()}
    expected = {}
    for i in range(3000):
        expected.setdefault(7 if i % 3 == 0 else i, f"row{i}")
    assert found == expected


def test_missing_key_is_one_key(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a")], "k bigint, arrival bigint, v string")
    assert rows(clean.keep_first_per_key(df, "k", "arrival")) == [(None, "a")]
