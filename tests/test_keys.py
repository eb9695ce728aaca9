import random

import pytest

from cartrail.operators import keys, membership
from tests.shop import rows


def fact(spark, held):
    return spark.createDataFrame(held, "JourneyID bigint, CustomerID bigint, ProductID bigint, Note string")


def tables(spark):
    return {
        "customer_journey": fact(spark, [
            (1, 1, 10, "good"), (2, None, 10, "names no customer"), (3, 5, 10, "no such customer"), (4, 1, 99, "no such product"),
            (5, 5, 99, "neither"), (6, 1, 10, "twice"), (6, 2, 10, "twice"), (None, 1, 10, "no key"), (None, 5, 99, "no key"),
            (7, 2, 10, "customer is set aside"), (8, 3, 10, "so is this one"), (9, 4, 11, "good"),
        ]),
        "customers": spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, 7), (4, None)], "CustomerID bigint, GeographyID bigint"),
        "geography": spark.createDataFrame([(1, "x"), (2, "y")], "GeographyID bigint, City string"),
        "products": spark.createDataFrame([(10, "p"), (11, "q")], "ProductID bigint, ProductName string"),
    }


def test_every_row_is_good_or_bad_once(spark):
    held = tables(spark)
    checked = keys.quarantine(held)
    journey = {(r.JourneyID, r.Note): r.reason for r in checked.bad["customer_journey"].collect()}
    assert journey == {
        (3, "no such customer"): "no row in customers", (4, "no such product"): "no row in products", (5, "neither"): "no row in customers",
        (6, "twice"): "repeated key", (None, "no key"): "no key", (7, "customer is set aside"): "no row in customers",
        (8, "so is this one"): "no row in customers",
    }
    assert rows(checked.good["customer_journey"].select("JourneyID")) == [(1,), (2,), (9,)]
    assert rows(checked.bad["customers"]) == [(2, 1, "repeated key"), (2, 2, "repeated key"), (3, 7, "no row in geography")]
    for name, df in held.items():
        assert checked.good[name].columns == df.columns
        both = checked.good[name].unionByName(checked.bad[name].drop("reason"))
        assert rows(both) == rows(df)
    assert rows(checked.report()) == [
        ("customer_journey", "no key", 2), ("customer_journey", "no row in customers", 4), ("customer_journey", "no row in products", 1),
        ("customer_journey", "repeated key", 2), ("customers", "no row in geography", 1), ("customers", "repeated key", 2),
    ]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_a_hot_key_and_a_small_filter(spark, conf, monkeypatch, threshold):
    """A third of all rows share a key; a filter of few bits lets nearly all through and loses nothing."""
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    pick = random.Random(4)
    held = [(i, pick.randint(0, 40), 10, "x") for i in range(400)] + [(9999, 1, 10, "hot")] * 200 + [(i, 1, 10, "again") for i in range(0, 400, 50)]
    named = {"customers": spark.range(30).selectExpr("id AS CustomerID", "CAST(NULL AS bigint) AS GeographyID"), "customer_journey": fact(spark, held)}
    expected = sorted(
        (j, "repeated key" if j == 9999 or j % 50 == 0 else "no row in customers") for j, c, *_ in held if j == 9999 or j % 50 == 0 or c >= 30
    )
    for bits in (1 << 20, 64):
        monkeypatch.setattr(membership, "LEAST_BITS", bits)
        monkeypatch.setattr(membership, "MOST_BITS", bits)
        checked = keys.quarantine(named)
        assert sorted(rows(checked.bad["customer_journey"].select("JourneyID", "reason"))) == expected
        assert checked.good["customer_journey"].count() == len(held) - len(expected)


def test_clean_tables_are_not_shuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id AS JourneyID", "1L AS CustomerID", "10L AS ProductID", "'t' AS Note").write.parquet(f"{tmp_path}/j")
    named = {"customer_journey": spark.read.parquet(f"{tmp_path}/j"), "products": spark.createDataFrame([(10,)], "ProductID bigint")}
    checked = keys.quarantine(named)
    plan = checked.good["customer_journey"].where("Note = 't'")._jdf.queryExecution().optimizedPlan().toString()
    assert checked.good["customer_journey"].count() == 1000 and checked.bad["customer_journey"].count() == 0
    assert "Aggregate" not in plan


def test_reasons_are_found_in_one_read(spark, tmp_path):
    """However many keys are bad the rows are read once for their reasons, and whole numbers are compared as such."""
    held = tables(spark)
    held["customer_journey"].write.parquet(f"{tmp_path}/j")
    schema = "JourneyID bigint, CustomerID bigint, ProductID bigint, Note string"
    known = {name: held[name].selectExpr(f"{name[:-1].title()}ID AS key") for name in ("customers", "products")}
    stored = spark.read.schema(schema).parquet(f"{tmp_path}/j")
    found = keys._bad_keys(stored, "JourneyID", {"CustomerID": "customers", "ProductID": "products"}, known, "bigint")
    assert rows(found) == [(5, 1), (6, 0), (99, 2)]
    told = keys.quarantine({**held, "customer_journey": stored}).told["customer_journey"]
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [JourneyID") == 1 and "as string" not in plan


def test_keys_of_other_types_meet_as_text(spark):
    """A text column names a whole number as it is written, so '01' is not 1."""
    named = {
        "products": spark.createDataFrame([(1, "p")], "ProductID bigint, ProductName string"),
        "engagement_data": spark.createDataFrame([(1, "1"), (2, "01"), (3, "x"), (4, None)], "EngagementID int, ProductID string"),
    }
    found = keys.quarantine(named).bad["engagement_data"]
    assert rows(found) == [(2, "01", "no row in products"), (3, "x", "no row in products")]


def test_empty_tables_and_circles(spark):
    held = {name: df.limit(0) for name, df in tables(spark).items()}
    checked = keys.quarantine(held)
    assert checked.report().count() == 0 and all(df.count() == 0 for df in checked.good.values())
    with pytest.raises(ValueError, match="each other"):
        keys.quarantine(held, foreign={"customers": {"GeographyID": "geography"}, "geography": {"City": "customers"}})


def test_a_filter_never_loses_a_key(spark):
    seen = spark.range(0, 5000, 7).selectExpr("concat('k', id) AS key")
    held = membership.key_filter(seen)
    asked = spark.range(5000).selectExpr("id", "concat('k', id) AS key")
    found = {r.id for r in asked.where(held.may_contain(asked.key)).collect()}
    assert set(range(0, 5000, 7)) <= found and len(found) < 760
    assert asked.where(membership.KeyFilter((0,) * 8).may_contain(asked.key)).count() == 0
