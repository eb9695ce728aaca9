import random

import pytest

from cartrail.operators import clean, duplicates, membership, profile
from tests.shop import rows

KINDS = "a bigint, b string, c double"


def table(spark, seed=3, size=400):
    pick = random.Random(seed)
    some = [None, 0, 1, 2, 3]
    held = [(pick.choice(some), pick.choice([None, "", "x", "y" * 500]), pick.choice([None, 0.0, -0.0, 1.5])) for _ in range(size // 4)]
    held += [(i, f"alone {i}", None) for i in range(size // 4)] + [(7, "hot " * 50, 1.0)] * (size // 2)
    return spark.createDataFrame(held, KINDS).repartition(5)


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_same_rows_as_distinct(spark, monkeypatch, bits):
    """Also where the filter is so small that it lets nearly everything through."""
    monkeypatch.setattr(membership, "LEAST_BITS", bits)
    monkeypatch.setattr(membership, "MOST_BITS", bits)
    df = table(spark)
    assert rows(duplicates.distinct_rows(df)) == rows(df.distinct())
    assert rows(duplicates.repeated_rows(df)) == [(df.count() - df.distinct().count(),)]
    assert duplicates.distinct_rows(df.limit(0)).count() == 0 and rows(duplicates.repeated_rows(df.limit(0))) == [(0,)]


def test_equal_fingerprints_are_compared_whole(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(duplicates, "fingerprint", lambda df: [F.lit(1).cast("bigint"), F.lit(2).cast("bigint")])
    df = table(spark)
    assert rows(duplicates.distinct_rows(df)) == rows(df.distinct())
    assert rows(duplicates.repeated_rows(df)) == [(df.count() - df.distinct().count(),)]


def test_a_null_is_not_the_value_beside_it(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "x"), (None, None)], "a string, b string")
    low, high = duplicates.fingerprint(df)
    assert df.select(low, high).distinct().count() == 4
    assert clean.drop_duplicate_rows(df, wide=True).count() == 4


def test_draws_follow_from_the_values(spark):
    df = spark.range(500).selectExpr("id", "concat('g', id % 3) AS g", "IF(id % 50 = 0, NULL, id % 7) AS w")
    for options in ({}, {"weight": "w"}, {"by": ["id"]}):
        first = rows(profile.sample_rows(df, 20, 1, **options))
        assert len(set(first)) == 20
        for parts in (1, 13):
            assert rows(profile.sample_rows(df.repartition(parts), 20, 1, **options)) == first
        assert rows(profile.sample_rows(df, 20, 2, **options)) != first
    drawn = profile.sample_rows(df, 500, 1, weight="w").collect()
    assert len(drawn) == df.where("w > 0").count() and all(r.w for r in drawn)


def test_weights_make_chances(spark):
    df = spark.range(3000).selectExpr("id", "IF(id < 1000, 8.0D, 1.0D) AS w")
    heavy = profile.sample_rows(df, 300, 5, weight="w").where("id < 1000").count()
    assert 220 < heavy < 270  # 8 of 10 at the start, fewer as they are used up
    plain = profile.sample_rows(df, 300, 5).where("id < 1000").count()
    assert 70 < plain < 130


def test_strata(spark):
    held = [(i, "hot") for i in range(900)] + [(i, "rare") for i in range(3)] + [(i, None) for i in range(20)]
    df = spark.createDataFrame(held, "id bigint, g string")
    drawn = profile.sample_strata(df, 5, ["g"], 1)
    assert drawn.columns == df.columns
    assert rows(drawn.groupBy("g").count()) == rows(spark.createDataFrame([("hot", 5), ("rare", 3), (None, 5)], "g string, n bigint"))
    assert rows(profile.sample_strata(df.repartition(9), 5, ["g"], 1)) == rows(drawn)
    assert "WindowGroupLimit" in drawn._jdf.queryExecution().executedPlan().toString()


def test_correlation_matrix_with_gaps(spark):
    pick = random.Random(1)
    held = [tuple(pick.choice([None, pick.gauss(0, 1)]) for _ in range(3)) + (4.0, None) for _ in range(200)]
    df = spark.createDataFrame(held, "a double, b double, c double, same double, none double")
    found = {r.column_name: r for r in profile.correlation_matrix(df, *df.columns).collect()}
    import pandas

    expected = pandas.DataFrame(held, columns=df.columns).astype(float).corr()
    for a in ("a", "b", "c"):
        for b in ("a", "b", "c"):
            assert abs(found[a][b] - expected[a][b]) < 1e-9
    assert found["a"]["same"] is None and found["same"]["same"] is None and found["none"]["a"] is None
    assert profile.correlation_matrix(df.limit(0), "a", "b").collect()[0]["a"] is None
    assert rows(profile.correlation_matrix(df, "a")) == [("a", 1.0)]


def test_sketches_are_within_their_error_in_one_scan(spark, tmp_path):
    spark.range(60_000).selectExpr(
        "id % 20000 AS few", "CAST(id AS STRING) AS many", "pow(id, 1.5) AS x", "CAST(NULL AS DOUBLE) AS none", "DATE'2024-01-01' + INT(id % 90) AS day"
    ).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    profiled = profile.sketch_profile({"t": df}, (0.1, 0.5, 0.99))
    assert profiled._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = {r.column_name: r for r in profiled.collect()}
    for name, exact in {"few": 20_000, "many": 60_000, "x": 60_000, "day": 90, "none": 0}.items():
        assert abs(found[name].distinct - exact) <= profile.DISTINCT_ERROR * exact
    for name in ("few", "x"):
        for rank, value in zip((0.1, 0.5, 0.99), found[name].quantiles, strict=True):
            assert abs(df.where(f"{name} <= {value!r}D").count() / 60_000 - rank) <= profile.RANK_ERROR
    assert found["day"].least == "2024-01-01" and found["day"].greatest == "2024-03-30" and not found["day"].quantiles
    assert found["none"].nulls == 60_000 and not found["none"].quantiles and found["none"].least is None
    assert profile.sketch_profile({"t": df.limit(0)}).where("rows = 0 AND distinct = 0").count() == 5


def test_customers_by_period_and_together(spark):
    from cartrail import Star
    from cartrail.plans import customer

    visits = spark.range(60_000).selectExpr("id % 9000 AS CustomerID", "DATE'2024-01-01' + INT(id % 90) AS VisitDate", "id AS JourneyID")
    visits = visits.unionByName(spark.createDataFrame([(None, None, 1)], visits.schema))
    star = Star({"customer_journey": visits})
    months = customer.retention_by_period(customer.customer_states(star)).orderBy("period").collect()
    exact = visits.where("VisitDate IS NOT NULL").selectExpr("trunc(VisitDate, 'month') AS m", "CustomerID").distinct()
    counts = {r.m: r["count"] for r in exact.groupBy("m").count().collect()}
    assert [r.period for r in months] == sorted(counts) and months[-1].returning is None
    assert all(abs(r.customers - counts[r.period]) <= 0.05 * counts[r.period] for r in months)
    both = exact.where("m = '2024-01-01'").join(exact.where("m = '2024-02-01'"), "CustomerID").count()
    assert abs(months[0].returning - both) <= 0.08 * max(both, 2000)
    together = customer.customers_of(customer.customer_states(star, "day")).first()[0]
    assert abs(together - 9000) <= 450
