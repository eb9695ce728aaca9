import pytest

from cartrail.operators import joins
from tests.shop import rows


@pytest.fixture(scope="module")
def sides(spark):
    fact = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 40 END AS k")
    lookup = spark.range(30).selectExpr("id AS k", "concat('n', id) AS name")
    return fact, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(sides, how):
    fact, lookup = sides
    salted = joins.salted_join(fact, lookup, "k", ["id"], how, salts=16)
    plain = fact.join(lookup, "k", how)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert rows(salted.select(plain.columns)) == rows(plain)


def test_hot_keys_are_few_and_exact(sides):
    fact, _ = sides
    assert rows(joins.hot_keys(fact, "k", share=0.1)) == [(7,)]
    assert joins.hot_keys(fact, "k", share=0.01).count() < 100


def test_salting_spreads_the_hot_key(sides, conf):
    fact, lookup = sides
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    sizes = joins.salted_join(fact, lookup, "k", ["id"], salts=64, share=0.1).where("k = 7").selectExpr(
        "spark_partition_id() AS part"
    ).groupBy("part").count()
    assert sizes.count() == 4
    assert max(r["count"] for r in sizes.collect()) < 600


def test_lookup_join_salts_only_without_adaptive_skew_handling(sides, conf):
    fact, lookup = sides

    def plan():
        return joins.lookup_join(fact, lookup, "k", ["id"])._jdf.queryExecution().toString()

    assert "_salt" not in plan()
    conf(spark__sql__adaptive__skewJoin__enabled="false")
    assert "_salt" in plan()
    assert rows(joins.lookup_join(fact, lookup, "k", ["id"])) == rows(fact.join(lookup, "k"))


def test_adaptive_execution_splits_a_hot_key(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    fact = spark.range(0, 200000, 1, 8).selectExpr("xxhash64(id) AS payload", "if(id % 3 = 0, 7, id) AS k")
    lookup = spark.range(0, 200000, 1, 8).selectExpr("id AS k", "id * 2 AS v")
    largest = joins.lookup_join(fact, lookup, "k", ["payload"]).groupBy("v").agg({"payload": "max"})
    assert len(largest.collect()) == 133333
    assert "skew=true" in largest._jdf.queryExecution().executedPlan().toString()
