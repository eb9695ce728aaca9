from cartrail.operators import profile
from tests.shop import ordered, rows


def _table(spark):
    return spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, None, 1.5), (None, "b", 2.5), (None, "b", 2.5)], "k bigint, t string, x double"
    )


def test_nulls(spark):
    assert rows(profile.null_counts({"t": _table(spark)})) == [("t", "k", 2), ("t", "t", 1), ("t", "x", 2)]


def test_duplicates_treat_nulls_as_equal(spark):
    assert rows(profile.duplicate_counts({"t": _table(spark), "empty": _table(spark).limit(0)})) == [("empty", 0), ("t", 2)]


def test_uniqueness(spark):
    one_null = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    tables = {"t": _table(spark), "u": one_null, "empty": one_null.limit(0)}
    found = profile.key_uniqueness(tables, {"t": "k", "u": "k", "empty": "k"})
    assert rows(found) == [("empty", "k", True, 0), ("t", "k", False, 2), ("u", "k", True, 1)]


def test_value_counts_most_frequent_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "t string")
    assert ordered(profile.value_counts(df, "t")) == [("t", "c", 2), ("t", "a", 1), ("t", "b", 1)]
    assert profile.value_counts(_table(spark)).count() == 6


def test_info(spark):
    found = rows(profile.table_info({"t": _table(spark)}))
    assert found == [("t", "k", "bigint", 5, 3), ("t", "t", "string", 5, 4), ("t", "x", "double", 5, 3)]


def test_inferred_types(spark):
    df = spark.createDataFrame(
        [("1", "1", "x", "2024-01-01", None), ("-2", "2.5e3", "1", None, None)],
        "a string, b string, c string, d string, e string",
    )
    kinds = {r.column_name: r.type for r in profile.inferred_types({"t": df}).collect()}
    assert kinds == {"a": "bigint", "b": "double", "c": "string", "d": "string", "e": "string"}


def test_head_tail_and_sample(spark):
    df = spark.range(100)
    assert ordered(profile.head(df, 2, "id")) == [(0,), (1,)]
    assert ordered(profile.tail(df, 2, "id")) == [(99,), (98,)]
    drawn = rows(profile.sample_rows(df, 6, seed=3))
    assert len(set(drawn)) == 6
    assert drawn == rows(profile.sample_rows(df, 6, seed=3))
