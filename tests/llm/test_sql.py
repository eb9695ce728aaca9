"""The queries that SQL can express, against it, on the small tables and on messy ones."""

import os

import pytest
from pyspark.sql import functions as F

from cartrail.llm import host_quality, line_dedup, mixing, oracle, queries, sharding, url_lists
from cartrail.llm.common import table
from tests.llm import messy

SF_DIR = "/root/testdata/sf0.001"
#: tables other than documents alone
TABLES = {
    "op2_url_lists": ["pages"],
    "op10_exact_topk": ["embeddings"],
    "op11_decontaminate": ["documents", "benchmark"],
    "op12_repair_conversations": ["conversations"],
    "op13_filter_audit": ["documents", "labels"],
}
SQL = oracle.statements()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    read = TABLES.get(name, ["documents"])
    columns, expected = messy.oracle_rows(SQL[name], **{t: table(spark, SF_DIR, t) for t in read})
    messy.same_rows(queries.queries()[name](spark, SF_DIR), columns, expected)


@pytest.mark.parametrize("name", sorted(set(SQL) - set(TABLES)))
@pytest.mark.parametrize("some", [True, False])
def test_messy_documents(spark, tmp_path, name, some):
    docs = messy.documents(spark) if some else messy.no_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    columns, expected = messy.oracle_rows(SQL[name], documents=docs)
    assert bool(expected) == some
    messy.same_rows(queries.queries()[name](spark, str(tmp_path)), columns, expected)


def test_messy_pages(spark, tmp_path):
    urls = [
        None, "", "not a url", "http://", "http://A.Example.com", "https://user:pw@a.example.com:8080/x/y?z#q",
        "http://a.example.com/x", "http://a.example.com/x", "ftp://b.a.example.com/é/z", "http://localhost/x", "http://1.2.3.4/",
    ]
    rows = [(i if i % 5 else None, u, "<p>", "clash") for i, u in enumerate(urls * 9)] + [(10**9, u, None, "c") for u in urls]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, pattern string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    columns, expected = messy.oracle_rows(oracle.OP2, pages=pages)
    messy.same_rows(queries.op2_url_lists(spark, str(tmp_path)), columns, expected)
    assert len({row[columns.index("action")] for row in expected}) == 3


def test_empty_pages_and_lists(spark):
    captures = spark.createDataFrame([("http://a.com/x", None), ("http://a.com/x", "2024-05-01")], "url string, day string")
    captures = captures.select("url", F.col("day").cast("date").alias("fetched_at"))
    entries = spark.createDataFrame([], "pattern string, action string, listed_at date")
    assert [r["blocked"] for r in url_lists.judge_captures(captures, entries).collect()] == [False, False]
    assert url_lists.judge_captures(captures.limit(0), entries).count() == 0


def test_an_entry_holds_until_the_next(spark):
    dated = [("a.com", "block", "2024-02-01"), ("a.com", "remove", "2024-04-10"), ("a.com/x", "allow", "2024-03-01"), (None, "block", "2024-01-01")]
    entries = spark.createDataFrame(dated, "pattern string, action string, day string")
    entries = entries.select("pattern", "action", F.col("day").cast("date").alias("listed_at"))
    days = ["2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01", "2024-04-09", "2024-04-10", "2025-01-01"]
    asked = [(f"http://www.a.com/{p}", d) for p in "xy" for d in days] + [(f"http://a.com/{p}", d) for p in "xy" for d in days]
    captures = spark.createDataFrame(asked, "url string, day string").select("url", F.col("day").cast("date").alias("fetched_at"))
    found = {(r["url"], str(r["fetched_at"])): r["blocked"] for r in url_lists.judge_captures(captures, entries).collect()}
    listed = {d: "2024-02-01" <= d < "2024-04-10" for d in days}
    for (url, day), blocked in found.items():
        allowed = url == "http://a.com/x" and day >= "2024-03-01"
        assert blocked == (listed[day] and not allowed)


def test_a_host_is_rejected_only_on_evidence(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good, f"good{i % 10}") for i in range(400)] + [(1000 + i, "#### " * 30, "bad") for i in range(60)]
    rows += [(2000 + i, good, "bad") for i in range(10)] + [(3000, "too short", "tiny"), (3001, good, "tiny"), (3002, good, None)]
    found = {r["doc_id"]: r for r in host_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(found[i]["kept"] for i in range(400))
    assert found[2000]["host_rejected"] and not found[2000]["base_failed"] and not found[2000]["kept"]
    assert found[3001]["kept"] and not found[3000]["kept"] and found[3002]["kept"]


def test_a_host_decides_on_soft_failures(spark):
    """Symbols in a few documents of a host that fails often weigh more than 1, in one document of a clean host less."""
    good, odd = " ".join(f"word{i}" for i in range(40)), " ".join([f"word{i}" for i in range(40)] + ["#$%&*|"] * 2)
    rows = [(i, good, f"clean{i % 10}") for i in range(1000)] + [(2000 + i, odd if i % 3 == 0 else good, "spam") for i in range(90)]
    rows += [(3000, odd, "clean1"), (3001, odd, None), (3002, odd + "\n" + "\n".join(["again and again"] * 3), "clean1")]
    found = {r["doc_id"]: r for r in host_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found[3000]["kept"] and found[3000]["symbols"] and found[3000]["soft_weight"] < 0.8
    assert not found[2000]["kept"] and found[2000]["soft_weight"] > 2 and not found[2000]["host_rejected"]
    assert not found[3001]["kept"] and found[3001]["soft_weight"] == 1.0
    assert found[2001]["kept"]


def test_line_dedup_keeps_columns_rows_and_whole_copies(spark):
    docs = messy.documents(spark)
    cleaned = line_dedup.drop_boilerplate(docs)
    assert cleaned.columns == [*(c for c in docs.columns if c != "lines_dropped"), "lines_dropped"]
    assert cleaned.count() == docs.count()
    copies = spark.createDataFrame([(i, "same\nlines", "s") for i in range(20)], "doc_id long, text string, source string")
    assert {r["text"] for r in line_dedup.drop_boilerplate(copies).collect()} == {"same\nlines"}


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (i % 13), f"s{i % 3}") for i in range(900)] + [(i, "w " * 40, "hot") for i in range(1000, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    by_source = mixed.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("d"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    for row in by_source.collect():
        assert row["t"] == int(row["d"]) and row["over"] <= 0
    assert sorted(mixed.collect()) == sorted(mixing.mix(docs.repartition(7)).collect())


def test_mixed_documents_are_whole_and_keep_columns(spark):
    docs = messy.documents(spark).unionByName(messy.documents(spark))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    due = mixing.mix(docs).groupBy("source").agg(F.first("target")).collect()
    sizes = out.groupBy("source").agg(F.sum(F.size(mixing.words(F.col("text"))))).collect()
    longest = 4001
    got = dict(map(tuple, sizes))
    assert all(abs(got.get(s, 0) - t) <= longest for s, t in map(tuple, due))
    assert mixing.mixed_documents(messy.no_documents(spark)).count() == 0


def test_a_new_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    weights = (1.0, 1.0, 2.0)
    rows = sharding.shard(docs, weights, (*weights, 1.0)).collect()
    assert all(r["grown_shard"] in (r["shard"], 3) for r in rows)
    counts = [sum(r["shard"] == s for r in rows) for s in range(3)]
    assert abs(counts[2] - 2000) < 150 and abs(counts[0] - 1000) < 150
    for s in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    with pytest.raises(ValueError):
        sharding.shard(docs, (1.0, 0.0))
