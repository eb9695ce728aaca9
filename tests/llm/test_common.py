"""Where intermediate tables go, and rows of which a third are equal."""

from collections import Counter
from types import SimpleNamespace

import pytest

from cartrail.llm import common, mixing, simhash


def session(application, **options):
    """Only the settings of a session, which can't be changed."""
    held = {name.replace("__", "."): value for name, value in options.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: held.get(key, default)), sparkContext=SimpleNamespace(applicationId=application))


def test_the_folder_that_the_session_names():
    assert common.shared_dir(session("a", spark__master="yarn", spark__checkpoint__dir="hdfs:/shared/")) == "hdfs:/shared"


def test_a_local_session_keeps_one_folder_without_a_setting():
    first = common.shared_dir(session("local-1", spark__master="local[2]"))
    assert first == common.shared_dir(session("local-1", spark__master="local[2]"))
    assert first != common.shared_dir(session("local-2", spark__master="local"))


def test_a_cluster_needs_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session("c", spark__master="yarn"))


def third_equal(spark):
    rows = [(i, f"text {i} of many words", "s1" if i % 2 else None) for i in range(60)]
    rows += [(None, "one text that a third of all rows repeat", "hot")] * 30
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_running_totals_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "RUN", 7)  # several runs of copies
    rows = [("a", i * 2**45, i % 4) for i in range(100)] + [("hot", 5 * 2**45, 3)] * 50 + [(None, 2**45, None)]
    found = common.running_totals(spark.createDataFrame(rows, "g string, k long, n long"), "g", "k", "n").collect()
    assert Counter(tuple(r)[:3] for r in found) == Counter(rows)
    assert sorted(r["before"] for r in found if r["g"] == "hot") == list(range(0, 150, 3))
    assert [r["before"] for r in sorted(found, key=lambda r: r["k"]) if r["g"] == "a"] == [sum(j % 4 for j in range(i)) for i in range(100)]


def test_equal_documents_share_their_copies(spark, monkeypatch):
    monkeypatch.setattr(common, "RUN", 7)
    docs = third_equal(spark)
    due = mixing.mix(docs).groupBy("source").agg({"taken": "sum"}).collect()
    out = mixing.mixed_documents(docs).collect()
    got = Counter()
    for row in out:
        got[row["source"]] += len(row["text"].split())
    assert all(abs(got[source] - taken) <= 9 for source, taken in map(tuple, due))
    assert max(Counter(r["doc_id"] for r in out if r["doc_id"] is not None).values()) <= 2


def test_one_of_equal_documents_stays(spark):
    kept = simhash.one_of_each(third_equal(spark)).collect()
    assert sum(r["source"] == "hot" for r in kept) == 1
    assert len(kept) == len(set(kept))
