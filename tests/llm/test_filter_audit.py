"""Carry-save popcounts against plain sums, and the audit against SQL."""

import random
from itertools import permutations

import numpy as np
import pytest

from cartrail.llm import filter_audit, oracle, queries
from tests.llm import messy


@pytest.mark.parametrize("rows, groups", [(0, 1), (1, 1), (2, 3), (3, 1), (1000, 1), (5000, 7), (300, 400)])
def test_positional_counts(rows, groups):
    pick = np.random.default_rng(rows)
    words = pick.integers(0, 2**32, rows, dtype=np.uint32)
    group = pick.integers(0, groups, rows)
    found = filter_audit.positional_counts(words, group, groups)
    for g in range(groups):
        mine = words[group == g]
        assert found[g].tolist() == [int((mine >> np.uint32(i) & 1).sum()) for i in range(32)]


def test_survival_words():
    words = filter_audit.survival_words()
    assert all(bool(int(words[f]) >> s & 1) == (f & s == 0) for f in range(32) for s in range(32))


def documents(spark):
    pick = random.Random(2)
    rows = messy.rows()
    clash = ["clash"] * len(messy.CLASHING)
    for i in range(1000, 1060):
        words = [pick.choice(["Alpha", "BETA", "x", "$5", *map(str, range(60))]) for _ in range(pick.choice([50, 250]))]
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 1, *clash))
    rows += [(2000 + i % 40, "hot copy", "en", "src1", 8, *clash) for i in range(90)]
    return spark.createDataFrame(rows, messy.DOCS)


def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 2040, 3)] + [(9, 1, 0), (9, 0, 1), (None, 1, 1), (1001, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("some_docs, some_labels", [(True, True), (True, False), (False, True)])
def test_messy_tables(spark, tmp_path, some_docs, some_labels):
    docs = documents(spark) if some_docs else messy.no_documents(spark)
    told = labels(spark) if some_labels else labels(spark).limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    told.write.parquet(f"{tmp_path}/labels.parquet")
    columns, expected = messy.oracle_rows(oracle.OP13, documents=docs, labels=told)
    messy.same_rows(queries.op13_filter_audit(spark, str(tmp_path)), columns, expected)
    assert (len(expected) > 0) == some_docs


def test_counts_add_up(spark):
    docs = documents(spark)
    rows = filter_audit.audit(docs, labels(spark)).collect()
    parts = {r["part"] for r in rows}
    assert len(rows) == 600 * len(parts) and {r["filter_order"] for r in rows} == set(map("".join, permutations("ABCDE")))
    total = dict.fromkeys(parts, 0)
    for r in docs.collect():
        total[r["source"] or ""] += 1
    for part in parts:
        mine = [r for r in rows if r["part"] == part]
        for order in ("ABCDE", "EDCBA", "CAEBD"):
            steps = sorted((r for r in mine if r["filter_order"] == order), key=lambda r: r["step"])
            assert total[part] == steps[-1]["kept"] + sum(r["removed"] for r in steps)
        letters = {r["filter_order"][r["step"] - 1]: r["shapley"] for r in mine}
        assert sum(letters.values()) == 120 * (total[part] - steps[-1]["kept"])
