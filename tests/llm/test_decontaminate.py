"""Wu-Manber search against a plain one, and benchmarks that take several passes."""

import random

import pytest

from cartrail.llm import decontaminate, oracle, queries
from tests.llm import messy


def plain(words, items):
    """Positions inside windows, and the items whose windows occur."""
    hit, named = set(), set()
    for item, held in items:
        size = min(10, len(held))
        windows = {tuple(held[i : i + size]) for i in range(len(held) - size + 1)} if held else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                named.add(item)
    return hit, named


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_what_a_plain_one_finds(seed):
    pick = random.Random(seed)
    vocabulary = [bytes([97 + i]) for i in range(2 + seed)]

    def words(n):
        return [pick.choice(vocabulary) for _ in range(n)]

    items = [(f"i{i % 7}", words(pick.choice([1 + seed, 2 + seed, 4, 9, 10, 11, 30]))) for i in range(12)]
    patterns = decontaminate.Patterns([(item, b" ".join(held).decode()) for item, held in items])
    for n in (0, 1, 5, 9, 10, 11, 200):
        text = words(n)
        if n == 200:
            text[50:80] = items[pick.randrange(12)][1]
        runs, named = patterns.search(text)
        hit, expected = plain(text, items)
        assert {i for a, b in runs for i in range(a, b)} == hit and set(named) == expected and named == sorted(named)
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:], strict=False))


def test_entries_shared_by_blocks_lose_nothing():
    words = [f"w{i}".encode() for i in range(400)]
    table = decontaminate.WindowTable([words], [0], 10)
    table.mask = 0  # every block in one entry
    table.shift, n = b"\0", len(table.starts)
    order = sorted(range(n), key=lambda i: table.wholes[i])
    table.bucket, table.wholes = memoryview(bytes(0)).cast("B"), [table.wholes[i] for i in order]
    table.bucket, table.starts, table.owner = [0, n], [table.starts[i] for i in order], [0] * n
    spans, items = [], set()
    table.search([b"x", *words[5:20], b"y"], spans, items)
    assert spans == [(i, i + 10) for i in range(1, 7)] and items == {0}


def benchmark(spark):
    long = " ".join(f"Word{i}" for i in range(60))
    rows = [
        (1, "alpha beta gamma", "c"), (10, "one", "c"), (2, None, "c"), (3, "", "c"), (4, "...", "c"), (None, "two WORDS", "c"),
        (5, long, "c"), (5, long, "c"), (6, long[-200:] + " end", "c"), (7, "délta 漢字 x1", "c"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string, n_words string")


def documents(spark):
    long = " ".join(f"word{i}" for i in range(60))
    extra = [(500, f"x {long} y", "en", "s", 1), (501, f"{long[:70]}", "en", "s", 1), (500, f"x {long} y", "en", "s", 1)]
    extra += [(502, f"{long} and {long}", "en", "s", 1), (503, long.replace("word30", "WORD-30"), "en", "s", 1), (None, long, None, None, None)]
    rows = messy.rows() + [(*r, *["clash"] * len(messy.CLASHING)) for r in extra]
    return spark.createDataFrame(rows, messy.DOCS)


@pytest.mark.parametrize("some_docs, some_items", [(True, True), (True, False), (False, True)])
def test_messy_tables(spark, tmp_path, some_docs, some_items):
    docs = documents(spark) if some_docs else messy.no_documents(spark)
    items = benchmark(spark) if some_items else benchmark(spark).limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    columns, expected = messy.oracle_rows(oracle.OP11, documents=docs, benchmark=items)
    assert any(row[columns.index("contaminated")] for row in expected) == (some_docs and some_items)
    messy.same_rows(queries.op11_decontaminate(spark, str(tmp_path)), columns, expected)


def test_several_passes_find_the_same(spark, monkeypatch):
    docs, items = documents(spark), benchmark(spark)
    once = decontaminate.contamination(docs, items).collect()
    again = decontaminate.contamination(docs, items, at_once=200).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, again))
    assert sum(len(r["starts"]) for r in once) > 5


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    words = [f"w{i}" for i in range(40)]
    for n in (1, 9, 10, 16, 17, 18, 40):
        items = spark.createDataFrame([(1, " ".join(words[:n]))], "item_id long, text string")
        pieces = [r["words"].split() for r in decontaminate.benchmark_pieces(items).collect()]
        size = min(10, n)
        found = {tuple(p[i : i + size]) for p in pieces for i in range(len(p) - size + 1)}
        assert found == {tuple(words[i : i + size]) for i in range(n - size + 1)}
        assert all(len(p) >= size and len(p) <= 16 for p in pieces)
