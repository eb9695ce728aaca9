"""Tables with everything that may be wrong: NULLs, empty and long texts, ties, repeats, clashing names."""

import random

import duckdb

#: names that operators use or add
CLASHING = [
    "size", "key", "fp", "shard", "kept", "score", "lines", "host", "taken", "ids", "root", "row", "before",
    "n_words", "starts", "ends", "items", "item", "words", "found", "part", "step", "failed", "good", "toxic", "documents",
    "first_id", "content", "bit", "text_key", "filter_order", "lines_dropped", "toxicity", "secrets", "component_id", "grown_shard",
    "slot", "text_crc32", "source_size", "target", "n_tokens", "decoded", "soft_weight", "host_rejected", "base_failed", "documents_",
]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)


def texts(seed: int = 7) -> list[str | None]:
    pick = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "漢字", "x1", "don't", "###", "$$$", "a|b", "zeta"]

    def words(n: int) -> str:
        return " ".join(pick.choice(vocabulary) for _ in range(n))

    shared = "All rights reserved by the site owner."
    long = words(4000)
    odd = ["\x1c\x85\xa0 x", "a b  c\n\n", "one", "two words", "A b C", "a B c", "<|endoftext|> x<|endoftext|>", "\r\n \t"]
    lines = [f"{words(12)}\n{shared}\n{words(9)}" for _ in range(30)]
    near = [" ".join([*long.split()[:200], w]) for w in ("end", "END", "fin", "stop")]
    loops = ["go on and on and on and on and on and on and on and on", "same line here\nsame line here\nsame line here"]
    return [None, "", " ", *odd, *lines, *near, *loops, long, long, long + " more"]


def rows() -> list[tuple]:
    found = []
    for i, text in enumerate(texts()):
        source = [None, "", "src1", "src1", "src1", "Zürich", "src10"][i % 7]
        found.append((i * 3, text, "en", source, len(text or "")))
    found += [(None, "no id", "en", "src1", 5), (None, "no id", "en", "src1", 5), (None, None, None, None, None)]
    found += [(6, "id again", "en", "src1", 8), (9, "one", "en", None, 3), (9, "one", "en", None, 3), (-4, "neg", "de", "src1", 3)]
    return [(*row, *["clash"] * len(CLASHING)) for row in found]


def documents(spark):
    return spark.createDataFrame(rows(), DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def oracle_rows(sql: str, **tables) -> tuple[list[str], list[tuple]]:
    """What DuckDB finds over Spark tables."""
    connection = duckdb.connect()
    for name, df in tables.items():
        held = df.toArrow()
        connection.register(f"{name}_held", held)
        connection.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_held")
    cursor = connection.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def same_rows(df, columns: list[str], expected: list[tuple]) -> None:
    assert sorted(df.columns) == sorted(columns)
    found = df.select(*columns).collect()
    order = [tuple(row) for row in found], expected
    assert sorted(order[0], key=repr) == sorted(order[1], key=repr)
