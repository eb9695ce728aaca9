"""BPE against the tokenizers library, and the automaton against merging by rank."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartrail.llm import bpe, queries
from tests.llm import messy

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.fixture(scope="module")
def coder():
    return bpe.Tokenizer(bpe.load_vocabulary(queries.vocabulary_path()))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(queries.vocabulary_path())


def check(coder, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids(coder.encode(text)) == expected, text[:80]
    assert coder.decode(coder.encode(text)) == library.decode(expected, skip_special_tokens=False)


def test_texts_of_every_kind(coder, library):
    pick = random.Random(3)
    signs = list("abcdeflts'  \n\t.,!?019éßñ漢😀\x1c\x85\xa0 ​½²Ⅷ_-")
    for _ in range(1500):
        check(coder, library, "".join(pick.choice(signs) for _ in range(pick.randint(0, 40))))
    for _ in range(700):
        spans = [(0, 0x250), (0, 0xD7FF), (0xE000, 0x2FFFF), (0x30000, 0x10FFFF)]
        check(coder, library, "".join(chr(pick.randint(*pick.choice(spans))) for _ in range(20)))
    for text in ["a" * 5000, "isis" * 30, " " * 99 + "x", "<|endoftext|> <|endoftext|>", "it's''s'd", ""]:
        check(coder, library, text)


def test_automaton_is_merging_by_rank():
    pick = random.Random(5)
    for _ in range(60):
        labels = [bytes([b]) for b in range(256)]
        known, merges = set(labels), []
        letters = [b"a", b"b", b"c"]
        while len(merges) < 25:
            pool = letters + [u + v for u, v in merges]
            pair = pick.choice(pool), pick.choice(pool)
            if pair[0] + pair[1] not in known:
                known.add(pair[0] + pair[1])
                labels.append(pair[0] + pair[1])
                merges.append(pair)
        numbers = {label: i for i, label in enumerate(labels)}
        machine = bpe.MergeAutomaton(bpe.Vocabulary(tuple(merges), numbers, {}))
        for _ in range(60):
            word = bytes(pick.choice(b"abc") for _ in range(pick.randint(1, 14)))
            parts = [bytes([b]) for b in word]
            for u, v in merges:
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == u and parts[i + 1] == v:
                        parts[i : i + 2] = [u + v]
                    i += 1
            assert machine.encode(word) == [numbers[p] for p in parts]


def test_beginnings_are_kept():
    """Words of 60,000 beginnings: what the first pass looked up, the second finds."""
    machine = bpe.MergeAutomaton(bpe.load_vocabulary(queries.vocabulary_path()))
    pick = random.Random(9)
    words = ["".join(pick.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)).encode() for _ in range(60_000)]
    first = [machine.encode(word) for word in words]
    walked = []
    plain, machine._walk = machine._walk, lambda word, place: walked.append(word) or plain(word, place)
    assert [machine.encode(word) for word in words] == first
    assert len(walked) < len(words) / 20 and len(machine.near) <= bpe.BEGINNINGS


def test_messy_documents(spark, library):
    docs = messy.documents(spark)
    coded = bpe.encode_documents(docs, queries.vocabulary_path())
    added = ["n_tokens", "ids", "decoded"]
    assert coded.columns == [*(c for c in docs.columns if c not in added), *added]
    for row in coded.collect():
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert ids(row["ids"]) == expected and row["n_tokens"] == len(expected)
        assert row["decoded"] == (row["text"] or "")
    again = bpe.decode_documents(coded.drop("decoded"), queries.vocabulary_path(), [F.col("text")])
    assert all(r["decoded"] == (r["text"] or "") for r in again.collect())
    none = bpe.encode_documents(messy.no_documents(spark), queries.vocabulary_path(), [F.col("doc_id")])
    assert none.columns == ["doc_id", "n_tokens", "ids", "decoded"] and none.count() == 0
