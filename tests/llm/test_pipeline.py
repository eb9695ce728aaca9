"""The pipeline's rows against the stages done plainly in Python."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartrail.llm import line_dedup, mixing, toxicity
from cartrail.llm.common import table, written
from tests.llm import messy
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"


def without_boilerplate(rows):
    pages = Counter(r["source"] for r in rows)
    on = Counter((r["source"], line) for r in rows for line in set((r["text"] or "").split("\n")) if line.strip(" \t\n\v\f\r"))
    bad = {key for key, n in on.items() if n >= 5 and n > line_dedup.RATIO * pages[key[0]]}
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [line for line in lines if (r["source"], line) not in bad]
        if len(left) < len(lines) and any(line.strip(" \t\n\v\f\r") for line in left):
            r = r | {"text": "\n".join(left), "n_chars": len("\n".join(left))}
        yield r


def one_of_each(rows):
    prints = {id(r): plain_fingerprint(r["text"]) for r in rows}
    roots = plain_components(set(prints.values()))
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(roots[prints[id(r)]], r)
    return list(first.values())


def mixed(rows):
    def size(r):
        return len(mixing_words(r["text"]))

    def key(r):
        content = hashlib.md5((r["text"] or "").encode()).hexdigest()
        return int(hashlib.md5(f"mix:{r['doc_id']}:{content}".encode()).hexdigest()[:13], 16)

    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(map(size, by_source[s])) for s in names}
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    targets, capped = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        pull = sum(weights[s] for s in names if s not in capped)
        targets = {s: 2 * sizes[s] if s in capped else left * weights[s] / pull for s in names}
        over = {s for s in names if s not in capped and targets[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in names:
        budget, before = int(targets[s]), 0
        for r in sorted(by_source[s], key=key):
            n = size(r)
            taken = (budget // sizes[s]) * n + max(0, min(budget % sizes[s] - before, n)) if n else 0
            before += n
            yield from [r] * (int(taken / n + 0.5) if n else 0)


def mixing_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_pipeline_rows(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from cartrail.llm.queries import vocabulary_path

    docs = table(spark, SF_DIR, "documents")
    labels = table(spark, SF_DIR, "labels")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    rows = [r.asDict() for r in docs.collect()]
    clean = [r for r in rows if toxicity.logistic(model.weights, [toxicity.features(model, r["text"])])[0] < toxicity.LIMIT]
    left = list(mixed(one_of_each(list(without_boilerplate(clean)))))
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    expected = []
    for r in left:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        expected.append((r["doc_id"], r["source"], r["lang"], len(ids), packed, hashlib.sha256(r["text"].encode()).hexdigest()))
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "source", "lang", "n_tokens", "ids", "decoded_sha256"]
    assert sorted((*tuple(r)[:4], bytes(r["ids"]), r["decoded_sha256"]) for r in found.collect()) == sorted(expected)


def test_stages_on_messy_and_empty_tables(spark, tmp_path):
    """Each stage's rows are written and read again for the next, as ``run`` does."""
    spark.createDataFrame([(0, 1, 0), (3, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (messy.documents(spark), messy.no_documents(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name == "bpe":
                out.collect()
            else:
                assert out.columns == columns
                docs = written(out)
