"""Toxicity: the automaton against edit distances, contexts, learning, and held-out accuracy."""

import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cartrail.llm import queries, toxicity
from tests.llm import messy

SF_DIR = "/root/testdata/sf0.01"


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        ahead = [i]
        for j, d in enumerate(b, 1):
            ahead.append(min(row[j] + 1, ahead[-1] + 1, row[j - 1] + (c != d)))
        row = ahead
    return row[-1]


def test_automaton_is_edit_distance():
    pick = random.Random(2)
    terms = ["abba", "babab", "bacab", "abcabcabc", "ccaabbccaabb"]
    machine = toxicity.LexiconAutomaton([(t, False) for t in terms] + [("cab", True)])
    for _ in range(6000):
        base = pick.choice(terms)
        token = list(base)
        for _ in range(pick.randint(0, 3)):
            at = pick.randrange(len(token) + 1)
            token[at : at + pick.randint(0, 1)] = pick.choice([[], ["a"], ["c"], ["ß"]])
        token = "".join(token)
        near = [distance(token, t) for t in terms if distance(token, t) <= toxicity.edits_allowed(t, False)]
        near += [0] if token.startswith("cab") else []
        assert machine.match(token) == min(near, default=None), token
    assert toxicity.LexiconAutomaton([]).match("abc") is None


def test_misspelled_short_terms_and_stems():
    pick = random.Random(3)
    terms = [("scum", False), ("oaf", False), ("grumb", True), ("zworka", True), ("blo", True)]
    machine = toxicity.LexiconAutomaton(terms)
    for _ in range(6000):
        token = list(pick.choice(terms)[0] + pick.choice(["", "", "a", "mle"]))
        for _ in range(pick.randint(0, 2)):
            at = pick.randrange(len(token) + 1)
            token[at : at + pick.randint(0, 1)] = pick.choice([[], ["a"], ["m"]])
        token = "".join(token)
        near = []
        for term, stem in terms:
            beginnings = [token[:i] for i in range(len(token) + 1)] if stem else [token]
            fewest = min(distance(b, term) for b in beginnings)
            near += [fewest] if fewest <= toxicity.edits_allowed(term, stem) else []
        assert machine.match(token) == min(near, default=None), token
    assert machine.match("scm") == machine.match("gumble") == 1 and machine.match("of") is machine.match("bo") is None
    # a fifth of the documents hold variants that share three letters, so a stem takes the word's place
    counts = {"clown$": (80, 0), "clown": (80, 0), "clow": (80, 0), "clo": (100, 0)}
    terms = toxicity.choose_terms(counts, 100, 400)
    covered = toxicity.covered_words(counts, terms, 100, 400)
    assert terms == [("clo", True)] and covered == ["clown"]
    model = toxicity.Model(tuple(terms), covered=tuple(covered))
    assert toxicity.count_hits(model, "cloak clown c1own lown") == {"exact": 2, "fuzzy": 2, "quoted": 0, "directed": 0}
    assert toxicity.misspelled_worth((9, 0), (0, 0), 100, 400) == pytest.approx(toxicity.worth(9, 0, 100, 400))
    assert toxicity.misspelled_worth((9, 0), (1, 30), 100, 400) == 0


def test_few_states_find_the_same(monkeypatch):
    pick = random.Random(9)
    terms = [("abba", False), ("babab", False), ("abcabcabc", False), ("cab", True)]
    tokens = ["".join(pick.choice("abcd") for _ in range(pick.randint(1, 12))) for _ in range(3000)]
    whole = [toxicity.LexiconAutomaton(terms).meet(t) for t in tokens]
    monkeypatch.setattr(toxicity, "STATES", 5)
    machine = toxicity.LexiconAutomaton(terms)
    assert [machine.meet(t) for t in tokens] == whole
    assert len(machine.sets) < 30


def test_a_worker_makes_one_automaton_for_a_model():
    first, second = (toxicity.Model((("clown", False),), worths=(1.0,)) for _ in range(2))
    assert first.automaton is second.automaton
    assert toxicity.Model((("oaf", False),)).automaton is not first.automaton


def test_all_keys_count_however_long(spark):
    long = "longword" * 9
    assert toxicity.term_keys(f"{long} ab") >= {long + "$", "longwo"}
    rows = [(i, f"plain text number {i} " + (f"{long} " * (i % 2))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int"))
    assert any(long.startswith(term) for term, _ in model.terms)


def test_contexts():
    model = toxicity.Model((("clown", False), ("disgusting", False)), frozenset({"crown"}), (-3, 4, 3, 0, 1))

    def found(text):
        return toxicity.count_hits(model, text)

    assert found("you CLOWN, what a cl0wn") == {"exact": 1, "fuzzy": 1, "quoted": 0, "directed": 2}
    assert found("a crown is no hit, dsgustin is one") == {"exact": 0, "fuzzy": 1, "quoted": 0, "directed": 0}
    assert found('the word "clown" is short') == {"exact": 0, "fuzzy": 0, "quoted": 1, "directed": 0}
    assert found("he said clown twice") == {"exact": 0, "fuzzy": 0, "quoted": 1, "directed": 0}
    assert found('a "joke" ended, then clown') == {"exact": 1, "fuzzy": 0, "quoted": 0, "directed": 0}
    assert set(found("").values()) == set(found(None).values()) == {0}
    assert len(toxicity.features(model, "clown " * 50_000)) == 4


def test_learning_finds_words_and_stems(spark):
    pick = random.Random(4)
    filler = [a + b + c for a in ("ta", "re", "mo", "li") for b in ("no", "ve", "si") for c in ("ra", "ko", "du", "pe")]
    rows, labels = [], []
    for i in range(500):
        words = [pick.choice(filler) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[5] = "grumble"
            words[20] = "zwork" + pick.choice(filler)[:3]
        rows.append((i, " ".join(words)))
        labels += [(i, int(toxic))] * (1 + (i % 7 == 0))
    labels += [(None, 1), (3, None)]
    docs = spark.createDataFrame([*rows, (5, "other text of an id"), (None, None)], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, known, rows=400)
    assert set(model.terms) == {("grumble", False), ("zwork", True)}
    asked = spark.createDataFrame([(1, "tanora grumble zworkdu"), (2, "tanora grumbel gruble"), (3, "tanora"), (4, None), (5, "")], "doc_id long, text string")
    scored = dict(toxicity.score(asked, model, [F.col("doc_id")]).collect())
    assert scored[1] > 0.7 > scored[3] and scored[2] > scored[3] == scored[4] == scored[5]
    assert toxicity.learn(docs, known.limit(0)).terms == ()
    assert toxicity.learn(docs.limit(0), known).terms == ()


def test_only_near_copies_leave_the_training_documents(spark):
    pick = random.Random(8)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = [f"{passage} {' '.join(f'own{pick.randrange(10**6)}' for _ in range(60))}" for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts[:5])] + [(200, ""), (201, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 % 2 == 0)) for i, _ in rows], "doc_id long, toxic int")
    kept = [r["doc_id"] for r in toxicity.training_documents(docs, labels, 1000, "doc_id", "text").collect()]
    assert sorted(kept) == [*range(60), 200, 201]


def test_terms_of_a_small_group():
    # 1,000 toxic documents, 10 of them in a language of their own; 50,000 keys, a few of them there by chance
    counts = {"grumble$": (900, 3), "gruñón$": (10, 0), "casual$": (4, 0), "common$": (500, 2500)}
    assert toxicity.choose_terms(counts, 1000, 5000, 50_000) == [("gruñón", False), ("grumble", False)]
    assert 0 < toxicity.worth(4, 0, 1000, 5000) < toxicity.worth(10, 0, 1000, 5000) < toxicity.worth(90, 0, 1000, 5000)
    assert toxicity.worth(10, 500, 1000, 5000) == 0
    assert toxicity.least_surprise([30.0, 20.0, 3.0], 1000) == 20.0 and toxicity.least_surprise([3.0], 1000) > 1000
    model = toxicity.Model((("clown", False), ("clo", True), ("oaf", False)), worths=(1.0, 0.25, 0.5))
    assert [round(toxicity.features(model, t)[0], 6) for t in ("clown", "cloud", "oaf", "clwn")] == [0.693147, 0.223144, 0.405465, 0.587787]


def test_messy_documents(spark):
    model = toxicity.Model((("alpha", False),))
    docs = messy.documents(spark)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.where("text is null or text = ''").count() == docs.where("text is null or text = ''").count()
    assert kept.where("text like '%alpha alpha%'").count() == 0
    assert toxicity.drop_toxic(messy.no_documents(spark), model).count() == 0


def test_held_out_ids(spark):
    found = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in found)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op4_toxicity(spark, SF_DIR).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    above = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert above > 0.85
    assert sum(s >= 0.7 for s in clean) <= 0.02 * len(clean)
