import random

import pytest

from cartrail.plans import text
from tests.shop import build, ordered, rows, skewed

WORDS = [("good", 0.5), ("bad", -0.7), ("Boat", 0.1)]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(WORDS, "word string, polarity double")


def expected_score(words):
    known = {word.lower(): polarity for word, polarity in WORDS}
    hits = [known[word] for word in words.lower().split() if word in known] if words else []
    return round(sum(hits) / len(hits), 9) if hits else 0.0


def test_mean_over_every_occurrence(spark, lexicon):
    scored = {r.ReviewID: round(r.SentimentScore, 9) for r in text.text_polarity(build(spark).reviews, lexicon).collect()}
    assert scored == {1: round(1.1 / 3, 9), 2: -0.3, 3: 0.1, 4: -0.7}


def test_texts_without_a_known_word_are_neutral(spark, lexicon):
    reviews = spark.createDataFrame([(1, "nothing here"), (2, ""), (3, None), (4, "!!")], "ReviewID bigint, ReviewText string")
    assert rows(text.text_sentiment(reviews, lexicon)) == [(i, 0.0, "Neutral") for i in range(1, 5)]


def test_words_end_at_punctuation_and_ignore_case(spark, lexicon):
    reviews = spark.createDataFrame([(1, "GOOD,bad;goodness (Good)")], "ReviewID bigint, ReviewText string")
    assert round(text.text_polarity(reviews, lexicon).first().SentimentScore, 9) == 0.1


def test_a_row_per_review_even_where_ids_repeat(spark, lexicon):
    reviews = skewed(spark).reviews
    found = rows(text.text_polarity(reviews, lexicon).selectExpr("ReviewID", "round(SentimentScore, 9)"))
    expected = sorted((r.ReviewID, expected_score(r.ReviewText)) for r in reviews.collect())
    assert sorted(found) == expected
    with_text = text.scored_reviews(reviews, lexicon).collect()
    assert len(with_text) == reviews.count()
    assert all(round(r.Sentiment, 9) == expected_score(r.ReviewText) for r in with_text)


def test_whole_long_text_counts(spark, lexicon):
    reviews = spark.createDataFrame([(1, "filler " * 50000 + "bad")], "ReviewID bigint, ReviewText string")
    assert text.text_polarity(reviews, lexicon).first().SentimentScore == -0.7


def test_gate(spark, lexicon):
    reviews = build(spark).reviews
    assert ordered(text.negative_polarity_gate(reviews, lexicon)) == [(2, -0.5, True)]
    assert ordered(text.negative_polarity_gate(reviews, lexicon, threshold=-0.5)) == [(2, -0.5, False)]
    assert ordered(text.negative_polarity_gate(reviews, lexicon, max_rating=0)) == [(0, None, False)]


def test_large_lexicon_is_joined_by_shuffle(spark, lexicon, conf):
    reviews = build(spark).reviews
    expected = rows(text.text_polarity(reviews, lexicon))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__skewJoin__enabled="false")
    assert rows(text.text_polarity(reviews, lexicon)) == expected


def test_rows_without_an_id_and_repeated_rows_are_kept(spark, lexicon):
    reviews = spark.createDataFrame([(None, "good"), (None, "bad"), (1, "good"), (1, "good"), (None, None)], "ReviewID bigint, ReviewText string")
    found = sorted(((r.ReviewID, r.ReviewText, r.Sentiment) for r in text.scored_reviews(reviews, lexicon).collect()), key=str)
    expected = [(1, "good", 0.5), (1, "good", 0.5), (None, None, 0.0), (None, "bad", -0.7), (None, "good", 0.5)]
    assert found == sorted(expected, key=str)


def test_words_of_any_script_and_with_apostrophes(spark):
    known = spark.createDataFrame([("café", 0.5), ("don't", -0.5), ("l’été", 0.25)], "word string, polarity double")
    reviews = spark.createDataFrame([(1, "CAFÉ!"), (2, "I don't"), (3, "l’été,"), (4, "caf don t")], "ReviewID bigint, ReviewText string")
    assert {r.ReviewID: r.SentimentScore for r in text.text_polarity(reviews, known).collect()} == {1: 0.5, 2: -0.5, 3: 0.25, 4: 0.0}


def test_scored_reviews_read_and_move_a_text_once(spark, lexicon, tmp_path):
    build(spark).reviews.write.parquet(str(tmp_path / "r"))
    plan = text.scored_reviews(spark.read.parquet(str(tmp_path / "r")), lexicon)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


MODIFIED = [
    ("good", "polarity", 0.5), ("bad", "polarity", -0.7), ("great", "polarity", 0.9), ("very", "intensifier", 1.3), ("slightly", "intensifier", 0.5),
    ("not", "negation", -0.5), ("never", "negation", -0.8), ("no good", "polarity", -0.6), ("no", "negation", -0.5),
    ("not only", "intensifier", 1.2), ("no good at all", "polarity", -0.95), ("Très  Bien", "polarity", 0.8), ("-", "polarity", 1.0),
]


@pytest.fixture(scope="module")
def modified(spark):
    return spark.createDataFrame(MODIFIED, "word string, kind string, polarity double")


def fold(words):
    """The rules of the module's docstring, over the words of one sentence."""
    known = {word.lower().replace("  ", " "): (kind, value) for word, kind, value in MODIFIED}
    found, i, turn, turns_to, boost, boosts_at = [], 0, 1.0, -1, 1.0, -1
    while i < len(words):
        size = next((n for n in (4, 3, 2, 1) if i + n <= len(words) and " ".join(words[i : i + n]) in known), 0)
        if not size:
            i += 1
            continue
        kind, value = known[" ".join(words[i : i + size])]
        if kind == "intensifier":
            boost, boosts_at = (value * boost if boosts_at == i else value), i + size
        elif kind == "negation":
            turn, turns_to = (value * turn if i <= turns_to else value), i + size + 2
        else:
            value *= boost if boosts_at == i else 1
            value *= turn if i <= turns_to else 1
            found.append(max(-1.0, min(1.0, value)))
            turns_to = boosts_at = -1
        i += size
    return found


CASES = {
    "good": 0.5, "not good": -0.25, "very good": 0.65, "not very good": -0.325, "very very good": 0.845, "very great": 1.0,
    "not a good": -0.25, "not one two good": -0.25, "not one two three good": 0.5, "not. good": 0.5, "Not good, good!": 0.125,
    "no good": -0.6, "no good at": -0.6, "no good at all": -0.95, "not only good": 0.6, "never not good": 0.2, "not never bad": -0.28,
    "slightly, bad": -0.35, "slightly so bad": -0.7, "TRÈS BIEN": 0.8, "très. bien": 0.0, "very": 0.0, "": 0.0, "not no good": 0.3,
    "very not good": -0.25, "good bad": -0.1,
}


def test_order_of_words_counts(spark, modified):
    texts = list(CASES)
    reviews = spark.createDataFrame(list(enumerate(texts)), "ReviewID bigint, ReviewText string")
    found = {texts[r.ReviewID]: round(r.SentimentScore, 4) for r in text.text_polarity(reviews, modified).collect()}
    assert found == CASES


def test_random_texts_against_a_plain_fold(spark, modified):
    pick = random.Random(11)
    vocabulary = "good bad great very slightly not never no only at all thing très bien".split()
    held = []
    for i in range(300):
        sentences = [[pick.choice(vocabulary) for _ in range(pick.randint(0, 12))] for _ in range(pick.randint(1, 4))]
        weights = [w for sentence in sentences for w in fold(sentence)]
        held.append((i, ". ".join(map(" ".join, sentences)), sum(weights) / len(weights) if weights else 0.0))
    reviews = spark.createDataFrame([h[:2] for h in held], "ReviewID bigint, ReviewText string")
    found = {r.ReviewID: r.SentimentScore for r in text.text_polarity(reviews, modified).collect()}
    assert all(abs(found[i] - score) < 2e-3 for i, _, score in held)  # weights are rounded to ten-thousandths


def test_a_large_lexicon_is_joined_and_scores_alike(spark, modified, monkeypatch):
    pick = random.Random(5)
    held = [(pick.randint(0, 90), ". ".join(pick.choice(list(CASES)) for _ in range(pick.randint(0, 6)))) for _ in range(400)]
    reviews = spark.createDataFrame(held, "ReviewID bigint, ReviewText string")
    inline = rows(text.text_polarity(reviews, modified))
    assert "Exchange" not in text.text_polarity(reviews, modified)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(text, "INLINE", 3)
    assert rows(text.text_polarity(reviews, modified)) == inline


@pytest.mark.parametrize("inline", [3, 100])
def test_modified_scores_keep_every_row(spark, modified, conf, monkeypatch, inline):
    monkeypatch.setattr(text, "INLINE", inline)
    held = [(None, "not good")] * 3 + [(1, "not good"), (1, "not good"), (1, None), (2, ""), (3, "filler. " * 20000 + "not bad")]
    reviews = spark.createDataFrame([(i, 4, t) for i, t in held], "ReviewID bigint, Rating int, ReviewText string")
    expected = sorted(((i, t, 0.35 if t and "bad" in t else -0.25 if t else 0.0) for i, t in held), key=str)
    for threshold in ("10m", "-1"):
        conf(spark__sql__autoBroadcastJoinThreshold=threshold)
        found = [(r.ReviewID, r.ReviewText, round(r.Sentiment, 9)) for r in text.scored_reviews(reviews, modified).collect()]
        assert sorted(found, key=str) == expected
    assert ordered(text.negative_polarity_gate(reviews, modified, max_rating=4))[0][:1] == (8,)
    assert text.text_polarity(reviews, modified.limit(0)).selectExpr("max(abs(SentimentScore))").first()[0] == 0.0


def test_equal_rows_meet_as_one_set(spark, modified, monkeypatch):
    """A hot text brings its places once to the task that folds it: what is collected is a set, summed in every task."""
    monkeypatch.setattr(text, "INLINE", 0)
    reviews = spark.range(100).selectExpr("CAST(NULL AS bigint) AS ReviewID", "'not good' AS ReviewText")
    plan = text.text_polarity(reviews, modified)._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan
    assert [(r.SentimentScore) for r in text.text_polarity(reviews, modified).collect()] == [-0.25] * 100
