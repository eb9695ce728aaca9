"""Lexicon polarity of review texts, as a join of words to a ``(word, polarity)`` table.

A lexicon with a third column ``kind`` also holds phrases and modifiers, and the order of the words counts:

- ``word`` may be a phrase; of the entries that begin at a word the longest counts, and its words count for no other;
- kind ``polarity`` is a word or phrase with a polarity from -1 to 1;
- kind ``intensifier`` multiplies, by the factor in ``polarity``, the entry that follows at once;
- kind ``negation`` multiplies, by its factor, the next polarity that begins within ``REACH`` words after it.

A lexicon of up to ``INLINE`` entries becomes a hash table in the plan, and a text is scored where it lies; a larger
one is joined. Modifiers in a row multiply each other, no weight leaves -1 to 1, and nothing reaches over the end of a sentence.
A lexicon without ``kind`` has polarities of single words only, whose order doesn't matter. Of equal entries the
one of the last kind in alphabetical order counts, and of these the largest.
"""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.functions.metrics import score_label
from cartrail.operators.joins import lookup_join

#: letters of any script, with apostrophes between them
WORD = r"\p{L}+(?:['’]\p{L}+)*"
#: how many words after a negation the polarity may begin that it turns
REACH = 3
#: entries of a lexicon that are sent along with the plan
INLINE = 20_000
POLARITY, INTENSIFIER, NEGATION = "polarity", "intensifier", "negation"
_SENTENCE = 1 << 32  # places of words in different sentences are so far apart
_PARTS = 10_000  # polarities are summed in whole ten-thousandths, which makes the sum independent of order
_DIGITS = 9  # decimal places of a score where scores are summed, for the same reason


def _scores(reviews: DataFrame, lexicon: DataFrame, *keep: str, whole_text: bool = False) -> DataFrame:
    """Score and number of rows per review id, text and ``keep``; with ``whole_text`` the text as well.

    The whole text is split and its words are looked up by an inner join, so all other words are gone before
    anything is grouped. An empty word is put behind every text and into the lexicon: it keeps texts without
    any match, counts the rows that are equal in all that is kept, and is the one that carries the text where
    it is wanted. The reviews are read once, a text moves at most once, and each task has reduced a review to
    one row before that. A missing id is kept like any other.
    """
    plain = F.collate("ReviewText", "UTF8_BINARY")
    words = F.array_append(F.coalesce(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)), F.array()), F.lit(""))
    text_key = F.xxhash64("ReviewText").alias("_text")
    carried = ["ReviewText"] if whole_text else []
    split = reviews.select("ReviewID", *keep, *carried, text_key, words.alias("words"))
    # the outer form, as the plain one would split every text a second time to filter out empty arrays
    spelled = split.select("ReviewID", *keep, *carried, "_text", F.explode_outer("words").alias("word"))
    if whole_text:
        spelled = spelled.withColumn("ReviewText", F.when(F.col("word") == "", F.col("ReviewText")))
    weight = F.round(F.col("polarity") * _PARTS).cast("bigint").alias("weight")
    weights = lexicon.select(F.lower(F.collate("word", "UTF8_BINARY")).alias("word"), weight)
    marker = lexicon.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(None).cast("bigint").alias("weight"))
    known = weights.where(F.col("word") != "").unionByName(marker)
    found = lookup_join(spelled.withColumn("word", F.lower("word")), known, "word", spread_by=["ReviewID", "_text"])
    totals = found.groupBy("ReviewID", "_text", *keep).agg(
        F.sum("weight").alias("weight"),
        F.count("weight").alias("hits"),
        F.count_if(F.col("word") == "").alias("rows"),
        *[F.max(name).alias(name) for name in carried],
    )
    mean = F.col("weight").cast("double") / (F.col("hits") * _PARTS).cast("double")
    score = F.when(F.col("hits") > 0, mean).otherwise(F.lit(0.0))
    return totals.select("ReviewID", *keep, *carried, "rows", score.alias("SentimentScore"))


def _entries(lexicon: DataFrame) -> DataFrame:
    """``(first, size, phrase, kind, weight)`` of every entry with words: its words in lower case, single blanks between."""
    found = F.regexp_extract_all(F.lower(F.collate("word", "UTF8_BINARY")), F.lit(WORD), F.lit(0))
    split = lexicon.select(found.alias("words"), "kind", F.round(F.col("polarity") * _PARTS).cast("bigint").alias("weight"))
    phrase = F.array_join("words", " ").alias("phrase")
    return split.where(F.size("words") > 0).select(F.get("words", F.lit(0)).alias("first"), F.size("words").alias("size"), phrase, "kind", "weight")


def _sentences(text: str) -> Column:
    """The words of each sentence in lower case."""
    sentences = F.split(F.lower(F.collate(text, "UTF8_BINARY")), "[.!?]+")
    return F.transform(sentences, lambda sentence: F.regexp_extract_all(sentence, F.lit(WORD), F.lit(0)))


def _places(text: str, longest: int) -> Column:
    """For every word of a text: its place, the word, and the words that a phrase there may have."""

    def placed(held: Column, number: Column) -> Column:
        return F.transform(
            held,
            lambda word, i: F.struct(
                (number.cast("bigint") * _SENTENCE + i).alias("at"),
                word.alias("first"),
                F.array_join(F.slice(held, i + 1, longest), " ").alias("ahead"),
            ),
        )

    return F.flatten(F.transform(_sentences(text), placed))


def _folded(hits: str) -> Column:
    """The mean weight, 0 without any, from the hits ``(at, size, kind, weight)`` of a text, in order.

    The state: the place behind the last entry, the sums, the factor of the negations with the last place they
    reach, and the factor of the intensifiers with the place behind them.
    """

    def state(turn: str, turns_to: str, boost: str, boosts_at: str, total: str = "s.total", n: str = "s.n", free: str = "hit.at + hit.size") -> str:
        fields = {"free": free, "total": total, "n": n, "turn": turn, "turns_to": turns_to, "boost": boost, "boosts_at": boosts_at}
        return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"

    def times(weight: str, factor: str) -> str:
        return f"cast(round({weight} * {factor} / {_PARTS}D) AS bigint)"

    boosted = f"if(s.boosts_at = hit.at, {times('hit.weight', 's.boost')}, hit.weight)"
    turned = "if(hit.at <= s.turns_to, {}, {})"
    weight = turned.format(times(boosted, "s.turn"), boosted)
    total = f"s.total + greatest(-{_PARTS}L, least({_PARTS}L, {weight}))"
    again = turned.format(times("hit.weight", "s.turn"), "hit.weight")
    none = ("1L", "-1L", "1L", "-1L")
    return F.expr(
        f"""aggregate({hits}, {state(*none, total="0L", n="0L", free="-1L")}, (s, hit) -> CASE
        WHEN hit.at < s.free THEN s
        WHEN hit.kind = '{INTENSIFIER}' THEN {state("s.turn", "s.turns_to", boosted, "hit.at + hit.size")}
        WHEN hit.kind = '{NEGATION}' THEN {state(again, f"hit.at + hit.size + {REACH - 1}L", "s.boost", "s.boosts_at")}
        ELSE {state(*none, total=total, n="s.n + 1")} END,
        s -> if(s.n > 0, cast(s.total AS double) / cast(s.n * {_PARTS} AS double), 0D))"""
    )


def _inline_scores(reviews: DataFrame, entries: DataFrame, count: int, *keep: str, whole_text: bool = False) -> DataFrame:
    """As ``_scores``, each text by itself: its words are looked up in a table that is part of the plan."""
    buckets = 1 << (2 * count).bit_length()
    option = F.struct("size", "phrase", "kind", "weight", "first")
    keyed = entries.groupBy(F.pmod(F.xxhash64("first"), F.lit(buckets)).cast("int").alias("bucket"))
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for row in keyed.agg(F.sort_array(F.collect_set(option), asc=False).alias("options")).collect():
        table[row["bucket"]] = [o.asDict() for o in row["options"]]
    kind = "array<array<struct<size:int,phrase:string,kind:string,weight:bigint,first:string>>>"
    held = F.from_json(F.lit(json.dumps(table)), kind)
    phrase = "array_join(slice(words, i + 1, o.size), ' ')"
    fits = f"o -> o.first = word AND (o.size = 1 OR {phrase} = o.phrase)"
    options = f"get(held, cast(pmod(xxhash64(word), {buckets}) AS int))"
    hit = "o -> named_struct('at', number * {0}L + i, 'size', o.size, 'kind', o.kind, 'weight', o.weight)".format(_SENTENCE)
    # the first option that fits is the longest
    found = f"transform(words, (word, i) -> slice(transform(filter({options}, {fits}), {hit}), 1, 1))"
    each = f"flatten(flatten(transform(sentences, (words, number) -> {found})))"
    columns = [*keep, *(["ReviewText"] if whole_text else [])]
    split = reviews.select("ReviewID", *columns, _sentences("ReviewText").alias("sentences"), held.alias("held"))
    hits = split.select("ReviewID", *columns, F.expr(each).alias("hits"))
    score = F.coalesce(_folded("hits"), F.lit(0.0)).alias("SentimentScore")
    return hits.select("ReviewID", *columns, F.lit(1).cast("bigint").alias("rows"), score)


def _ordered_scores(reviews: DataFrame, lexicon: DataFrame, *keep: str, whole_text: bool = False) -> DataFrame:
    """As ``_scores``, for a lexicon with phrases and modifiers."""
    entries = _entries(lexicon)
    size = entries.agg(F.count(F.lit(1)).alias("entries"), F.max("size").alias("longest")).first()
    if size["entries"] <= INLINE:
        return _inline_scores(reviews, entries, size["entries"], *keep, whole_text=whole_text)
    return _joined_scores(reviews, entries, size["longest"], *keep, whole_text=whole_text)


def _joined_scores(reviews: DataFrame, entries: DataFrame, longest: int, *keep: str, whole_text: bool = False) -> DataFrame:
    """As ``_scores``, for a lexicon of any size with phrases and modifiers.

    Words go to the entries that begin with them, and only those that begin an entry travel on. What is found is
    collected as a set by id and text, so equal rows, however many, bring their places once.
    """
    option = F.struct("size", "phrase", "kind", "weight")
    known = entries.groupBy("first").agg(F.sort_array(F.collect_set(option), asc=False).alias("options"))
    options = reviews.sparkSession.range(1).select(F.lit("").alias("first"), F.lit(None).cast(known.schema["options"].dataType).alias("options"))
    marker = F.struct(F.lit(-1).cast("bigint").alias("at"), F.lit("").alias("first"), F.lit("").alias("ahead"))
    carried = ["ReviewText"] if whole_text else []
    places = F.array_append(F.coalesce(_places("ReviewText", longest), F.array()), marker)
    split = reviews.select("ReviewID", *keep, *carried, F.xxhash64("ReviewText").alias("_text"), places.alias("places"))
    spelled = split.select("ReviewID", *keep, *carried, "_text", F.explode_outer("places").alias("place"))
    spelled = spelled.select("ReviewID", *keep, *carried, "_text", "place.*")
    if whole_text:
        spelled = spelled.withColumn("ReviewText", F.when(F.col("first") == "", F.col("ReviewText")))
    found = lookup_join(spelled, known.unionByName(options), "first", spread_by=["ReviewID", "_text"])
    longest_first = F.expr("get(filter(options, o -> ahead = o.phrase OR startswith(ahead, concat(o.phrase, ' '))), 0)")
    met = found.withColumn("option", longest_first).where("first = '' OR option IS NOT NULL")
    hit = F.when(F.col("first") != "", F.struct("at", F.col("option.size"), F.col("option.kind"), F.col("option.weight")))
    totals = met.groupBy("ReviewID", "_text", *keep).agg(
        F.collect_set(hit).alias("hits"),
        F.count_if(F.col("first") == "").alias("rows"),
        *[F.max(name).alias(name) for name in carried],
    )
    score = _folded("array_sort(hits)").alias("SentimentScore")
    return totals.select("ReviewID", *keep, *carried, "rows", score)


def _scored(reviews: DataFrame, lexicon: DataFrame, *keep: str, whole_text: bool = False) -> DataFrame:
    scores = _ordered_scores if "kind" in lexicon.columns else _scores
    return scores(reviews, lexicon, *keep, whole_text=whole_text)


def _each_row(scores: DataFrame, score: str) -> DataFrame:
    """A row for each of the equal rows that were scored together."""
    columns = [c for c in scores.columns if c not in ("rows", "SentimentScore")]
    rows = F.explode(F.array_repeat("SentimentScore", F.col("rows").cast("int"))).alias(score)
    return scores.select(*columns, rows)


def text_polarity(reviews: DataFrame, lexicon: DataFrame, *keep: str) -> DataFrame:
    """``(ReviewID, *keep, SentimentScore)``, a row per review: mean polarity of its lexicon entries, 0 without any."""
    return _each_row(_scored(reviews, lexicon, *keep), "SentimentScore")


def text_sentiment(reviews: DataFrame, lexicon: DataFrame, *keep: str) -> DataFrame:
    """``text_polarity`` with the label of the score."""
    scored = text_polarity(reviews, lexicon, *keep)
    return scored.withColumn("SentimentCategory", score_label("SentimentScore"))


def scored_reviews(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Every review row with its score, text included, whatever its id."""
    keep = [c for c in reviews.columns if c not in ("ReviewID", "ReviewText")]
    scored = _each_row(_scored(reviews, lexicon, *keep, whole_text=True), "Sentiment")
    return scored.select(*reviews.columns, "Sentiment")


def negative_polarity_gate(
    reviews: DataFrame, lexicon: DataFrame, max_rating: int = 2, threshold: float = -0.2
) -> DataFrame:
    """One row: low-rated reviews, their mean polarity, and whether it is below ``threshold``.

    Scores are rounded to nine places and added up as whole numbers, so the sum doesn't depend on the order.
    """
    low = reviews.where(F.col("Rating") <= max_rating)
    billionths = F.round(F.col("SentimentScore") * 10**_DIGITS).cast("decimal(20,0)")
    total = _scored(low, lexicon).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("negative_reviews"),
        F.sum((billionths * F.col("rows")).cast("decimal(38,0)")).cast("decimal(38,0)").alias("score"),
    )
    mean = F.try_divide(F.col("score").cast("double"), F.col("negative_reviews") * float(10**_DIGITS))
    below = F.expr(f"score < {Decimal(str(threshold))}BD * {10**_DIGITS}BD * negative_reviews")
    return total.select(
        "negative_reviews",
        F.round(mean, 4).alias("avg_polarity"),
        F.coalesce(below, F.lit(False)).alias("dissatisfied"),
    )
