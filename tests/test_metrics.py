import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from cartrail.functions import metrics


def _value(spark, column, **values):
    df = spark.range(1)
    for name, (value, kind) in values.items():
        df = df.withColumn(name, F.lit(value).cast(kind))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [(1, 8, 12.5), (1, 200, 0.5), (1, 3, 33.33), (2, 3, 66.67), (1, 800, 0.13), (3, 800, 0.38), (0, 5, 0.0), (7, 0, None)],
)
def test_pct_rounds_half_up_and_survives_zero(spark, part, whole, expected):
    assert _value(spark, metrics.pct("p", "n"), p=(part, "bigint"), n=(whole, "bigint")) == expected


def test_pct_beyond_bigint(spark):
    value = _value(spark, metrics.pct("p", "n"), p=(Decimal(10) ** 23, "decimal(38,0)"), n=(Decimal(10) ** 24, "decimal(38,0)"))
    assert value == 10.0


@pytest.mark.parametrize(("total", "count", "digits", "expected"), [(8, 3, 4, 2.6667), (-8, 3, 4, -2.6667), (5, 2, 0, 3.0), (-5, 2, 0, -3.0)])
def test_rounded_ratio(spark, total, count, digits, expected):
    assert _value(spark, metrics.rounded_ratio("s", "n", digits), s=(total, "bigint"), n=(count, "bigint")) == expected


def test_rounded_ratio_equals_decimal_rounding(spark):
    pick = random.Random(5)
    pairs = [(pick.randint(-(10**6), 10**6), pick.choice([8, 16, 32, 160, 625, pick.randint(1, 10**5)])) for _ in range(500)]
    df = spark.createDataFrame(pairs, "s bigint, n bigint")
    for digits in (1, 2, 4):
        found = [row.v for row in df.select(metrics.rounded_ratio("s", "n", digits).alias("v")).collect()]
        step = Decimal(1).scaleb(-digits)
        with localcontext(prec=60):
            expected = [float((Decimal(s) / n).quantize(step, ROUND_HALF_UP)) for s, n in pairs]
        assert found == expected


@pytest.mark.parametrize(
    ("age", "text", "group"),
    [(29, "<30", "18-29"), (30, "30-45", "30-45"), (45, "30-45", "30-45"), (46, ">45", "46+"), (None, ">45", "46+")],
)
def test_age_bands(spark, age, text, group):
    assert _value(spark, metrics.age_band("a"), a=(age, "int")) == text
    assert _value(spark, metrics.age_band("a", metrics.AGE_GROUPS), a=(age, "int")) == group


@pytest.mark.parametrize(
    ("rating", "number", "label"),
    [(5, 1, "Positive"), (4, 1, "Positive"), (3, 0, "Neutral"), (2, -1, "Negative"), (1, -1, "Negative"), (None, -1, "Positive")],
)
def test_rating_sentiment(spark, rating, number, label):
    assert _value(spark, metrics.rating_sentiment("r"), r=(rating, "int")) == number
    assert _value(spark, metrics.rating_sentiment_label("r"), r=(rating, "int")) == label


@pytest.mark.parametrize(("score", "label"), [(0.1, "Positive"), (0.0, "Neutral"), (-0.1, "Negative")])
def test_score_label(spark, score, label):
    assert _value(spark, metrics.score_label("s"), s=(score, "double")) == label


def test_predicates_on_raw_and_cleaned_text(spark):
    df = spark.createDataFrame([("Checkout", "PURCHASE"), ("checkout", "purchase")], "Stage string, Action string")
    assert df.where(metrics.is_checkout_purchase()).count() == 1


def test_missing_action_is_no_purchase(spark):
    df = spark.createDataFrame([(None,), ("purchase",)], "Action string")
    assert df.agg(F.count_if(metrics.is_purchase())).first()[0] == 1
