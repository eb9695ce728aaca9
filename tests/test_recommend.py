from datetime import date
from decimal import Decimal

import pytest

from cartrail.plans import recommend, text_report, wording
from tests.shop import build, skewed


def lines(df):
    return [row.line for row in df.orderBy(*recommend.READING_ORDER).collect()]


@pytest.fixture(scope="module")
def star(spark):
    return build(spark)


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([("bad", -0.7), ("good", 0.5)], "word string, polarity double")


def test_lines_of_a_star_ignoring_case(star, lexicon):
    loose = star.ignoring_case()
    for report in (recommend.strategic, recommend.business, recommend.text_report_lines, recommend.findings, text_report.text_report):
        assert lines(report(loose)) == lines(report(star)), report.__name__
    assert lines(recommend.experience_lines(loose, lexicon)) == lines(recommend.experience_lines(star, lexicon))


def test_strategic(star):
    assert lines(recommend.strategic(star)) == [
        "Focus marketing on top converting products: Kayak, Drum.",
        "Prioritize None content, as it shows the highest engagement conversion.",
        "Target customers in the age group 30-45, who demonstrate the highest conversion rate.",
        "Address negative reviews for products: Drum.",
        "Address negative reviews for products: Kayak.",
        wording.CHECKOUT,
    ]


def test_strategic_leaves_out_empty_parts(spark):
    empty = build(spark, journeys=[], reviews=[], engagement=[])
    assert lines(recommend.strategic(empty)) == [wording.CHECKOUT]


def test_a_line_for_each_disliked_product(spark):
    names = [f"Item {i:05d}" for i in range(5000)]
    products = [(i, name, "toys", Decimal("1.00")) for i, name in enumerate(names)]
    reviews = [(i, 1, i, date(2024, 1, 1), 1, "bad") for i in range(5000)]
    found = recommend.strategic(build(spark, products=products, reviews=reviews)).where("section = 4")
    assert lines(found) == [f"Address negative reviews for products: {name}." for name in names]


def test_marketing(star):
    assert lines(recommend.marketing_lines(star)) == [
        "Consider improving or marketing Lamp (Rating: None, Sales: 0).",
        "Consider improving or marketing Drum (Rating: 1.0000, Sales: 0).",
        "Consider improving or marketing Kayak (Rating: 3.4286, Sales: 7).",
        "Boost marketing in BLOG campaigns (Avg Views: 125.0000, Avg Clicks: 12.5000, Purchases: 4).",
        "Boost marketing in None campaigns (Avg Views: 500.0000, Avg Clicks: 50.0000, Purchases: 3).",
        "Boost marketing in VIDEO campaigns (Avg Views: 350.0000, Avg Clicks: 0.0000, Purchases: 0).",
    ]


def test_experience(star, lexicon):
    assert lines(recommend.experience_lines(star, lexicon, k=2)) == [
        wording.DISSATISFIED,
        wording.LOWEST_HEADER,
        "- Drum (Product ID: 12): Avg Rating 1.00 (Reviews: 1)",
        "- Kayak (Product ID: 11): Avg Rating 3.00 (Reviews: 1)",
        "2 customers made only one purchase. Consider implementing loyalty rewards "
        "or personalized follow-ups to increase retention.",
        wording.COMPLAINT_HEADER,
        "- bad bad drum (Product: Drum | Mentioned 1 times)",
        "- bad boat (Product: Kayak | Mentioned 1 times)",
    ]


def test_experience_of_nothing(spark, lexicon):
    assert lines(recommend.experience_lines(build(spark, journeys=[], reviews=[]), lexicon)) == []


def test_business_with_fallback(star):
    assert lines(recommend.business(star)) == [
        "Promote **Kayak** as the flagship product (Conversion rate: 66.67%).",
        "Focus marketing on **30-45 Males** in **Austria** (Conversion rate: 200.0%).",
        "Prioritize **Kayak** in **Austria** (Sales: 3 units).",
        "Increase budget for **BLOG** campaigns (Conversion rate: 5.71%).",
        wording.NO_DISCOUNT,
    ]


def test_business_with_a_discount_candidate(spark):
    reviews = [(i, 1, 13, None, 1 + i % 2, "t") for i in range(7)]
    assert lines(recommend.business(build(spark, reviews=reviews)))[-1] == "Introduce discounts for **Lamp** (Rating: 1.4286/5, Reviews: 7)."


def test_findings(star):
    assert lines(recommend.findings(star, k=2)) == [
        "Customer Journey Drop-off Points:",
        "checkout: 1 drop-offs",
        "",
        "Highest Rated Products:",
        "Product ID 10: Average Rating 3.5000",
        "Product ID 11: Average Rating 3.0000",
    ]


def test_text_report_reads_in_order(star):
    found = lines(text_report.text_report(star))
    chapters = [line for line in found if line[:2] in ("1.", "2.", "3.", "4.", "5.")]
    assert chapters == [
        "1. Customer Trends",
        "2. Segment Performance",
        "3. Key Purchase Drivers",
        "4. Customer Sentiment Analysis",
        "5. Strategic Recommendations",
    ]
    assert found.index("Top 5 Products by Engagement:") + 2 == found.index("               Kayak                    6")
    assert found[-1] == "- Address negative reviews for: Drum, Kayak"
    assert len(found) == len(lines(text_report.text_report(star)))


def test_text_report_of_skewed_rows(spark):
    assert lines(text_report.text_report(skewed(spark)))
