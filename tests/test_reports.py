"""Every report against the plain join over random data with hot and missing keys, and against hand-counted rows."""

from decimal import Decimal

import pytest

from cartrail.functions.metrics import is_checkout_purchase
from cartrail.operators import clean, membership, summaries
from cartrail.plans import customer, experience, marketing, product
from tests.shop import DAY1, JOURNEYS, PRODUCTS, build, ordered, rows, skewed

BUY = "Action = 'purchase'"
CHECKOUT_BUY = "Stage = 'checkout' AND Action = 'purchase'"
VIEWS = {
    "j": "journey",
    "r": "reviews",
    "c": "customers",
    "e": "engagement",
    "g": "geography",
    "p": "products",
}


def pct(part, whole):
    return f"CAST(round(CAST({part} AS DECIMAL(20,0)) * 100 / nullif({whole}, 0), 2) AS DOUBLE)"


def avg(column, digits=4):
    total = f"sum(CAST({column} AS DECIMAL(20,0)))"
    return f"CAST(round({total} / nullif(count({column}), 0), {digits}) AS DOUBLE)"


def count_if(condition):
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"


def band(low, middle, high):
    return f"CASE WHEN Age < 30 THEN '{low}' WHEN Age BETWEEN 30 AND 45 THEN '{middle}' ELSE '{high}' END"


def demographic(label, value, source):
    return f"""SELECT '{label}', {value}, count(DISTINCT CustomerID), {count_if(CHECKOUT_BUY)},
        {pct(count_if(CHECKOUT_BUY), "count(DISTINCT CustomerID)")} FROM {source} GROUP BY 2"""


JC = "j JOIN c USING (CustomerID)"
JCG = f"{JC} JOIN g USING (GeographyID)"
JP = "j JOIN p USING (ProductID)"
RP = "r JOIN p USING (ProductID)"

PLAIN = {
    product.top_products: f"SELECT ProductName, count(*) FROM {JP} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    product.product_conversion: f"""SELECT ProductName, CAST(round(avg(Price), 2) AS DOUBLE), count(DISTINCT CustomerID),
        {count_if(CHECKOUT_BUY)}, {pct(count_if(CHECKOUT_BUY), "count(DISTINCT CustomerID)")} FROM {JP} GROUP BY 1""",
    product.flagship_product: f"""SELECT ProductName, {pct(count_if(BUY), "count(*)")} FROM {JP}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    product.top_converting_products: f"""SELECT ProductName, count(*), {pct(count_if(BUY), "count(*)")} FROM {JP}
        GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 5""",
    product.product_purchases: f"SELECT ProductID, ProductName, {count_if(CHECKOUT_BUY)} FROM {JP} GROUP BY 1, 2",
    product.highest_rated_products: f"""SELECT ProductID, ProductName, {avg("Rating")} FROM {RP}
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5""",
    product.lowest_rated_products: f"""SELECT ProductID, ProductName, {avg("Rating")}, count(*) FROM {RP}
        GROUP BY 1, 2 ORDER BY 3 NULLS FIRST, 1 LIMIT 5""",
    product.top_rated_by_name: f"""SELECT ProductName, {avg("Rating", 1)} FROM {RP}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    product.top_rated_ids: f"SELECT ProductID, {avg('Rating')} FROM r GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    product.lowest_rated_ids: f"""SELECT ProductID, {avg("Rating")}, count(*) FROM r
        GROUP BY 1 ORDER BY 2 NULLS FIRST, 1 LIMIT 5""",
    product.reviews_per_product: f"SELECT ProductID, ProductName, count(*), {avg('Rating')} FROM {RP} GROUP BY 1, 2",
    product.product_ratings: f"SELECT ProductID, ProductName, {avg('Rating', 2)}, count(*) FROM {RP} GROUP BY 1, 2",
    product.dropoff_rate: f"""SELECT Stage, count(*), {count_if("Action = 'drop-off'")},
        {pct(count_if("Action = 'drop-off'"), "count(*)")} FROM j GROUP BY 1""",
    product.dropoff_counts: "SELECT Stage, count(*) FROM j WHERE Action = 'drop-off' GROUP BY 1",
    product.discount_candidates: f"""SELECT ProductName, {avg("Rating")}, count(ReviewID)
        FROM p LEFT JOIN r ON p.ProductID = r.ProductID LEFT JOIN (
          SELECT ProductID FROM j WHERE {BUY} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) best
          ON p.ProductID = best.ProductID
        WHERE best.ProductID IS NULL GROUP BY 1 HAVING avg(Rating) < 3.5 AND count(ReviewID) > 5
        ORDER BY 2, 1 LIMIT 1""",
    customer.top_regions: f"SELECT Country, count(*) FROM {JCG} WHERE {BUY} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    customer.regional_product_sales: f"""SELECT Country, ProductName, count(*) FROM {JCG} JOIN p USING (ProductID)
        WHERE {BUY} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    customer.customer_retention: """SELECT CASE WHEN v > 1 THEN 'Retained' ELSE 'One-Time' END, count(*)
        FROM (SELECT CustomerID, count(DISTINCT VisitDate) AS v FROM j GROUP BY 1) GROUP BY 1""",
    customer.retention_rate: f"""SELECT count(DISTINCT CustomerID), {count_if("v > 1")},
        {pct(count_if("v > 1"), "count(DISTINCT CustomerID)")}
        FROM (SELECT CustomerID, count(DISTINCT VisitDate) AS v FROM j GROUP BY 1)""",
    customer.one_time_purchasers: f"""SELECT CustomerID, count(DISTINCT JourneyID) FROM {JC} WHERE {BUY}
        GROUP BY 1 HAVING count(DISTINCT JourneyID) = 1""",
    customer.demographics_conversion: " UNION ALL ".join(
        [
            demographic("Age Range", band("<30", "30-45", ">45"), JC),
            demographic("Gender", "Gender", JC),
            demographic("Country", "Country", JCG),
        ]
    ),
    customer.age_conversion: demographic("Age Range", band("<30", "30-45", ">45"), JC),
    customer.demographic_performance: f"""SELECT {band("18-29", "30-45", "46+")}, Gender, Country, count(*),
        {pct(count_if(BUY), "count(DISTINCT CustomerID)")} FROM {JCG}
        GROUP BY 1, 2, 3 ORDER BY 5 DESC, 1, 2, 3 LIMIT 5""",
    customer.integrated_journeys: f"""SELECT GeographyID, CustomerID, JourneyID, ProductID, VisitDate, Stage, Action,
        Duration, CustomerName, Gender, Age, Country, City FROM {JCG}""",
    customer.journey_geography: f"""SELECT CustomerID, Country, City, Stage, Action, VisitDate FROM {JCG}
        ORDER BY JourneyID LIMIT 10""",
    marketing.engagement_conversion: f"""SELECT ContentType, count(DISTINCT EngagementID), {count_if(CHECKOUT_BUY)},
        {pct(count_if(CHECKOUT_BUY), "count(DISTINCT EngagementID)")} FROM e JOIN j USING (ProductID) GROUP BY 1""",
    marketing.engagement_likes: f"""SELECT ContentType, count(DISTINCT EngagementID), sum(Likes), {count_if(CHECKOUT_BUY)},
        {pct(count_if(CHECKOUT_BUY), "count(DISTINCT EngagementID)")}
        FROM e LEFT JOIN j ON e.ProductID = j.ProductID GROUP BY 1""",
    marketing.underperforming_products: f"""SELECT ProductName, {avg("Rating")}, count(JourneyID)
        FROM p LEFT JOIN r ON p.ProductID = r.ProductID LEFT JOIN j ON p.ProductID = j.ProductID AND {BUY}
        GROUP BY 1 ORDER BY 2 NULLS FIRST, 3, 1 LIMIT 5""",
    marketing.geo_performance: f"""SELECT Country, City, count(JourneyID), {avg("Rating")}
        FROM g LEFT JOIN c ON g.GeographyID = c.GeographyID
        LEFT JOIN j ON c.CustomerID = j.CustomerID AND {BUY}
        LEFT JOIN r ON j.ProductID = r.ProductID GROUP BY 1, 2""",
    marketing.poorly_converting_products: f"""SELECT ProductName, sum(Clicks), count(JourneyID)
        FROM p LEFT JOIN e ON p.ProductID = e.ProductID LEFT JOIN j ON p.ProductID = j.ProductID AND {BUY}
        GROUP BY 1 HAVING sum(Clicks) > 0 AND count(JourneyID) < 0.1 * sum(Clicks)""",
    marketing.channel_performance: f"""SELECT ContentType, {avg("Views")}, {avg("Clicks")}, count(JourneyID)
        FROM e LEFT JOIN j ON e.ProductID = j.ProductID AND {BUY} GROUP BY 1""",
    marketing.underperforming_channels: f"""SELECT ContentType, {avg("Views")}, {avg("Clicks")}, count(JourneyID)
        FROM e LEFT JOIN j ON e.ProductID = j.ProductID AND {BUY}
        GROUP BY 1 HAVING count(JourneyID) / avg(Clicks) < 0.05""",
    marketing.channel_roi: f"""SELECT ContentType, sum(Clicks), {count_if(BUY)}, {pct(count_if(BUY), "sum(Clicks)")}
        FROM e JOIN j USING (ProductID) GROUP BY 1""",
    marketing.rating_vs_engagement: f"""SELECT r.ProductID, {avg("Rating", 1)}, sum(Views), sum(Clicks)
        FROM r JOIN e ON r.ProductID = e.ProductID GROUP BY 1""",
    experience.review_sentiment: f"""SELECT ProductID, ProductName, ReviewText, Rating,
        CASE WHEN Rating > 3 THEN 1 WHEN Rating = 3 THEN 0 ELSE -1 END FROM {RP}""",
    experience.sentiment_summary: f"""SELECT CASE WHEN Rating <= 2 THEN 'Negative' WHEN Rating = 3 THEN 'Neutral'
        ELSE 'Positive' END, count(*), {avg("Rating", 2)} FROM {RP} GROUP BY 1""",
    experience.negative_reviews: f"SELECT ReviewID, ProductID, ProductName, ReviewText, Rating FROM {RP} WHERE Rating <= 2",
    experience.common_complaints: f"""SELECT ReviewText, ProductName, count(*) FROM {RP} WHERE Rating <= 2
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    experience.negatively_reviewed_products: f"SELECT DISTINCT ProductName FROM {RP} WHERE NOT coalesce(Rating >= 3, false)",
}


@pytest.fixture(scope="module", params=[1, 2])
def random_star(spark, request):
    star = skewed(spark, seed=request.param)
    for view, table in VIEWS.items():
        getattr(star, table).createOrReplaceTempView(view)
    return star


@pytest.mark.parametrize("report", PLAIN, ids=lambda report: report.__name__)
def test_report_equals_plain_join(spark, random_star, report):
    expected = spark.sql(PLAIN[report])
    found = report(random_star)
    assert len(found.columns) == len(expected.columns)
    assert rows(found) == rows(expected)


def test_plain_joins_with_the_salted_path(spark, random_star, conf):
    conf(spark__sql__adaptive__skewJoin__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    for report in (
        customer.integrated_journeys,
        customer.demographics_conversion,
        product.product_conversion,
        marketing.geo_performance,
        marketing.engagement_conversion,
        experience.common_complaints,
    ):
        assert rows(report(random_star)) == rows(spark.sql(PLAIN[report])), report.__name__


# --- hand-counted ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    return build(spark)


def test_names_merge_across_ids(star):
    assert ordered(product.top_products(star)) == [("Kayak", 6), ("Drum", 1)]


def test_two_purchase_predicates_differ(star):
    conversion = {r.ProductName: r for r in product.product_conversion(star).collect()}
    assert conversion["Kayak"].Total_Purchases == 3
    assert conversion["Kayak"].Unique_Customers == 3
    assert conversion["Kayak"].Conversion_Rate == 100.0
    assert conversion["Kayak"].Avg_Price == 11.67
    assert ordered(product.flagship_product(star)) == [("Kayak", 66.67)]


def test_fan_out_multiplies_counts_but_not_the_average(star):
    found = {r.ProductName: (r.AvgRating, int(r.PurchaseCount)) for r in marketing.underperforming_products(star).collect()}
    # ids 10 and 11: ratings 5 and 2 seen once per purchase of 10 (3), rating 3 once per purchase of 11 (1)
    assert found == {"Lamp": (None, 0), "Drum": (1.0, 0), "Kayak": (3.4286, 7)}
    assert [r.ProductName for r in marketing.underperforming_products(star).collect()] == ["Lamp", "Drum", "Kayak"]


def test_customer_without_a_place_counts_in_age_and_gender_only(star):
    found = {(r.Group_By, r.Group_Value): (r.Total_Customers, r.Total_Purchases) for r in customer.demographics_conversion(star).collect()}
    assert found == {
        ("Age Range", "<30"): (1, 1),
        ("Age Range", "30-45"): (1, 1),
        ("Age Range", ">45"): (2, 1),
        ("Gender", "Female"): (2, 2),
        ("Gender", "Male"): (2, 1),
        ("Country", "Austria"): (2, 2),
        ("Country", "Spain"): (1, 0),
    }


def test_retention_counts_dates_not_journeys(star):
    assert rows(customer.customer_retention(star)) == [("One-Time", 4), ("Retained", 1)]
    assert ordered(customer.retention_rate(star)) == [(5, 1, 20.0)]


def test_one_time_purchasers_are_known_customers(star):
    assert rows(customer.one_time_purchasers(star)) == [(1, 1), (4, 1)]
    assert rows(customer.one_time_purchasers(star, is_checkout_purchase())) == [(1, 1), (2, 1), (4, 1)]


def test_places_without_customers_stay(star):
    found = {r.City: (int(r.Purchases), r.AvgRating) for r in marketing.geo_performance(star).collect()}
    assert found == {"Vienna": (5, 3.4), "Madrid": (0, None), "Rome": (0, None)}


def test_channel_without_clicks_has_no_ratio(star):
    assert rows(marketing.underperforming_channels(star, ratio=100.0).select("ContentType")) == [("BLOG",), (None,)]
    roi = {r.ContentType: r.conversion_rate for r in marketing.channel_roi(star).collect()}
    assert roi["VIDEO"] is None


def test_duration_before_and_after_cleaning(star):
    assert ("checkout", 3, 50.0) in ordered(product.avg_stage_duration(star.journey))
    filled = clean.fill_missing(star.journey, {"Duration": 0.0})
    assert ("checkout", 4, 37.5) in ordered(product.avg_stage_duration(filled))


def test_sentiment_shares(star):
    assert ordered(experience.sentiment_distribution(star)) == [("Negative", 50.0), ("Neutral", 25.0), ("Positive", 25.0)]


def test_sentiment_shares_of_nothing(spark):
    assert ordered(experience.sentiment_distribution(build(spark, reviews=[]))) == []


def test_ties_at_the_border_go_by_name(spark):
    journeys = [(i, 1, i, None, "homepage", "view", 1.0) for i in range(1, 8)]
    products = [(i, name, "c", Decimal(1)) for i, name in enumerate("gfedcba", 1)]
    star = build(spark, journeys=journeys, products=products)
    assert [r.ProductName for r in product.top_products(star).collect()] == list("abcde")


def test_correlation_without_variance_is_null(spark):
    reviews = [(i, 1, p[0], None, 4, "t") for i, p in enumerate(PRODUCTS)]
    found = product.rating_purchase_correlation(build(spark, reviews=reviews)).first()
    assert found.products == 3
    assert found.correlation is None


def test_correlation(spark):
    star = build(spark)
    found = product.rating_purchase_correlation(star).first()
    # ratings 3.5, 3, 1 against purchases 2, 1, 0
    assert found.products == 3
    assert round(found.correlation, 6) == 0.944911


def test_best_sellers_are_left_out(star):
    assert rows(product.outside_best_sellers(star, 1).select("ProductID")) == [(11,), (12,), (13,)]


def test_star_ignoring_case(spark):
    mixed = [(*j[:4], j[4].title() if j[0] % 2 else j[4], j[5].upper(), j[6]) for j in JOURNEYS]
    products = [(i, name.upper() if i == 11 else name, kind, price) for i, name, kind, price in PRODUCTS]
    loose = build(spark, journeys=mixed, products=products).ignoring_case()
    exact = build(spark)

    def lowered(df):
        return rows(df.selectExpr(*[f"lower(CAST({c} AS STRING) COLLATE UTF8_BINARY) AS {c}" for c in df.columns]))

    for report in (
        product.product_conversion,
        product.dropoff_rate,
        customer.demographics_conversion,
        customer.top_regions,
        marketing.engagement_conversion,
        marketing.underperforming_products,
        experience.common_complaints,
        customer.one_time_purchasers,
    ):
        assert lowered(report(loose)) == lowered(report(exact)), report.__name__


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_complaints_by_digests_first(spark, monkeypatch, bits):
    """Ties by frequency and by the first characters, NULL and empty texts, also with a filter that holds little."""
    monkeypatch.setattr(membership, "LEAST_BITS", bits)
    monkeypatch.setattr(membership, "MOST_BITS", bits)
    texts = [None, "", "broken", "broken on arrival, twice", "broken on arrival, once", "Broken", "déjà vu " * 40]
    texts += [f"broken on arrival, number {i}" for i in range(60)]
    reviews = [(i, 1, 10 + i % 5, DAY1, 1 + i % 3, texts[i * i % len(texts)]) for i in range(400)]
    reviews += [(1000 + i, 1, 10, DAY1, 1, "hot") for i in range(200)]
    star = build(spark, reviews=reviews)
    for k in (0, 1, 2, 5, 40, 5000):
        assert ordered(experience.common_complaints(star, k, wide=True)) == ordered(experience.common_complaints(star, k))
    loose = star.ignoring_case()
    assert ordered(experience.common_complaints(loose, 2, wide=True)) == ordered(experience.common_complaints(loose, 2))
    assert ordered(experience.common_complaints(build(spark, reviews=[]), wide=True)) == []


def test_few_texts_move_where_digests_go_first(spark):
    reviews = [(i, 1, 10 + i % 3, DAY1, 1, f"{i % 1500:05d} " * 20) for i in range(1800)]
    star = build(spark, reviews=reviews)
    low = star.reviews.select("ProductID", "ReviewText")
    assert low.where(experience._may_be_common(star, low, 10)).select("ReviewText").distinct().count() < 20
    assert ordered(experience.common_complaints(star, wide=True)) == ordered(experience.common_complaints(star))


def test_no_facts_at_all(spark):
    star = build(spark, journeys=[], reviews=[], engagement=[])
    assert ordered(marketing.engagement_conversion(star)) == []
    assert ordered(customer.retention_rate(star)) == [(0, 0, None)]
    assert {int(r.PurchaseCount) for r in marketing.underperforming_products(star).collect()} == {0}


def test_an_average_just_below_the_border_is_a_discount_candidate(spark):
    # 60,000 reviews with the average 3.49998, which reads 3.5000 when rounded
    stars = [3] * 30_001 + [4] * 29_999
    reviews = [(i, 1, 10, DAY1, s, "t") for i, s in enumerate(stars)]
    star = build(spark, journeys=[], reviews=reviews, products=[(10, "Kayak", "Sport", Decimal("1.00"))])
    assert [tuple(r) for r in product.discount_candidates(star).collect()] == [("Kayak", 3.5, 60_000)]
    exactly = build(spark, journeys=[], reviews=[(i, 1, 10, DAY1, 3 + i % 2, "t") for i in range(10)], products=[(10, "Kayak", "Sport", Decimal("1.00"))])
    assert product.discount_candidates(exactly).count() == 0


@pytest.mark.parametrize("report", [marketing.engagement_conversion, marketing.geo_performance])
def test_no_task_gets_a_hot_product(spark, conf, report):
    """A third of all rows on one product, no broadcasts, splitting of skewed joins off: no task reads that third."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    size = 6000
    journeys = [(i, i, 7 if i % 3 == 0 else 100 + i, DAY1, "checkout", "purchase", 1.0) for i in range(size)]
    engagement = [(i, 1, "BLOG", 1, DAY1, 1, 7 if i % 3 == 0 else 100 + i, 1, 1) for i in range(size)]
    customers = [(i, "n", "e", "Male", 30, i % 40) for i in range(size)]
    geography = [(i, f"c{i}", f"t{i}") for i in range(40)]
    products = [(i, f"p{i}", "c", Decimal("1.00")) for i in [7, *range(100, 100 + size)]]
    reviews = [(i, i, 7 if i % 3 == 0 else 100 + i, DAY1, 5, "t") for i in range(size)]
    star = build(spark, journeys, reviews, customers, engagement, geography, products)
    joined = report(star)
    assert joined.count() in (1, 40)
    # rows that meet on the product: engagements are salted, sales are one row per place
    if report is marketing.geo_performance:
        sold = summaries.purchases_per(star.journey, "CustomerID", "ProductID").join(star.customers, "CustomerID")
        per_product = sold.groupBy("GeographyID", "ProductID").count().groupBy("ProductID").count()
        assert per_product.agg({"count": "max"}).first()[0] <= 40
    else:
        assert "_salt" in joined._jdf.queryExecution().toString()
