"""A hand-made cleaned star, and larger random ones with hot keys."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

from cartrail import Star, schemas

DAY1, DAY2 = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)

JOURNEYS = [
    # customer 1: two journeys on one date; customer 2: two dates; customer 3: one
    (1, 1, 10, DAY1, "homepage", "view", 20.0),
    (2, 1, 10, DAY1, "checkout", "purchase", 40.0),
    (3, 2, 10, DAY1, "productpage", "click", 30.0),
    (4, 2, 11, DAY2, "checkout", "purchase", 50.0),
    # a purchase outside checkout
    (5, 2, 10, DAY2, "productpage", "purchase", 10.0),
    (6, 3, 12, DAY1, "checkout", "drop-off", None),
    # customer 4 has no place
    (7, 4, 10, DAY1, "checkout", "purchase", 60.0),
    # a customer and a product nobody knows
    (8, 99, 98, DAY1, "homepage", "view", 5.0),
]
CUSTOMERS = [
    (1, "Ann", "a@x", "Female", 29, 1),
    (2, "Bob", "b@x", "Male", 30, 1),
    (3, "Cid", "c@x", "Male", 46, 2),
    (4, "Dee", "d@x", "Female", None, None),
]
GEOGRAPHY = [(1, "Austria", "Vienna"), (2, "Spain", "Madrid"), (3, "Italy", "Rome")]
PRODUCTS = [
    (10, "Kayak", "Sport", Decimal("10.00")),
    (11, "Kayak", "Sport", Decimal("20.00")),
    (12, "Drum", "Music", Decimal("5.50")),
    (13, "Lamp", "Home", Decimal("7.25")),
]
REVIEWS = [
    (1, 1, 10, DAY1, 5, "good  good  boat"),
    (2, 2, 10, DAY1, 2, "bad boat"),
    (3, 3, 11, DAY2, 3, "just a boat"),
    (4, 3, 12, DAY2, 1, "bad bad drum"),
]
ENGAGEMENT = [
    (1, 1, "BLOG", 3, DAY1, 1, 10, 100, 10),
    (2, 1, "BLOG", 4, DAY1, 1, 11, 200, 20),
    (3, 1, "VIDEO", 5, DAY1, 1, 12, 300, 0),
    (4, 1, "VIDEO", 6, DAY1, 1, 13, 400, 0),
    (5, 1, None, 7, DAY1, 1, 10, 500, 50),
]


def build(spark, journeys=JOURNEYS, reviews=REVIEWS, customers=CUSTOMERS, engagement=ENGAGEMENT, geography=GEOGRAPHY, products=PRODUCTS):
    rows = {
        "customer_journey": journeys,
        "customer_reviews": reviews,
        "customers": customers,
        "engagement_data": engagement,
        "geography": geography,
        "products": products,
    }
    return Star({name: spark.createDataFrame(data, schemas.CLEAN[name]) for name, data in rows.items()})


def skewed(spark, seed=1, size=300):
    """Random rows in which one product and one customer hold over a third of every fact; some keys are NULL."""
    pick = random.Random(seed)

    def product():
        return pick.choice([10, 10, 10, 10, None, *range(10, 22)])

    def customer():
        return pick.choice([1, 1, 1, 1, None, *range(1, 14)])

    def rating():
        return pick.choice([None, 1, 2, 3, 4, 5])

    stages, actions = ["homepage", "productpage", "checkout"], ["view", "click", "purchase", "purchase", "drop-off"]
    journeys = [
        (i, customer(), product(), pick.choice([DAY1, DAY2, None]), pick.choice(stages), pick.choice(actions), 1.0)
        for i in range(size)
    ]
    texts = ["bad  boat", "good boat", "so so", "", None]
    reviews = [(i // 2, customer(), product(), DAY1, rating(), pick.choice(texts)) for i in range(size)]
    engagement = [
        (
            i // 2, 1, pick.choice(["BLOG", "BLOG", "VIDEO", None]), pick.choice([None, 1, 2]), DAY1, 1, product(),
            pick.choice([None, 10, 21]), pick.choice([None, 3, 4]),
        )
        for i in range(size)
    ]
    customers = [
        (i, f"c{i}", "e", pick.choice(["Male", "Female", None]), pick.choice([None, 20, 30, 45, 46]), pick.choice([1, 1, 2, None]))
        for i in range(1, 12)
    ]
    products = [(i, pick.choice(["Kayak", "Drum", "Lamp", "Bell"]), "c", Decimal("1.25") * i) for i in range(10, 19)]
    return build(spark, journeys, reviews, customers, engagement, GEOGRAPHY, products)


def rows(df):
    """Rows as a sorted list of tuples, decimals as int where whole."""

    def plain(value):
        if isinstance(value, Decimal):
            return int(value) if value == value.to_integral_value() else float(value)
        return value

    found = [tuple(plain(v) for v in row) for row in df.collect()]
    return sorted(found, key=lambda row: [(v is None, str(v)) for v in row])


def ordered(df):
    return [tuple(row) for row in df.collect()]
