"""Cleaning steps, table to table, and the per-table pipelines made of them.

Every step is a projection or a filter except the two that remove duplicates, and those aggregate before
they shuffle: copies of one row, or of one key, collapse inside each task first. Rows with long texts are told
apart by fingerprints.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.operators.duplicates import distinct_rows

# What replaces a missing value, and the accepted age range.
MISSING_DURATION = 0.0
MISSING_REVIEW = "No review"
AGE_LIMITS = (18, 100)

# Every character a Unicode-aware strip removes: white space plus the four ASCII separators.
_BLANK = r"[\s\x1c-\x1f]"
_EDGE_BLANKS = rf"(?U)\A{_BLANK}+|{_BLANK}+\z"
_WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a constant, per column."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in values.items()})


def lower_case(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.lower(name) for name in columns})


def upper_case(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.upper(name) for name in columns})


def capitalise(df: DataFrame, *columns: str) -> DataFrame:
    """First letter upper, all others lower (``initcap`` would capitalise every word)."""

    def first_upper(name: str) -> Column:
        return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.expr(f"substring(`{name}`, 2)")))

    return df.withColumns({name: first_upper(name) for name in columns})


def strip_blanks(df: DataFrame, *columns: str) -> DataFrame:
    """Remove any white space around the text; blanks inside it stay."""
    return df.withColumns({name: F.regexp_replace(name, _EDGE_BLANKS, "") for name in columns})


def clip(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Limit to ``[low, high]``; NULL stays NULL."""
    bounded = F.greatest(F.lit(low), F.least(F.lit(high), F.col(column)))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), bounded))


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def drop_duplicate_rows(df: DataFrame, wide: bool = False) -> DataFrame:
    """Every row once. With ``wide`` rows move only where they may be repeated (``duplicates.distinct_rows``)."""
    return distinct_rows(df) if wide else df.distinct()


def keep_first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every key by ``order``, which must not repeat within a key; ``order`` is dropped.

    An aggregate instead of a window: each task reduces a key to one candidate before the shuffle, so a key
    that holds a third of the rows costs no more than any other.
    """
    kept = [name for name in df.columns if name not in (key, order)]
    first = F.min_by(F.struct(*kept), F.col(order)).alias("_first")
    columns = [key if name == key else f"_first.{name}" for name in df.columns if name != order]
    return df.groupBy(key).agg(first).select(*columns)


def _pair_parts(column: str) -> Column:
    return F.split(F.col(column), "-")


def split_pair(df: DataFrame, column: str, left: str, right: str, strict: bool = False) -> DataFrame:
    """Split ``"a-b"`` into two INT columns and drop the packed one.

    A value that is not two whole numbers gives two NULLs (``malformed_pairs`` returns those rows), or with
    ``strict`` fails the job.
    """
    parts = _pair_parts(column)
    numbers = [F.try_element_at(parts, F.lit(i)) for i in (1, 2)]
    valid = _is_pair(column)
    typed = [F.when(valid, F.trim(number).try_cast("int")) for number in numbers]
    if strict:
        value = F.coalesce(F.col(column), F.lit("NULL"))
        message = F.concat(F.lit(f"{column} is not a pair of whole numbers: "), value)
        typed = [F.coalesce(number, F.raise_error(message).cast("int")) for number in typed]
    return df.withColumns({left: typed[0], right: typed[1]}).drop(column)


def _is_pair(column: str) -> Column:
    parts = _pair_parts(column)
    both = F.forall(parts, lambda part: part.rlike(_WHOLE_NUMBER) & F.trim(part).try_cast("int").isNotNull())
    return F.coalesce((F.size(parts) == 2) & both, F.lit(False))


def malformed_pairs(df: DataFrame, column: str) -> DataFrame:
    """Rows whose packed value ``split_pair`` cannot read."""
    return df.where(~_is_pair(column))


def clean_journey(raw: DataFrame) -> DataFrame:
    filled = fill_missing(raw, {"Duration": MISSING_DURATION})
    return drop_duplicate_rows(lower_case(filled, "Stage", "Action"))


def clean_reviews(raw: DataFrame) -> DataFrame:
    filled = fill_missing(raw, {"ReviewText": MISSING_REVIEW})
    return drop_duplicate_rows(strip_blanks(filled, "ReviewText"), wide=True)


def clean_customers(raw: DataFrame, order: str) -> DataFrame:
    """``order`` is the column that says which of two rows of one customer came first."""
    typed = clip(capitalise(raw, "Gender"), "Age", *AGE_LIMITS)
    return keep_first_per_key(typed, "CustomerID", order)


def clean_engagement(raw: DataFrame, strict: bool = False) -> DataFrame:
    unpacked = split_pair(upper_case(raw, "ContentType"), "ViewsClicksCombined", "Views", "Clicks", strict)
    return drop_duplicate_rows(unpacked)


def clean_geography(raw: DataFrame) -> DataFrame:
    return drop_duplicate_rows(raw)


def clean_products(raw: DataFrame) -> DataFrame:
    return drop_duplicate_rows(keep_positive(raw, "Price"))


def clean_all(raw: Mapping[str, DataFrame], customer_order: str, strict: bool = False) -> dict[str, DataFrame]:
    """Six raw tables in, six cleaned tables out, under the same names."""
    return {
        "customer_journey": clean_journey(raw["customer_journey"]),
        "customer_reviews": clean_reviews(raw["customer_reviews"]),
        "customers": clean_customers(raw["customers"], customer_order),
        "engagement_data": clean_engagement(raw["engagement_data"], strict),
        "geography": clean_geography(raw["geography"]),
        "products": clean_products(raw["products"]),
    }
