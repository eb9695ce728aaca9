"""Column expressions shared by the reports: predicates, exact rates, bands and sentiment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The canonical spellings in the cleaned journey table.
CHECKOUT = "checkout"
PURCHASE = "purchase"
DROP_OFF = "drop-off"

# The two label sets for the age cuts, and the sentiment labels.
AGE_RANGES = ("<30", "30-45", ">45")
AGE_GROUPS = ("18-29", "30-45", "46+")
POSITIVE, NEUTRAL, NEGATIVE = "Positive", "Neutral", "Negative"


def is_purchase() -> Column:
    return F.expr(f"Action = '{PURCHASE}'")


def is_checkout_purchase() -> Column:
    return F.expr(f"Stage = '{CHECKOUT}' AND Action = '{PURCHASE}'")


def is_drop_off() -> Column:
    return F.expr(f"Action = '{DROP_OFF}'")


# The functions below take SQL text for their operands, a column name in most cases.


def wide(operand: str) -> str:
    """SQL text: the operand as DECIMAL(38,0), a missing one as 0."""
    return f"CAST(coalesce({operand}, 0) AS DECIMAL(38,0))"


def at_least_one(count: str) -> str:
    """SQL text: rows a left-joined side gives per left row, its count or the one NULL row when there is none."""
    return f"CAST(greatest(coalesce({count}, 0), 1) AS DECIMAL(38,0))"


def wide_sum(operand: str) -> Column:
    """Sum for products of per-key counts, which outgrow BIGINT long before the inputs do."""
    return F.expr(f"CAST(sum({operand}) AS DECIMAL(38,0))")


def rounded_ratio(numerator: str, denominator: str, digits: int) -> Column:
    """``numerator / denominator`` of whole numbers, rounded half away from zero to ``digits`` decimals.

    The rounding is whole-number arithmetic on DECIMAL(38,0), so ties never depend on binary fractions and a
    fanned-out sum cannot overflow. A zero denominator gives NULL.
    """
    scale = 10**digits
    top, bottom = f"CAST({numerator} AS DECIMAL(38,0))", f"CAST({denominator} AS DECIMAL(38,0))"
    rounded = f"(abs({top}) * {2 * scale} + {bottom}) div nullif({bottom} * 2, 0)"
    return F.expr(f"sign({top}) * CAST({rounded} AS DOUBLE) / {scale}D")


def pct(part: str, whole: str) -> Column:
    """``part`` as a percentage of ``whole``, two decimals. The caller names the denominator explicitly."""
    return rounded_ratio(f"(CAST({part} AS DECIMAL(38,0)) * 100)", whole, 2)


def age_band(age: str, labels: tuple[str, str, str] = AGE_RANGES, low: int = 30, high: int = 45) -> Column:
    """Three bands cut at ``low`` and ``high``; a missing age falls into the last one."""
    below, between, above = labels
    return F.expr(
        f"CASE WHEN {age} < {low} THEN '{below}' WHEN {age} BETWEEN {low} AND {high} THEN '{between}' ELSE '{above}' END"
    )


def rating_sentiment(rating: str) -> Column:
    """1 for a rating over 3, 0 for 3, else -1."""
    return F.expr(f"CASE WHEN {rating} > 3 THEN 1 WHEN {rating} = 3 THEN 0 ELSE -1 END")


def rating_sentiment_label(rating: str) -> Column:
    """Negative up to 2, Neutral at 3, else Positive."""
    return F.expr(
        f"CASE WHEN {rating} <= 2 THEN '{NEGATIVE}' WHEN {rating} = 3 THEN '{NEUTRAL}' ELSE '{POSITIVE}' END"
    )


def score_label(score: str) -> Column:
    """Label by the sign of a score."""
    return F.expr(f"CASE WHEN {score} > 0 THEN '{POSITIVE}' WHEN {score} < 0 THEN '{NEGATIVE}' ELSE '{NEUTRAL}' END")
