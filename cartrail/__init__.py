"""Customer-journey analytics as Spark DataFrame plans."""

from cartrail.star import Star

__all__ = ["Star"]
