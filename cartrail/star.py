"""The cleaned star every report reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ignoring_case(df: DataFrame) -> DataFrame:
    texts = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(*[F.collate(name, "UTF8_LCASE").alias(name) if name in texts else name for name in df.columns])


class Star:
    """Six cleaned tables: Stage and Action in lower case, ContentType in upper case (see ``operators.clean``).

    Takes any mapping from table name to DataFrame and asks it only for the tables a report reads.
    """

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self._tables = tables

    def ignoring_case(self) -> Star:
        """The same star with all text compared, grouped and sorted without regard to case.

        For tables that were not cleaned, or whose names and texts are spelled unevenly. A group shows one of its
        spellings. Filters on such columns do not reach the Parquet scan, so cleaned tables are better without.
        """
        return Star({name: _ignoring_case(df) for name, df in self._tables.items()})

    @property
    def journey(self) -> DataFrame:
        return self._tables["customer_journey"]

    @property
    def reviews(self) -> DataFrame:
        return self._tables["customer_reviews"]

    @property
    def customers(self) -> DataFrame:
        return self._tables["customers"]

    @property
    def engagement(self) -> DataFrame:
        return self._tables["engagement_data"]

    @property
    def geography(self) -> DataFrame:
        return self._tables["geography"]

    @property
    def products(self) -> DataFrame:
        return self._tables["products"]
