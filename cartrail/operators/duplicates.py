"""Repeated rows of tables with long texts: fingerprints move, and whole rows only where fingerprints meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.operators.membership import key_filter
from cartrail.sources.sinks import work_dir


def fingerprint(df: DataFrame) -> list[Column]:
    """128 bits of a row, as two numbers. Equal rows have equal ones; a NULL is a value of its own."""
    cells = [F.col(f"`{c}`") for c in df.columns]
    missing = [cell.isNull() for cell in cells]
    return [F.xxhash64(F.lit(seed), *cells, *missing) for seed in ("first", "second")]


def _may_repeat(df: DataFrame) -> Column:
    """False only for rows that no other row equals; computed when called, from 16 bytes a row."""
    low, high = fingerprint(df)
    counted = df.select(low.alias("low"), high.alias("high")).groupBy("low", "high").agg(F.count(F.lit(1)).alias("rows"))
    path = work_dir(df.sparkSession)
    counted.where("rows > 1").select("low", "high").write.parquet(path)
    return key_filter(df.sparkSession.read.schema("low bigint, high bigint").parquet(path)).may_contain(low, high)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` for wide rows: those that no other row equals stay where they are.

    Fingerprints are counted first. Rows whose fingerprint may be a repeated one are compared whole, so neither a
    collision of fingerprints nor a false hit of the filter changes the result. ``df`` is read twice.
    """
    repeated = _may_repeat(df)
    return df.where(~repeated).unionByName(df.where(repeated).distinct())


def repeated_rows(df: DataFrame) -> DataFrame:
    """One row, ``duplicates``: how many rows equal an earlier one; only rows that may be repeated move whole."""
    copies = df.where(_may_repeat(df)).groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.expr("count(*) AS _copies"))
    return copies.selectExpr("coalesce(sum(_copies - 1), 0) AS duplicates")
