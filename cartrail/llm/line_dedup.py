"""Line dedup by site-relative frequency: lines on too many pages of their host are boilerplate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import boxed, unboxed, written

RATIO = 0.01
MIN_PAGES = 5


def line_counts(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``(host, line_key, pages)``: on how many pages of a host a line with a word stands, counted once a page.

    Lines go by their MD5, and every task adds up what it has seen before anything moves.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    with_word = F.filter(F.split(content, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    keys = F.array_distinct(F.transform(with_word, lambda line: F.md5(line)))
    lines = docs.select(F.col(f"`{host}`").alias("host"), F.explode(keys).alias("line_key"))
    return lines.groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("pages"))


def boilerplate(
    docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text"
) -> DataFrame:
    """``(host, lines)``: for each host the keys of the lines on more than ``ratio`` of its pages.

    Only lines on ``min_pages`` pages or more count. A host has at most (lines of a page, on average) / ratio
    such lines, however many pages it has, so the array stays short.
    """
    pages = docs.groupBy(F.col(f"`{host}`").alias("__host")).agg(F.count(F.lit(1)).alias("all_pages"))
    counted = line_counts(docs, host, text).where(F.col("pages") >= min_pages)
    joined = counted.join(written(pages), F.col("host").eqNullSafe(F.col("__host")))
    frequent = joined.where(F.col("pages") > F.col("all_pages") * F.lit(ratio))
    return frequent.groupBy("host").agg(F.collect_list("line_key").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", text: str = "text"
) -> DataFrame:
    """``docs`` without the boilerplate lines of their hosts, with ``lines_dropped`` added.

    Lines without a word stay, and so does a text that would lose every line with a word: a page that is nothing
    but frequent lines, as each of many copies is, is left to near-dedup and not emptied. Every row is kept. A NULL
    host is a host like others; NULL texts stay NULL, empty ones empty; equal rows are treated alike; an empty
    table stays empty. A column of ``docs`` that is called ``lines_dropped`` is replaced.
    """
    docs = docs.drop("lines_dropped")
    bad = written(boilerplate(docs, ratio, min_pages, host, text))
    boxes = docs.select(boxed(docs).alias("__doc"), F.col(f"`{host}`").alias("__host"), F.col(f"`{text}`").alias("__text"))
    # the lists are as short as the pages' lines are few; Spark broadcasts them where all hosts together are small,
    # and otherwise splits a hot host's partition, as nothing above the join needs a host's rows together
    joined = boxes.join(bad, F.col("__host").eqNullSafe(F.col("host")), "left")
    lines = F.split(F.col("__text"), "\n")
    # a page is hashed against its host's list once; what it has of it is short
    mine = F.array_intersect(F.transform(lines, lambda line: F.md5(line)), F.col("lines"))
    met = joined.withColumn("__mine", mine)
    kept = F.filter(lines, lambda line: ~F.array_contains(F.col("__mine"), F.md5(line)))
    shorter = met.withColumn("__kept", F.when(F.size("__mine") > 0, kept))
    some_left = F.exists("__kept", lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    chosen = F.when(some_left & (F.size("__kept") < F.size(lines)), F.array_join("__kept", "\n")).otherwise(F.col("__text"))
    dropped = F.when(some_left, F.size(lines) - F.size("__kept")).otherwise(F.lit(0))
    done = shorter.withColumn("__new", chosen).withColumn("__dropped", dropped.cast("int"))
    return done.select(*unboxed(docs, "__doc", {text: "__new"}), F.col("__dropped").alias("lines_dropped"))
