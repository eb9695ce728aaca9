"""URL filters with dated lists: entries become validity intervals, captures meet those active at fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartrail.llm.common import written

#: an entry with this action ends what the list said about its pattern
REMOVE = "remove"
BLOCK = "block"
#: days that one piece of an interval spans; captures are joined to the pieces of their own time
PIECE = 32


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, NULL if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def folder_of(url: Column) -> Column:
    """The first part of a URL's path with its slash, or an empty string."""
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)", 1), F.lit(""))


def patterns_of(host: Column, folder: Column) -> Column:
    """The patterns that a page can match with their rank: host and folder first, then host and parent domains."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct((count - i).alias("rank"), F.array_join(F.slice(labels, i + 1, count), ".").alias("pattern")),
    )
    exact = F.array(F.struct((count + 1).alias("rank"), F.concat(host, folder).alias("pattern")))
    return F.when(host.isNotNull(), F.when(folder != "", F.concat(exact, domains)).otherwise(domains))


def intervals(entries: DataFrame) -> DataFrame:
    """``(pattern, action, since, until)`` from dated entries ``(pattern, action, listed_at)``.

    An entry holds from its date up to the next one of its pattern, the last one without end (NULL). Of
    entries with one pattern and date the action that comes last in alphabetical order counts; those without
    pattern, action or date don't.
    """
    whole = entries.where("pattern is not null and action is not null and listed_at is not null")
    each = whole.groupBy("pattern", F.col("listed_at").alias("since")).agg(F.max("action").alias("action"))
    following = F.lead("since").over(Window.partitionBy("pattern").orderBy("since"))
    return each.withColumn("until", following).where(F.col("action") != REMOVE).select("pattern", "action", "since", "until")


def judge_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_at: str = "fetched_at") -> DataFrame:
    """``captures`` with ``pattern``, ``action``, ``listed_at`` of the entry that holds for each, and ``blocked``.

    Of the entries active on the day of the capture the most specific counts: host and first folder before host
    before parent domains. Without one the three columns are NULL and ``blocked`` is false; so it is for
    captures without a date or a host. Every capture comes back once; a column named like an added one is
    replaced. Captures are first reduced to distinct host, folder and day, so a host with very many captures
    costs as much as its days. An empty list blocks nothing; empty captures give no rows.
    """
    added = ("pattern", "action", "listed_at", "blocked")
    kept = captures.drop(*added)
    day = F.col(f"`{fetched_at}`").cast("date")
    keyed = kept.withColumns({"__host": host_of(F.col(f"`{url}`")), "__folder": folder_of(F.col(f"`{url}`")), "__day": day})
    asked = keyed.where("__host is not null and __day is not null").select("__host", "__folder", "__day").distinct()
    last = captures.agg(F.max(day)).first()[0]
    spans = intervals(entries)
    end = F.least(F.coalesce(F.col("until"), F.lit(last).cast("date")), F.lit(last).cast("date"))

    def number(date: Column) -> Column:
        return F.floor(F.datediff(date, F.lit("1970-01-01").cast("date")) / F.lit(PIECE)).cast("int")

    pieces = spans.where(F.col("since") <= F.lit(last).cast("date")).withColumn("piece", F.explode(F.sequence(number(F.col("since")), number(end))))
    possible = asked.withColumn("p", F.explode(patterns_of(F.col("__host"), F.col("__folder")))).select("__host", "__folder", "__day", "p.*")
    timed = possible.withColumn("piece", number(F.col("__day")))
    active = timed.join(written(pieces), ["pattern", "piece"]).where(
        (F.col("since") <= F.col("__day")) & (F.col("until").isNull() | (F.col("__day") < F.col("until")))
    )
    best = F.max_by(F.struct("pattern", "action", F.col("since").alias("listed_at")), "rank").alias("__best")
    verdicts = written(active.groupBy("__host", "__folder", "__day").agg(best))
    judged = keyed.join(verdicts, ["__host", "__folder", "__day"], "left")
    blocked = F.coalesce(F.col("__best.action") == BLOCK, F.lit(False)).alias("blocked")
    return judged.select(*[F.col(f"`{c}`") for c in kept.columns], "__best.pattern", "__best.action", "__best.listed_at", blocked)
