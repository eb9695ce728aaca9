"""Declared keys, checked before a load: rows that break one are set aside with the reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartrail import schemas
from cartrail.operators import membership
from cartrail.sources.sinks import work_dir

MISSING, REPEATED, ORPHAN = "no key", "repeated key", "no row in "
REASON = "reason"


@dataclass(frozen=True)
class Checked:
    """All rows by table name, with a column ``reason`` that is NULL for those that keep all keys."""

    told: dict[str, DataFrame]

    @property
    def good(self) -> dict[str, DataFrame]:
        return {name: df.where(f"{REASON} IS NULL").drop(REASON) for name, df in self.told.items()}

    @property
    def bad(self) -> dict[str, DataFrame]:
        return {name: df.where(f"{REASON} IS NOT NULL") for name, df in self.told.items()}

    def report(self) -> DataFrame:
        """``(table_name, reason, rows)`` of the rows set aside."""
        parts = [
            df.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), REASON, "rows")
            for name, df in self.bad.items()
        ]
        return reduce(DataFrame.unionByName, parts)


#: a filter is worth its place up to so many bad keys: then it lets a seventh of the other rows through at most
FEW = membership.MOST_BITS // 4
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _written(df: DataFrame, *by: str) -> DataFrame:
    path = work_dir(df.sparkSession)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _kind(df: DataFrame, names: Sequence[str], others: Sequence[DataFrame]) -> str:
    """The type keys are compared in: whole numbers where all of them are, else text."""
    kinds = [dict(df.dtypes)[name] for name in names] + [dict(other.dtypes)["key"] for other in others]
    return "bigint" if all(kind in _WHOLE for kind in kinds) else "string"


def _bad_keys(df: DataFrame, key: str, foreign: Mapping[str, str], known: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """``(key, place)``: keys of ``df`` that occur twice, at place 0, and those that its other tables don't have, at
    the places of their columns.

    The primary key is counted by itself, as it seldom repeats; the other columns are unfolded into (place, key) pairs,
    of which each task passes on one.
    """
    whole = df.selectExpr(f"CAST(`{key}` AS {kind}) AS key").where("key IS NOT NULL")
    repeated = whole.groupBy("key").agg(F.expr("count(*) AS rows")).where("rows > 1")
    bad = repeated.select("key", F.lit(0).alias("place"))
    if foreign:
        cells = ", ".join(f"{place}, CAST(`{name}` AS {kind})" for place, name in enumerate(foreign, 1))
        pairs = df.selectExpr(f"stack({len(foreign)}, {cells}) AS (place, key)").where("key IS NOT NULL").distinct()
        there = [
            known[table].select(F.lit(place).alias("place"), F.col("key").cast(kind).alias("key"))
            for place, table in enumerate(foreign.values(), 1)
        ]
        orphans = pairs.join(reduce(DataFrame.unionByName, there), ["place", "key"], "left_anti")
        bad = bad.unionByName(orphans.select("key", "place"))
    return bad


def _broadcasts(spark: SparkSession) -> bool:
    """Whether the session lets Spark broadcast small tables (it does by default)."""
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m").startswith(("-", "0"))


def _check(df: DataFrame, key: str, foreign: Mapping[str, str], known: Mapping[str, DataFrame]) -> DataFrame:
    names = (key, *foreign)
    kind = _kind(df, names, [known[table] for table in foreign.values()])
    # a folder for each column, so that Spark knows the sizes of the tables it joins
    bad_keys = _written(_bad_keys(df, key, foreign, known, kind), "place")
    counts = {row["place"]: row["count"] for row in bad_keys.groupBy("place").count().collect()}
    values = {place: F.col(f"`{names[place]}`").cast(kind) for place in counts}
    told, rest = df, None
    if counts and sum(counts.values()) <= FEW and not _broadcasts(df.sparkSession):
        # only what the filter lets through meets the bad keys; the rest stays where it is
        bad = membership.key_filter(bad_keys.select("place", "key"))
        suspect = F.col(f"`{key}`").isNull()
        for place, value in values.items():
            suspect = suspect | (value.isNotNull() & bad.may_contain(F.lit(place), value))
        told, rest = df.where(suspect), df.where(~suspect).withColumn(REASON, F.lit(None).cast("string"))
    reasons = [F.when(F.col(f"`{key}`").isNull(), MISSING)]
    for place, value in sorted(values.items(), key=lambda item: item[0]):
        mine = bad_keys.where(F.col("place") == place).select(F.col("key").alias(f"_key{place}"))
        told = told.join(mine, value == F.col(f"_key{place}"), "left")
        reasons.append(F.when(F.col(f"_key{place}").isNotNull(), REPEATED if place == 0 else ORPHAN + foreign[names[place]]))
    told = told.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(*reasons).alias(REASON))
    return told if rest is None else rest.unionByName(told)


def quarantine(
    tables: Mapping[str, DataFrame],
    primary: Mapping[str, str] = schemas.PRIMARY_KEYS,
    foreign: Mapping[str, Mapping[str, str]] = schemas.FOREIGN_KEYS,
) -> Checked:
    """Every row is good, or bad for the first of these reasons: no key, a key that other rows have as well, a
    column that names a row which the good rows of its table don't have, in the order of the columns.

    All rows of a repeated key are bad, as nothing says which is right; a NULL in a foreign column names nothing and
    is good. Tables come after those they name, so a fact without a good dimension row is found. What is
    shuffled are keys, counted per task; rows meet the bad keys of each column, which Spark broadcasts by its own
    threshold. Where it may not, rows move only if a filter of bad keys lets them through. A clean table is read
    twice and never shuffled. Tables are computed when this is called, and again when used.
    """
    told: dict[str, DataFrame] = {}
    known: dict[str, DataFrame] = {}
    named = {table for columns in foreign.values() for table in columns.values()}
    waiting = dict(tables)
    while waiting:
        ready = [n for n in waiting if not set(foreign.get(n, {}).values()) & (set(waiting) - {n})]
        if not ready:
            raise ValueError(f"tables name each other: {sorted(waiting)}")
        for name in ready:
            columns = {column: table for column, table in foreign.get(name, {}).items() if table in known}
            told[name] = _check(waiting.pop(name), primary[name], columns, known)
            if name in named:
                good = told[name].where(f"{REASON} IS NULL")
                known[name] = _written(good.select(F.col(f"`{primary[name]}`").alias("key")))
    return Checked({name: told[name] for name in tables})
