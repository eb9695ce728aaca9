"""Data profiling: one aggregate pass per table, turned into rows afterwards."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartrail.operators.duplicates import repeated_rows

Tables = Mapping[str, DataFrame]

_WHOLE = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _unfolded(df: DataFrame, table: str, aggregates: list[str], names: str, cells: list[str]) -> DataFrame:
    """One aggregate pass over ``df``, its single row turned into one row per column of ``df``.

    ``aggregates`` and ``cells`` are SQL text; ``cells`` fill the columns ``names``, column after column.
    """
    one_row = df.selectExpr(*aggregates)
    return one_row.selectExpr(f"'{table}' AS table_name", f"stack({len(df.columns)}, {', '.join(cells)}) AS ({names})")


def null_counts(tables: Tables) -> DataFrame:
    """NULLs per column: ``(table_name, column_name, nulls)``."""

    def one(table: str, df: DataFrame) -> DataFrame:
        counts = [f"count(*) - count(`{c}`) AS `{c}`" for c in df.columns]
        return _unfolded(df, table, counts, "column_name, nulls", [f"'{c}', `{c}`" for c in df.columns])

    return _union([one(table, df) for table, df in tables.items()])


def duplicate_counts(tables: Tables, wide: Collection[str] = ("customer_reviews",)) -> DataFrame:
    """Rows equal to an earlier row, NULLs being equal: ``(table_name, duplicates)``.

    Of the tables named in ``wide`` only fingerprints move, and rows that may be repeated.
    """

    def one(table: str, df: DataFrame) -> DataFrame:
        if table in wide:
            return repeated_rows(df).selectExpr(f"'{table}' AS table_name", "duplicates")
        copies = df.groupBy(*df.columns).agg(F.expr("count(*) AS _copies"))
        return copies.selectExpr(f"'{table}' AS table_name", "coalesce(sum(_copies - 1), 0) AS duplicates")

    return _union([one(table, df) for table, df in tables.items()])


def inferred_types(tables: Tables) -> DataFrame:
    """The narrowest of bigint, double and string that holds every value of a text column.

    For tables read as plain text; a column without values is reported as string. Gives
    ``(table_name, column_name, type)``.
    """

    def one(table: str, df: DataFrame) -> DataFrame:
        widest = [
            f"max(CASE WHEN `{c}` RLIKE r'{_WHOLE}' THEN 1 WHEN `{c}` RLIKE r'{_NUMBER}' THEN 2 ELSE 3 END) "
            f"FILTER (WHERE `{c}` IS NOT NULL) AS `{c}`"
            for c in df.columns
        ]
        cells = [f"'{c}', coalesce(elt(`{c}`, 'bigint', 'double', 'string'), 'string')" for c in df.columns]
        return _unfolded(df, table, widest, "column_name, type", cells)

    return _union([one(table, df) for table, df in tables.items()])


def key_uniqueness(tables: Tables, keys: Mapping[str, str]) -> DataFrame:
    """Is the column free of repeats? ``(table_name, column_name, is_unique, nulls)``; two NULLs are a repeat."""

    def one(table: str, df: DataFrame, key: str) -> DataFrame:
        per_value = df.groupBy(key).agg(F.expr("count(*) AS _rows"))
        return per_value.selectExpr(
            f"'{table}' AS table_name",
            f"'{key}' AS column_name",
            "coalesce(max(_rows), 0) <= 1 AS is_unique",
            f"coalesce(sum(_rows) FILTER (WHERE `{key}` IS NULL), 0) AS nulls",
        )

    return _union([one(table, tables[table], key) for table, key in keys.items()])


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Frequency of every non-NULL value: ``(column_name, value, count)``, most frequent first.

    One shuffle for all columns: rows are unfolded into (column, value) pairs, counted inside each task.
    """
    names = columns or tuple(df.columns)
    cells = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in names)
    pairs = df.selectExpr(f"stack({len(names)}, {cells}) AS (column_name, value)").where("value IS NOT NULL")
    counted = pairs.groupBy("column_name", "value").agg(F.expr("count(*) AS count"))
    return counted.orderBy("column_name", F.desc("count"), "value")


def table_info(tables: Tables) -> DataFrame:
    """``(table_name, column_name, type, rows, non_null)`` per column."""

    def one(table: str, df: DataFrame) -> DataFrame:
        counts = ["count(*) AS _rows", *[f"count(`{c}`) AS `{c}`" for c in df.columns]]
        cells = [f"'{name}', '{kind}', _rows, `{name}`" for name, kind in df.dtypes]
        return _unfolded(df, table, counts, "column_name, type, rows, non_null", cells)

    return _union([one(table, df) for table, df in tables.items()])


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows by ``order``."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Last ``n`` rows by ``order``."""
    return df.orderBy(*[F.desc(name) for name in order]).limit(n)


def _draw(df: DataFrame, seed: int, by: Sequence[str]) -> Column:
    """The place of a row in a random order that follows from its values alone: hexadecimal digits of a hash."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in by or df.columns]
    missing = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in by or df.columns])
    return F.md5(F.concat_ws(chr(31), F.lit(str(seed)), missing, *cells))


def _weighted_draw(draw: Column, weight: str | None) -> Column:
    """Exponential keys: the smallest are a sample without replacement in which a row's chance follows its weight.

    A weight that is NULL or not above 0 gives NULL: the row is never drawn.
    """
    if weight is None:
        return draw
    digits = F.conv(F.substring(draw, 1, 13), 16, 10).cast("bigint")
    waited = -F.ln((digits + F.lit(0.5)) / F.lit(float(1 << 52)))
    return F.when(F.col(f"`{weight}`") > 0, waited / F.col(f"`{weight}`"))


def sample_rows(df: DataFrame, n: int, seed: int, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows drawn at random without replacement, by ``weight`` if one is named.

    The draw of a row is a hash of the columns ``by``, all unless told, so any partitioning and any rerun give the same
    rows; rows that are equal in them are drawn together, as far as ``n`` allows. Every task keeps its ``n`` smallest
    draws, the smallest of those win.
    """
    drawn = df.withColumn("_draw", _draw(df, seed, by))
    keyed = drawn.withColumn("_key", _weighted_draw(F.col("_draw"), weight))
    return keyed.where("_key IS NOT NULL").orderBy("_key", "_draw", *df.columns).limit(n).drop("_draw", "_key")


def sample_strata(
    df: DataFrame, n: int, strata: Sequence[str], seed: int, weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Up to ``n`` rows of each combination of the columns ``strata`` (NULL is a value), drawn as in ``sample_rows``.

    Each task drops all but its ``n`` smallest draws of a stratum before anything moves, so a stratum with most of
    the rows costs no more than another.
    """
    drawn = df.withColumn("_draw", _draw(df, seed, by))
    keyed = drawn.withColumn("_key", _weighted_draw(F.col("_draw"), weight)).where("_key IS NOT NULL")
    order = Window.partitionBy(*strata).orderBy("_key", "_draw", *[c for c in df.columns if c not in strata])
    return keyed.withColumn("_turn", F.row_number().over(order)).where(F.col("_turn") <= n).drop("_draw", "_key", "_turn")


def correlation_matrix(df: DataFrame, *columns: str) -> DataFrame:
    """Pearson correlations of all pairs of columns: ``column_name`` and a column for each of ``columns``.

    One pass adds up the co-moments of all pairs. A pair counts the rows where both are there; where either doesn't
    vary over these, or there are none, it is NULL.
    """
    moments = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns[: i + 1]):
            both = f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL"
            x, y = f"if({both}, CAST(`{a}` AS DOUBLE), NULL)", f"if({both}, CAST(`{b}` AS DOUBLE), NULL)"
            spread = f"sqrt(var_pop({x})) * sqrt(var_pop({y}))"
            own = f"CASE WHEN var_pop({x}) > 0 THEN 1D END"
            moments.append(f"{own if i == j else f'try_divide(covar_pop({x}, {y}), {spread})'} AS `{i}_{j}`")
    cells = []
    for i, a in enumerate(columns):
        cells.append(", ".join([f"'{a}'", *[f"`{max(i, j)}_{min(i, j)}`" for j in range(len(columns))]]))
    names = ", ".join(["column_name", *[f"`{c}`" for c in columns]])
    return df.selectExpr(*moments).selectExpr(f"stack({len(columns)}, {', '.join(cells)}) AS ({names})")


#: distinct values are estimated within 5 %, in all but few of a thousand cases: HyperLogLog, 4,096 registers
DISTINCT_ERROR = 0.05
#: a quantile's true rank is off by at most 2 %, in all but few of a thousand cases: KLL, k = 200
RANK_ERROR = 0.02
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def sketch_profile(tables: Tables, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One scan per table: ``(table_name, column_name, rows, nulls, distinct, least, greatest, quantiles)``.

    ``distinct`` and ``quantiles``, of numbers only, are estimates from sketches that tasks build and merge; what
    moves is a few kilobytes for a column and task. ``least`` and ``greatest`` are exact, as text.
    """
    wanted = ", ".join(f"{r}D" for r in ranks)

    def one(table: str, df: DataFrame) -> DataFrame:
        aggregates, cells = ["count(*) AS _rows"], []
        for i, (name, kind) in enumerate(df.dtypes):
            counted = f"`{name}`" if kind in ("int", "bigint", "string", "binary") else f"CAST(`{name}` AS STRING)"
            aggregates.append(f"count(`{name}`) AS _n{i}")
            aggregates.append(f"hll_sketch_estimate(hll_sketch_agg({counted})) AS _d{i}")
            aggregates.append(f"CAST(min(`{name}`) AS STRING) AS _l{i}")
            aggregates.append(f"CAST(max(`{name}`) AS STRING) AS _g{i}")
            quantiles = "filter(array(CAST(NULL AS DOUBLE)), x -> x IS NOT NULL)"
            if kind.split("(")[0] in _NUMBERS:
                aggregates.append(f"kll_sketch_agg_double(CAST(`{name}` AS DOUBLE)) AS _k{i}")
                quantiles = f"CASE WHEN _n{i} > 0 THEN kll_sketch_get_quantile_double(_k{i}, array({wanted})) ELSE {quantiles} END"
            cells.append(f"'{name}', _rows, _rows - _n{i}, coalesce(_d{i}, 0), _l{i}, _g{i}, {quantiles}")
        return _unfolded(df, table, aggregates, "column_name, rows, nulls, distinct, least, greatest, quantiles", cells)

    return _union([one(table, df) for table, df in tables.items()])
