"""Table sources: CSV, Parquet, catalog views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartrail import schemas

#: file position of a row; says which of two rows of one key came first
INGEST_ORDER = "ingest_order"


#: the line of a row that doesn't fit its schema
BAD_LINE = "bad_line"


def _read_csv(spark: SparkSession, schema: StructType, path: str, multi_line: bool, mode: str) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("mode", mode).option("escape", '"')
    reader = reader.option("enforceSchema", False)
    return reader.option("columnNameOfCorruptRecord", BAD_LINE).option("multiLine", multi_line).csv(path)


def read_csv_checked(
    spark: SparkSession, table: str, path: str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """A CSV with header as its good rows, in the declared raw schema, and its bad ones, as ``(bad_line)``.

    A line is bad when a value doesn't read as its column's type, or when it has more or fewer values than the
    schema has columns. No line is lost: each is in one of the two.
    """
    wide = StructType([*schemas.RAW[table], StructField(BAD_LINE, StringType())])
    # a line is known to be bad only where all of it is parsed, so every query on it has to name every column
    named = F.pmod(F.xxhash64(*schemas.RAW[table].names), F.lit(1)) == 0
    rows = _read_csv(spark, wide, path, multi_line, "PERMISSIVE").where(named)
    return rows.where(f"{BAD_LINE} IS NULL").drop(BAD_LINE), rows.where(f"{BAD_LINE} IS NOT NULL").select(BAD_LINE)


def read_csv_tables(
    spark: SparkSession, paths: Mapping[str, str], multi_line: bool = False, strict: bool = True
) -> dict[str, DataFrame]:
    """One CSV with header per table name, read with the declared raw schema (no inference pass).

    A bad line fails the read; ``strict=False`` leaves bad lines out, which ``read_csv_checked`` returns.
    ``multi_line`` is for quoted values with line breaks; such files are read by one task each.
    """
    if strict:
        return {name: _read_csv(spark, schemas.RAW[name], path, multi_line, "FAILFAST") for name, path in paths.items()}
    return {name: read_csv_checked(spark, name, path, multi_line)[0] for name, path in paths.items()}


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every column as text: the input of ``operators.profile.inferred_types``."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Number the rows of a file scan by file, block and place in the block, so that order follows the files."""
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(INGEST_ORDER, position)


def read_parquet_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """One Parquet directory per table name, conformed to the declared cleaned schema."""
    return {name: schemas.conform(spark.read.parquet(path), schemas.CLEAN[name]) for name, path in paths.items()}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
