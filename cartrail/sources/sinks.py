"""Table, CSV and text sinks, and the load report."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "table_name string, status string, rows bigint"


def work_dir(spark: SparkSession) -> str:
    """A fresh directory below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; on a cluster a machine-local folder would lose data.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cartrail-")
    return f"{base.rstrip('/')}/cartrail-{uuid.uuid4().hex}"


class _Files:
    """The file system of a path, as Spark's own writers reach it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} can't be renamed to {target}")

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def write_table(df: DataFrame, path: str) -> int:
    """Write ``df`` as Parquet, replacing what was there; the number of rows written, counted by the write.

    The rows go to a new folder beside ``path`` first and take its place when they are complete. A write that
    fails leaves the old table as it was, and ``df`` may read that table.
    """
    written = Observation()
    mark = uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}-new-{mark}", f"{path.rstrip('/')}-old-{mark}"
    files = _Files(df.sparkSession, path)
    try:
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(fresh)
    except Exception:
        files.delete(fresh)
        raise
    replaced = files.exists(path)
    if replaced:
        files.rename(path, old)
    try:
        files.rename(fresh, path)
    except Exception:
        if replaced:
            files.rename(old, path)
        raise
    if replaced:
        files.delete(old)
    return int(written.get["rows"])


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Write every table below ``root``; a table that fails is reported and the others still load.

    Gives ``(table_name, status, rows)``, status being ``loaded`` or the error class.
    """
    report = []
    for name, df in tables.items():
        try:
            report.append((name, "loaded", write_table(df, f"{root}/{name}")))
        except PySparkException as error:
            report.append((name, f"failed: {error.getCondition() or type(error).__name__}", None))
        except Py4JJavaError as error:  # raised by the storage layer
            report.append((name, f"failed: {error.java_exception.getClass().getSimpleName()}", None))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header and without an index, one file per task; blanks around values are kept."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """The ``line`` column as text, in order: part files hold consecutive ranges, none holds everything."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def print_tables(tables: Mapping[str, DataFrame], rows: int = 20) -> None:
    """Print the first rows of several result tables with their titles."""
    for title, df in tables.items():
        print(f"\n{title}:")
        df.show(rows, truncate=False)
