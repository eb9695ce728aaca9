"""What the operators share: words, settled tables, Arrow maps, and running totals over a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartrail.operators.membership import key_filter

#: a word is a run of anything but a blank and the control characters tab to carriage return
WORD = r"[^\x20\x09-\x0D]+"
#: hexadecimal digits of an MD5 that make an ordering key: 52 bits, exact in a double
KEY_DIGITS = 13
#: texts that a Python worker holds as strings at a time
TEXTS_AT_ONCE = 256
#: copies of a row that one task makes
RUN = 1 << 16


#: folders made for local sessions that name none, by application
_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local session without one gets a folder in /tmp.

    On a cluster a machine-local folder would lose data, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    application = spark.sparkContext.applicationId
    if application not in _own_dirs:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own_dirs[application] = tempfile.mkdtemp(prefix="cartrail-")
    return _own_dirs[application]


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that Spark knows its size when it plans a join.

    A small table is then broadcast and a large one shuffled, by the session's own threshold.
    """
    path = f"{shared_dir(df.sparkSession)}/cartrail-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable where Python runs on executors, once an application.

    Needed only where the package is a folder that the executors' Python doesn't search; a package that was
    given to Spark as a zip file is there already.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    _shipped.add(context.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="cartrail-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def words(text: Column) -> Column:
    """The words of a text in order; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def boxed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that names an operator adds can't clash with them."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns])


def unboxed(docs: DataFrame, box: str, replace: dict[str, str] | None = None) -> list[Column]:
    """The columns of ``docs`` out of the struct column ``box``; ``replace`` names other columns for some."""
    replace = replace or {}
    return [
        (F.col(replace[name]) if name in replace else F.col(f"{box}.`{name}`")).alias(name) for name in docs.columns
    ]


def map_texts(
    docs: DataFrame, kept: Sequence[Column], text: str, work: Callable[[list[str | None]], dict[str, list]], made: str
) -> DataFrame:
    """``kept`` columns of ``docs`` beside what ``work`` makes of the texts of a batch, one value per text.

    ``made`` is the schema of the new columns, in the order of the dictionary that ``work`` returns. Rows are
    neither moved nor reordered.
    """
    ship(docs.sparkSession)
    chosen = docs.select(*kept, F.col(f"`{text}`").cast("string").alias("__text"))
    schema = chosen.drop("__text").limit(0)
    for field in made.split(","):
        name, kind = field.split()
        schema = schema.withColumn(name, F.lit(None).cast(kind))
    out = schema.schema

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(start, TEXTS_AT_ONCE)
                columns = [batch.column(i) for i in range(batch.num_columns - 1)]
                found = work(batch.column(batch.num_columns - 1).to_pylist())
                fields = [target.field(len(columns) + i) for i in range(len(found))]
                columns += [pa.array(values, type=f.type) for f, values in zip(fields, found.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=target.names)

    return chosen.mapInArrow(per_batch, out)


def hash_key(*parts: Column | str) -> Column:
    """A number below 2^52 from the MD5 of the parts; it depends on their values only, so reruns agree."""
    text = F.concat_ws(":", *[F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, KEY_DIGITS), 16, 10).cast("long")


def row_key(docs: DataFrame) -> list[Column]:
    """``__low, __high``: 128 bits of a whole row, as two numbers. Equal rows have equal ones, NULL is a value."""
    cells = [F.to_json(F.col(f"`{c}`")) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    missing = [cell.isNull() for cell in cells]
    return [F.xxhash64(F.lit(name), *cells, *missing).alias(name) for name in ("__low", "__high")]


def apart(docs: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` as ``__low, __high, __doc``: the rows that no other row equals, and every other distinct row once.

    ``repeated`` is a stored table of the keys of rows that occur more than once. Those are reduced to one inside
    each task before they move, however many they are; the others stay where they are. A row that the filter of
    the keys lets through by chance is among the second ones, once as well.
    """
    keyed = docs.select(*row_key(docs), boxed(docs).alias("__doc"))
    may_repeat = key_filter(repeated).may_contain(F.col("__low"), F.col("__high"))
    several = keyed.where(may_repeat).groupBy("__low", "__high").agg(F.first("__doc").alias("__doc"))
    return keyed.where(~may_repeat), several


def multiplied(rows: DataFrame, times: str, by: str) -> DataFrame:
    """Every row as often as its column ``times`` says, 1 at least, with ``__turn`` from 0.

    Rows are dealt out by ``by`` in runs of copies first, so that a row with very many copies is no single task's.
    """
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(RUN).cast("long")))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__run", runs).repartition(tasks, by, "__run")
    last = F.least(F.col("__run") + RUN, F.col(times)) - 1
    return dealt.withColumn("__turn", F.explode(F.sequence(F.col("__run"), last))).drop("__run")


def running_totals(rows: DataFrame, group: str, key: str, amount: str, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``before``: the sum of ``amount`` over the earlier rows of the group, by ``key`` and ``ties``.

    ``key`` is spread evenly over [0, 2^52). A group is cut by ranges of the key into as many pieces as the
    square root of all rows, so neither a piece nor the list of pieces gets long, however hot a group is:
    pieces are summed first, their sums added up within a group, and rows only within a piece. Equal rows
    are one row with a number until they have their place, so a piece is short however often a row is repeated.
    """
    pieces = max(1, int(rows.count() ** 0.5))
    names = [f"`{c}`" for c in rows.columns]
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__equal"))
    cut = counted.withColumn("__piece", F.floor(F.col(key) / F.lit(float(2 ** (4 * KEY_DIGITS))) * pieces).cast("long"))
    together = F.col(amount) * F.col("__equal")
    sums = cut.groupBy(group, "__piece").agg(F.sum(together).alias("__sum"))
    ahead = Window.partitionBy(group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(group).alias("__group"),
        F.col("__piece").alias("__at"),
        F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(group, "__piece").orderBy(key, *ties, *names).rowsBetween(Window.unboundedPreceding, -1)
    joined = cut.join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__piece") == F.col("__at")))
    placed = joined.withColumn("__first", F.col("__start") + F.coalesce(F.sum(together).over(inside), F.lit(0)))
    each = multiplied(placed, "__equal", key)
    before = (F.col("__first") + F.col("__turn") * F.col(amount)).cast("long")
    return each.select(*names, before.alias("before"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
