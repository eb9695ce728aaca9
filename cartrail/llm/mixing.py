"""Mixing sources to target weights by hash-random keys, prefix sums and exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartrail.llm.common import apart, hash_key, multiplied, row_key, running_totals, settled, unboxed, words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in code point order, NULL last, take the weights in turn and split ``share`` times all words by
    weight. A target stops at ``epochs`` times its source, and what is over goes to the others by weight until
    none is above. Sources sorted by size for weight reach that limit in this order, so the common level
    follows from two running sums; there is one row per source, a list of mixing weights, not of data.
    """
    turn = Window.orderBy(F.col("source").isNull(), "source")
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(turn) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.get(wheel, place)).withColumn("most", F.col("source_size") * float(epochs))
    everything = Window.partitionBy(F.lit(1))
    by_level = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    pull = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    level = weighted.withColumn("level", left / pull).withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
    # the first source that is not full meets the common level; later ones compute lower figures
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full") | common.isNull(), F.col("most")).otherwise(common * F.col("weight"))
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = "mix",
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    carried: Sequence[Column] = (),
) -> DataFrame:
    """How many words the mix takes of every document: ``doc_id, source, text_key, size, source_size, target, taken``.

    Every document gets a hash-random key from its id and text. Sorted by it, the documents of a source fill
    whole epochs of the source and then the rest of its budget; the document at the cut gives only the words
    up to it, so a source takes ``floor(target)`` words exactly. Equal rows are told apart by nothing, and it
    does not matter which of them is cut. NULL or empty texts have size 0 and are taken with 0 words; NULL ids
    and sources are values like others; an empty table gives no rows. Other columns are not looked at;
    ``carried`` ones come out behind the rest.
    """
    content = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    sized = settled(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            content.alias("text_key"),
            F.size(words(F.col(f"`{text}`"))).cast("long").alias("size"),
            *carried,
        ).withColumn("key", hash_key(seed, F.col("doc_id"), F.col("text_key")))
    )
    extra = sized.columns[4:-1]
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # budgets are one row per source, as many as the caller's list of weights is meant for
    budget = settled(targets(totals, weights, share, epochs)).withColumnRenamed("source", "__source")
    summed = running_totals(sized, "source", "key", "size", ["doc_id", "size", "text_key"])
    told = summed.join(budget, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    words_due = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(words_due / F.col("source_size")).cast("long")).otherwise(F.lit(0))
    rest = words_due - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(rest - F.col("before"), F.col("size")))
    taken = (whole * F.col("size") + part).cast("long")
    return told.select("doc_id", "source", "text_key", "size", "source_size", "target", taken.alias("taken"), *extra)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it.

    A text is never cut here: the document at a budget's end goes in whole when at least half of it is inside.
    Documents without words add nothing to a mix and are not in it. Texts move once, to meet their row's number
    of copies; of equal rows one does.
    """
    taken = mix(docs, **options, carried=row_key(docs))
    whole = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("long")
    wanted = F.sum(F.when(F.col("size") > 0, whole).otherwise(F.lit(0)))
    # equal rows share their copies; one row of each is multiplied
    counted = settled(taken.groupBy("__low", "__high").agg(wanted.alias("__all"), F.count(F.lit(1)).alias("__rows")))
    single, several = apart(docs, counted.where("__rows > 1").select("__low", "__high"))
    due = counted.where("__all > 0").drop("__rows")
    twice = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__all")))
    few = single.join(due, ["__low", "__high"]).withColumn("__turn", twice)
    many = multiplied(several.join(due, ["__low", "__high"]), "__all", "__low")
    return few.unionByName(many).select(*unboxed(docs, "__doc"))
