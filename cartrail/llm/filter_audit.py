"""Filter interaction audit: a word of surviving subsets for each document, counted by carry-save popcounts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import ship, words, written

FILTERS = "ABCDE"
SUBSETS = 2 ** len(FILTERS)
#: which documents are counted: all, those labelled as good, those labelled as toxic
COUNTED = ("documents", "good", "toxic")
#: rows of counts that a task holds before it hands them on
HELD_ROWS = 20_000


def survival_words() -> np.ndarray:
    """By the mask of the filters that a document fails: the word whose bit S says that it survives the subset S."""
    masks = np.arange(SUBSETS)
    alive = (masks[:, None] & masks[None, :]) == 0
    return (alive.astype(np.uint64) << np.arange(SUBSETS, dtype=np.uint64)).sum(axis=1).astype(np.uint32)


def positional_counts(words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """For each group and bit position, in how many of the group's 32-bit words the bit is set.

    Three words of one weight become one of that weight and one of the double weight, as a carry-save adder
    does with each of their bits; all groups step together, until at most two words of each weight are left.
    """
    counts = np.zeros((groups, 32), np.int64)
    place, weight = np.arange(32, dtype=np.uint32), 1
    while len(words):
        carried, carried_group = [], []
        while True:
            order = np.argsort(group, kind="stable")
            words, group = words[order], group[order]
            sizes = np.bincount(group, minlength=groups)
            if sizes.max() < 3:
                break
            within = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            tripled = within < np.repeat(sizes // 3 * 3, sizes)
            a, b, c = words[tripled].reshape(-1, 3).T
            owner = group[tripled][::3]
            half = a ^ b
            carried.append(a & b | half & c)
            carried_group.append(owner)
            words = np.concatenate([words[~tripled], half ^ c])
            group = np.concatenate([group[~tripled], owner])
        np.add.at(counts, group, (words[:, None] >> place & 1).astype(np.int64) * weight)
        words = np.concatenate(carried) if carried else words[:0]
        group = np.concatenate(carried_group) if carried else group[:0]
        weight *= 2
    return counts


def failed_mask(text: Column, copied: Column) -> Column:
    """The filters that a text fails, as bits in the order of ``FILTERS``; ``copied`` says whether it fails E."""
    content = F.coalesce(text, F.lit(""))
    found = words(text)
    capitals = F.length(F.regexp_replace(content, "[^A-Z]+", ""))
    fails = [
        F.size(found) < 200,
        100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
        100 * capitals > 2 * F.length(content),
        F.rlike(content, F.lit(r"[#$%&*|]")),
        copied,
    ]
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))


def marked(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, failed, good, toxic`` of every document; only ids, hashes and masks are shuffled.

    Texts are told apart by their SHA-256. An id is good or toxic if any of its labels says so.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(content, 256)).alias("content"),
        failed_mask(F.col(f"`{text}`"), F.lit(False)).cast("int").alias("failed"),
    )
    rows = written(rows)  # texts are read once
    # texts with one id only can't be copies, so the table of first ids is as long as there are repeated texts
    firsts = rows.groupBy("content").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    firsts = written(firsts.where("first_id < last_id").select(F.col("content").alias("__content"), "first_id"))
    told = labels.groupBy(F.col("doc_id").alias("__id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    told = written(told.where("__id is not null and (good or toxic)"))
    joined = rows.join(firsts, F.col("content") == F.col("__content"), "left").join(told, F.col("doc_id") == F.col("__id"), "left")
    copied = F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False))
    return joined.select(
        "part",
        F.col("failed").bitwiseOR(F.when(copied, SUBSETS // 2).otherwise(0)).alias("failed"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def survivors(rows: DataFrame) -> DataFrame:
    """``part, documents, good, toxic`` from ``part, failed, good, toxic``: the last three are arrays.

    Entry S of an array says how many documents of the part survive the subset S of the filters. A task adds up
    its own rows and hands on three arrays for each part that it met.
    """
    ship(rows.sparkSession)
    table = survival_words()

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            arrays = [pa.array(list(held), pa.string())]
            for i in range(len(COUNTED)):
                arrays.append(pa.array([counts[i].tolist() for counts in held.values()], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(arrays, ["part", *COUNTED])

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).dictionary_encode()
            group = parts.indices.to_numpy(zero_copy_only=False)
            alive = table[batch.column(1).to_numpy(zero_copy_only=False)]
            chosen = [slice(None), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))]
            counts = [positional_counts(alive[which], group[which], len(parts.dictionary)) for which in chosen]
            for name, found in zip(parts.dictionary.to_pylist(), np.stack(counts, axis=1), strict=True):
                held[name] = held[name] + found if name in held else found
            if len(held) >= HELD_ROWS:
                yield out()
                held.clear()
        if held:
            yield out()

    kinds = ", ".join(f"{name} array<long>" for name in COUNTED)
    partial = rows.select("part", "failed", "good", "toxic").mapInArrow(per_task, f"part string, {kinds}")
    sums = [F.sum(F.get(name, F.lit(s))).alias(f"{name}_{s}") for name in COUNTED for s in range(SUBSETS)]
    whole = partial.groupBy("part").agg(*sums)
    return whole.select("part", *[F.array(*[f"{name}_{s}" for s in range(SUBSETS)]).alias(name) for name in COUNTED])


def shapley(bit: int) -> Column:
    """What the filter removes in all orders together, from the array ``documents`` of survivors.

    A set of filters stands before this one in (its size)! times (the size of the rest)! of the orders.
    """
    terms = []
    for before in range(SUBSETS):
        if not before >> bit & 1:
            size = before.bit_count()
            orders = factorial(size) * factorial(len(FILTERS) - 1 - size)
            removed = F.get("documents", F.lit(before)) - F.get("documents", F.lit(before | 1 << bit))
            terms.append(removed * F.lit(orders))
    return sum(terms[1:], terms[0])


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """What each filter does at each step of each order, by part: one row per part, order and step.

    Columns: ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.
    The filters are those of ``failed_mask``; E fails a text that a smaller id has, too. NULL texts are empty.
    A NULL id is smaller than none and has no labels; rows that share the smallest id of a text all pass E. NULL
    parts and empty ones are one part, the empty string. Repeated rows count each; an empty table gives no
    rows; without labels nothing is good or toxic; other columns are not looked at. The orders are the same
    for every part, so the result has 600 rows per part, made from 96 sums.
    """
    parts = written(survivors(marked(docs, labels, doc_id, text, part)))
    with_shapley = parts.withColumn("__shapley", F.array(*[shapley(bit) for bit in range(len(FILTERS))]))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    each = with_shapley.withColumn("filter_order", F.explode(orders))
    each = each.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = "ascii(substring(filter_order, {}, 1)) - ascii('A')"
    mask = f"aggregate(transform(sequence(1, step), i -> shiftleft(1, {place.format('i')})), 0, (a, b) -> a | b)"
    each = each.withColumn("bit", F.expr(place.format("step"))).withColumn("through", F.expr(mask))
    own = F.expr("shiftleft(1, bit)")
    each = each.withColumn("own", own).withColumn("earlier", F.col("through").bitwiseXOR(own))

    def alive(which: str, subset: Column | str) -> Column:
        return F.get(which, F.col(subset) if isinstance(subset, str) else subset)

    def lost(which: str) -> Column:
        return alive(which, "earlier") - alive(which, "through")

    everyone, every = alive("documents", F.lit(0)), F.lit(SUBSETS - 1)
    return each.select(
        "part",
        "filter_order",
        "step",
        alive("documents", "through").alias("kept"),
        lost("documents").alias("removed"),
        (everyone - alive("documents", "own") - lost("documents")).alias("redundant"),
        (alive("documents", every.bitwiseXOR(F.col("own"))) - alive("documents", every)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("__shapley", F.col("bit")).alias("shapley"),
    )
