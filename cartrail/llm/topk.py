"""Exact top-k by inner product: a KD-tree per shard, searched best first with the k-th score handed on."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartrail.llm.common import settled, ship

K = 20
#: vectors of a shard and queries of a block, at most twice as many of each; what one task holds at a time
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
LEAF_ROWS = 128
#: sums of products below the first are exact in a double, and below the second in 64 bits
EXACT, LARGEST = float(2**53), float(2**63)
#: stands for no k-th score yet
NO_FLOOR = -(2**63)


class KDTree:
    """Median splits along the widest side; every node has the tight box of its vectors."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> None:
        self.vectors = vectors
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        #: by node: its children, or the rows of a leaf
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        waiting = [(np.arange(len(vectors)), -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            node = len(self.rows)
            inside = vectors[rows]
            low, high = inside.min(axis=0), inside.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.children.append(None)
            self.rows.append(None)
            if parent >= 0:
                pair = self.children[parent]
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            widest = int(np.argmax(high - low)) if len(low) else 0
            if len(rows) <= leaf_rows or not len(low) or high[widest] == low[widest]:
                self.rows[node] = np.sort(rows)
                continue
            order = np.argpartition(inside[:, widest], len(rows) // 2)
            self.children[node] = (-1, -1)
            waiting.append((rows[order[: len(rows) // 2]], node, 0))
            waiting.append((rows[order[len(rows) // 2 :]], node, 1))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every query and node the highest inner product that a point of the node's box can have."""
        low, high = np.array(self.low), np.array(self.high)
        return _fitted(np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T)


def _order(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by falling score, ties by rising id; no number is negated, as the least long can't be."""
    return np.lexsort((~ids, scores))[::-1]


def search(tree: KDTree, ids: np.ndarray, query: np.ndarray, own: int, bounds: np.ndarray, k: int, floor: float | int):
    """Scores and ids of the up to ``k`` best rows for one query, without the id ``own``; ties to smaller ids.

    Nodes are opened in the order of their bounds. ``floor`` is a k-th score known from other shards: a node
    whose bound is below it, or below the k-th score found here, has nothing to add, nor have later ones. A
    bound equal to it may still hide a tie.
    """
    bounds = bounds.tolist()  # Python's numbers: the least long has no negative
    scores, found = np.empty(0, np.int64 if query.dtype == object else query.dtype), np.empty(0, np.int64)
    waiting = [(-bounds[0], 0)]
    while waiting:
        bound, node = heapq.heappop(waiting)
        if -bound < floor:
            break
        if (pair := tree.children[node]) is not None:
            for child in pair:
                if bounds[child] >= floor:
                    heapq.heappush(waiting, (-bounds[child], child))
            continue
        rows = tree.rows[node]
        here = _fitted(tree.vectors[rows] @ query)
        good = (here >= floor) & (ids[rows] != own)
        if not good.any():
            continue
        scores, found = np.concatenate([scores, here[good]]), np.concatenate([found, ids[rows][good]])
        if len(scores) >= k:
            best = _order(scores, found)[:k]
            scores, found = scores[best], found[best]
            floor = max(floor, scores[-1])
    best = _order(scores, found)[:k]
    return scores[best], found[best]


def quantised(embedding: Column) -> Column:
    """``floor(64 * x)`` of every component, as doubles, which are whole numbers; large ones are so already."""

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * 64
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(embedding, whole)


def usable(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _integer(x: float) -> int | float:
    """Twice a component near the largest double is no double; such a one counts as the largest."""
    return int(min(max(x, -sys.float_info.max), sys.float_info.max))


def _fitted(scores: np.ndarray) -> np.ndarray:
    """Scores as they are reported: Python's integers as 64-bit ones, the nearest where they don't fit."""
    return np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64) if scores.dtype == object else scores


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), len(column.iloc[0]))


def _searched(k: int):
    schema = "query_id long, ask long, vec_id long, score long"

    def search_shard(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            held = held.sort_values("held_vec_id", kind="stable")
            ids, vectors, asked = held["held_vec_id"].to_numpy(), _matrix(held["held_v"]), _matrix(queries["v"])
            reach = np.abs(asked).sum(axis=1).max(initial=0) * np.abs(vectors).max(initial=0)
            if not reach < LARGEST:  # Python's integers, which have no end
                vectors, asked = (np.vectorize(_integer, otypes=[object])(m) for m in (vectors, asked))
            elif reach >= EXACT:
                vectors, asked = vectors.astype(np.int64), asked.astype(np.int64)
            tree = KDTree(vectors)
            floors = queries["floor"].to_numpy()
            every = tree.bounds(asked)
            owns, asks = queries["query_id"].to_numpy(), queries["ask"].to_numpy()
            for i, own in enumerate(owns):
                scores, found = search(tree, ids, asked[i], own, every[i], k, floors[i])
                made = np.full(len(found), own), np.full(len(found), asks[i]), found, scores.astype(np.int64)
                out.append(np.stack(made, axis=1))
        return pd.DataFrame(np.concatenate([np.empty((0, 4), np.int64), *out]), columns=["query_id", "ask", "vec_id", "score"])

    return search_shard, schema


def _best(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id", "ask").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    k: int = K,
    every: int = 20,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its ``k`` best others.

    The score is the inner product of the vectors with components ``floor(64 x)``, higher is better, ties to
    the smaller id. Rows are dealt by a hash into shards of about ``shard_rows``, and the queries into
    blocks. Each query is searched first in one shard; the k-th score found there is handed on to the search of
    the others, where it cuts off whole branches. A task holds one shard and one block. NULL vectors, vectors
    with NULL or non-finite components and rows with a NULL id take no part. Vectors are compared with those of
    their length only. Rows that repeat an id with another vector are candidates of their own, but never of a
    query with their id; a repeated query row asks once, and one with another vector asks for itself. A score that
    does not fit a long is the nearest one that does, and ties with others like it. A component that 64 times is no
    finite double is the largest one. Empty tables give no rows; other columns are not looked at.
    """
    ship(vectors.sparkSession)
    ident, vector = F.col(f"`{vec_id}`").cast("long"), F.col(f"`{embedding}`")
    held = vectors.where(usable(vector) & ident.isNotNull()).select(ident.alias("vec_id"), quantised(vector).alias("v"))
    held = settled(held.withColumn("length", F.size("v")))
    asked = held.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", "length").distinct()
    asked = asked.withColumn("ask", F.xxhash64("query_id", "v"))
    shards = max(1, round(held.count() / shard_rows))
    blocks = max(1, round(asked.count() / block_rows))
    # a number of the row as well, so that rows which repeat an id, or all of a row, are dealt out; the table is
    # settled, so the numbers stay
    hashed = F.xxhash64("vec_id", F.monotonically_increasing_id())
    spread = held.withColumn("shard", F.pmod(hashed, F.lit(shards)).cast("int"))
    asked = settled(asked.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit("block")), F.lit(blocks)).cast("int")))
    # every block meets every shard once; rows of a shard are repeated for each block, a twentieth as many
    copies = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = copies.toDF(*[f"held_{c}" for c in copies.columns])
    home = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int")
    at = ["length", "shard", "block"]
    work, schema = _searched(k)
    first = asked.withColumn("shard", home).withColumn("floor", F.lit(NO_FLOOR))
    near = settled(first.groupBy(*at).cogroup(copies.groupBy(*[f"held_{c}" for c in at])).applyInPandas(work, schema))
    # the k-th best of the first shard; a query that found fewer there has no bound yet
    floors = _best(near, k).where(F.col("rank") == k).select(F.col("ask").alias("__ask"), F.col("score").alias("floor"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
    later = asked.join(floors, F.col("ask") == F.col("__ask"), "left").withColumn("shard", F.explode(others))
    floor = F.coalesce("floor", F.lit(NO_FLOOR)).alias("floor")
    far = later.select("query_id", "v", "length", "ask", "block", "shard", floor)
    rest = far.groupBy(*at).cogroup(copies.groupBy(*[f"held_{c}" for c in at])).applyInPandas(work, schema)
    return _best(near.union(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
