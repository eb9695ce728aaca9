"""Benchmark decontamination by Wu-Manber search: words of documents that stand in windows of benchmark items."""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import map_texts, written

#: consecutive words of an item that make a window; an item of fewer is one window
WIDTH = 10
#: words of a block in the shift table
BLOCK = 3
#: words of an item that are kept together; longer items are cut into pieces that overlap by a window less a word
PIECE = 10_000
#: characters of benchmark words that a worker searches for at once; a larger benchmark takes several passes
AT_ONCE = 16_000_000
#: UTF-8 bytes of a word, after A-Z became a-z
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


class WindowTable:
    """Wu-Manber tables of windows with one width: where the search may skip to, and what it must compare.

    ``shift`` tells by the hash of the last words read how far the search can go on without missing a window;
    different blocks may share an entry, which then holds the smaller shift. Where it is 0, the windows that end
    in such a block are in one bucket, in the order of the hash of all their words, and those with the hash of
    the words read are compared word by word.
    """

    def __init__(self, pieces: list[list[bytes]], owners: list[int], width: int) -> None:
        self.width, self.block = width, min(BLOCK, width)
        self.words: list[bytes] = []
        starts, owner, ends, shifts, suffixes, wholes = [], [], [], [], [], []
        for piece, item in zip(pieces, owners, strict=True):
            first = len(self.words)
            self.words += piece
            for end in range(self.block, len(piece) + 1):
                ends.append(hash(tuple(piece[end - self.block : end])))
                shifts.append(max(0, width - end))
            for start in range(len(piece) - width + 1):
                starts.append(first + start)
                owner.append(item)
                suffixes.append(hash(tuple(piece[start + width - self.block : start + width])))
                wholes.append(hash(tuple(piece[start : start + width])))
        self.mask = (1 << (4 * len(ends) + 1).bit_length()) - 1
        shift = np.full(self.mask + 1, width - self.block + 1, np.uint8)
        np.minimum.at(shift, np.array(ends, np.int64) & self.mask, np.array(shifts, np.uint8))
        self.shift = shift.tobytes()
        places, wholes = np.array(suffixes, np.int64) & self.mask, np.array(wholes, np.int64)
        order = np.lexsort((wholes, places))
        self.bucket = memoryview(np.concatenate([[0], np.cumsum(np.bincount(places, minlength=self.mask + 1))]))
        self.wholes = memoryview(wholes[order])
        self.starts = memoryview(np.array(starts, np.int64)[order])
        self.owner = memoryview(np.array(owner, np.int64)[order])

    def search(self, words: list[bytes], spans: list[tuple[int, int]], items: set[int]) -> None:
        """Add to ``spans`` and ``items`` where windows occur in ``words``, and whose they are."""
        width, block, mask, shift, bucket = self.width, self.block, self.mask, self.shift, self.bucket
        end, length = width, len(words)
        while end <= length:
            place = hash(tuple(words[end - block : end])) & mask
            step = shift[place]
            if step:
                end += step
                continue
            read = words[end - width : end]
            whole = hash(tuple(read))
            last = bucket[place + 1]
            at, found = bisect_left(self.wholes, whole, bucket[place], last), False
            while at < last and self.wholes[at] == whole:
                start = self.starts[at]
                if self.words[start : start + width] == read:
                    items.add(self.owner[at])
                    found = True
                at += 1
            if found:
                spans.append((end - width, end))
            end += 1


class Patterns:
    """The tables of all widths for some pieces ``(item, words joined by spaces)``."""

    def __init__(self, pieces: list[tuple[str, str]]) -> None:
        self.items = sorted({item for item, _ in pieces})
        number = {item: i for i, item in enumerate(self.items)}
        by_width: dict[int, tuple[list[list[bytes]], list[int]]] = {}
        for item, joined in pieces:
            words = joined.encode().split(b" ")
            held, owners = by_width.setdefault(min(WIDTH, len(words)), ([], []))
            held.append(words)
            owners.append(number[item])
        self.tables = [WindowTable(held, owners, width) for width, (held, owners) in by_width.items()]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Runs of words inside windows, in order and apart, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for table in self.tables:
            table.search(words, spans, items)
        runs: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if runs and start <= runs[-1][1]:
                runs[-1] = runs[-1][0], max(end, runs[-1][1])
            else:
                runs.append((start, end))
        return runs, [self.items[i] for i in sorted(items)]


#: the tables that a worker made last, by the name of the pass
_made: dict[str, Patterns] = {}


def benchmark_pieces(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, words``: the words of every item, joined by spaces, in distinct pieces that hold all its windows."""
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), UPPER, LOWER)
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"),
        F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("found"),
    ).where(F.size("found") > 0)
    last = F.greatest(F.lit(0), F.size("found") - WIDTH)
    cut = items.select("item", "found", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE))).alias("at"))
    piece = F.slice("found", F.col("at") + 1, F.lit(PIECE + WIDTH - 1))
    return cut.select("item", F.array_join(piece, " ").alias("words")).distinct()


def scan(docs: DataFrame, pieces: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text_key, n_words, starts, ends, items`` by one pass over ``docs``; the pieces are a bounded table."""
    name = uuid.uuid4().hex
    patterns = docs.sparkSession.sparkContext.broadcast([(r["item"], r["words"]) for r in pieces.collect()])

    def work(texts: list[str | None]) -> dict[str, list]:
        from cartrail.llm import decontaminate  # the module of the worker, which outlives a task

        made = decontaminate._made
        if name not in made:
            made.clear()
            made[name] = decontaminate.Patterns(patterns.value)
        found: dict[str, list] = {"n_words": [], "starts": [], "ends": [], "items": []}
        for held in texts:
            words = decontaminate.split_words(held)
            runs, items = made[name].search(words)
            found["n_words"].append(len(words))
            found["starts"].append([a for a, _ in runs])
            found["ends"].append([b for _, b in runs])
            found["items"].append(items)
        return found

    content = F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    kept = [F.col(f"`{doc_id}`").alias("doc_id"), content.alias("text_key")]
    return map_texts(docs, kept, text, work, "n_words long, starts array<int>, ends array<int>, items array<string>")


def merged(runs: str) -> Column:
    """Runs in order, those that touch or overlap made one."""
    last = "element_at(done, -1)"
    grown = f"named_struct('a', {last}.a, 'b', greatest({last}.b, run.b))"
    joined = f"concat(slice(done, 1, size(done) - 1), array({grown}))"
    step = f"if(size(done) > 0 and run.a <= {last}.b, {joined}, concat(done, array(run)))"
    return F.expr(f"aggregate(array_sort({runs}), cast(array() as array<struct<a:int,b:int>>), (done, run) -> {step})")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    at_once: int = AT_ONCE,
) -> DataFrame:
    """``doc_id, text_key, n_words, starts, ends, items`` of every document.

    ``starts`` and ``ends`` are the runs of its words inside windows of the benchmark, counted from 0, the end
    exclusive; ``items`` the items whose windows occur, sorted as strings. Items go by their id: rows that share
    one are one item, NULL ids are the item ``null``. NULL texts have no words; an item without words has no
    window. Repeated rows of ``docs`` are kept; empty tables give no rows, or no hits; other columns are not
    looked at.

    The benchmark's words are spread to all workers, ``at_once`` characters for a pass, so neither the driver
    nor a worker holds more; beyond, the documents are read once for each such part, and what the parts found
    in a document is put together by id and text hash.
    """
    pieces = written(benchmark_pieces(benchmark, item_id, item_text))
    length = pieces.agg(F.sum(F.length("words"))).first()[0] or 0
    parts = 1 + length // at_once
    if parts == 1:
        return scan(docs, pieces, doc_id, text)
    turn = F.pmod(F.xxhash64("item", "words"), F.lit(parts))
    found = None
    for part in range(parts):
        one = written(scan(docs, pieces.where(turn == part), doc_id, text).withColumn("part", F.lit(part)))
        found = one if found is None else found.union(one)
    # equal rows find the same, so a part needs them once with their number
    same = ["doc_id", "text_key"]
    once = found.groupBy(*same, "part").agg(
        F.count(F.lit(1)).alias("rows"), *[F.max(c).alias(c) for c in ("n_words", "starts", "ends", "items")]
    )
    zipped = F.transform(F.arrays_zip("starts", "ends"), lambda z: F.struct(z["starts"].alias("a"), z["ends"].alias("b")))
    whole = once.groupBy(*same).agg(
        F.max("rows").alias("rows"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list(zipped)).alias("runs"),
        F.flatten(F.collect_list("items")).alias("items"),
    )
    whole = whole.withColumn("runs", merged("runs")).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    items = F.array_sort(F.array_distinct("items"))
    return whole.select(*same, "n_words", F.col("runs.a").alias("starts"), F.col("runs.b").alias("ends"), items.alias("items"))


def hit_words(starts: str = "starts", ends: str = "ends") -> Column:
    """How many words the runs hold."""
    return F.expr(f"aggregate({ends}, 0L, (n, x) -> n + x) - aggregate({starts}, 0L, (n, x) -> n + x)")
