"""SimHash near-dedup by covering locality-sensitive hashing: no pair within the radius is missed."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import WORD, apart, map_texts, row_key, settled, unboxed, written

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: hashes that are counted at once
CHUNK = 1 << 16
#: edges in a file, and so in a task, while components are formed
EDGES_PER_FILE = 100_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 bits that are set in over half of the shingles' hashes; 0 without words."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    whole = " ".join(words).encode()
    ends = np.cumsum([0] + [len(w.encode()) + 1 for w in words]).tolist()
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(whole[a : b - 1], SEED) for a, b in zip(ends, ends[width:], strict=False)]
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = np.array(hashes[start : start + CHUNK], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def covering_masks(radius: int) -> list[int]:
    """2^(radius + 1) - 1 bit masks; any ``radius`` bits are all outside one of them.

    Every bit has a nonzero vector of radius + 1 binary digits, and the mask of a nonzero vector v holds the
    bits whose vector has an odd product with v. Up to ``radius`` bits span less than the whole space, so some
    v is orthogonal to all of them. The vectors take turns, which makes the masks equally large.
    """
    vectors = [1 + bit % (2 ** (radius + 1) - 1) for bit in range(BITS)]
    return [
        sum(1 << bit for bit, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


def patterns(outside: list[int], flips: int) -> list[int]:
    """All words with at most ``flips`` bits set among ``outside``."""
    found = {0}
    for _ in range(flips):
        found |= {value | 1 << bit for value in found for bit in outside}
    return sorted(found)


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Edges ``(a, b)``, b < a, that connect all distinct ``fp`` within ``radius`` bits of each other.

    Each table of the covering groups the fingerprints that agree under its mask. Those in a group differ only
    outside the mask, and two of them are within the radius exactly if words half the way from each coincide
    there. So a fingerprint with company in its group names all words up to half the radius away, and those
    that name the same word meet. At most 1 + 28 fingerprints can name a word when the radius is 2, so what
    meets is bounded, and rows grow with the fingerprints, never with their pairs.
    """
    masks = covering_masks(radius)
    under = [F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("part")) for i, m in enumerate(masks)]
    placed = prints.select("fp", F.explode(F.array(*under)).alias("at")).select("fp", "at.i", "at.part")
    company = placed.groupBy("i", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "part")
    candidates = placed.join(written(company), ["i", "part"])
    outside = [[bit for bit in range(BITS) if not m >> bit & 1] for m in masks]
    flips = F.array(*[F.array(*[F.lit(signed(p)) for p in patterns(bits, (radius + 1) // 2)]) for bits in outside])
    named = F.explode(F.transform(F.get(flips, F.col("i")), lambda p: p.bitwiseXOR(F.col("fp"))))
    meets = candidates.select("i", "fp", named.alias("word")).groupBy("i", "word").agg(F.collect_set("fp").alias("met"))
    groups = meets.where(F.size("met") > 1)
    if radius % 2:  # two steps of half an odd radius may reach one bit too far
        near = F.filter("met", lambda b: (b < F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= radius))
        pairs = groups.select(F.explode("met").alias("a"), "met").select("a", F.explode(near).alias("b"))
    else:
        pairs = groups.select(F.explode("met").alias("a"), F.array_min("met").alias("b")).where("a > b")
    return pairs.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges (a, b)``, b < a; the root is the smallest node.

    Stars are formed around ever smaller nodes until nothing changes: every node first hands its larger
    neighbours to its smallest one, then its smaller neighbours. Smallest neighbours are written before they
    are joined, so that the partition of a node with very many neighbours can be split. No step makes more
    edges than there were, so their number tells how many files the steps' tables need.
    """
    edges = settled(edges)
    files = 1 + edges.count() // EDGES_PER_FILE

    def kept(df: DataFrame) -> DataFrame:
        return written(df.coalesce(files))

    signature = None
    while True:
        for larger in (True, False):
            turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
            straight = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
            seen = turned.union(straight) if larger else straight
            least = kept(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
            if larger:
                moved = turned.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            else:
                moved = straight.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                moved = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            edges = kept(moved.where("a > b").distinct())
        before, signature = signature, edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == signature:
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    doc_id: str = "doc_id",
    text: str = "text",
    carried: Sequence[Column] = (),
) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` of every document.

    ``fp`` is the fingerprint as a signed 64-bit number, ``root`` the smallest fingerprint that links of up to
    ``radius`` bits reach, ``component_id`` the smallest id among the documents with those fingerprints, and
    ``text_key`` a hash of the text that tells rows with one id apart. Texts that are NULL or without words
    have fingerprint 0 and are linked like any other. NULL ids are never the smallest; a component of NULL ids
    alone has none. Repeated rows are kept; an empty table gives no rows; other columns are not looked at;
    ``carried`` ones come out behind the rest.
    """

    def work(texts: list[str | None]) -> dict[str, list]:
        return {"fp": [signed(fingerprint(t, shingle)) for t in texts]}

    kept = [F.col(f"`{doc_id}`").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("text_key")]
    marked = settled(map_texts(docs, [*kept, *carried], text, work, "fp long"))
    extra = marked.columns[2:-1]
    prints = settled(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    roots = settled(components(links(prints.select("fp"), radius)))
    placed = prints.join(roots, F.col("fp") == F.col("node"), "left").drop("node")
    # a class that is one fingerprint of one document needs no entry: the document is its own component
    shared = placed.where("root is not null or n > 1").withColumn("root", F.coalesce("root", "fp"))
    shared = settled(shared.select("fp", "root", "first_id"))
    smallest = shared.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = written(shared.select("fp", "root").join(written(smallest), "root").select(F.col("fp").alias("__fp"), "root", "component_id"))
    joined = marked.join(classes, F.col("fp") == F.col("__fp"), "left")
    return joined.select(
        "doc_id",
        "text_key",
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        *extra,
    )


def hex_print(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, NULL ids last.

    Of rows with that id the smallest text hash stays, of those the smallest hash of the row, and of equal rows
    one. Texts move once, to meet the kept rows' keys; rows that others equal are reduced to one before.
    """
    found = near_duplicates(docs, shingle, radius, doc_id, text, row_key(docs))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "__low", "__high")
    kept = written(found.groupBy("root").agg(F.min(order).alias("kept")).select("kept.__low", "kept.__high"))
    counted = found.groupBy("__low", "__high").agg(F.count(F.lit(1)).alias("__rows"))
    single, several = apart(docs, written(counted.where("__rows > 1").select("__low", "__high")))
    return single.unionByName(several).join(kept, ["__low", "__high"]).select(*unboxed(docs, "__doc"))
