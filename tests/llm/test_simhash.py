"""SimHash near-dedup against all pairs."""

import itertools
import random
import re

import pytest
import xxhash

from cartrail.llm import simhash
from tests.llm import messy


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """By fingerprint: the smallest one that links reach."""
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(root, 2):
        if (a ^ b).bit_count() <= radius:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {p: top(p) for p in root}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_some_mask_misses_any_few_bits(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    bits = range(64) if radius < 3 else range(0, 64, 3)
    for chosen in itertools.combinations(bits, radius):
        assert any(not any(m >> b & 1 for b in chosen) for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, radius):
    pick = random.Random(radius)
    prints = set()
    for _ in range(12):
        value = pick.getrandbits(64)
        for _ in range(12):  # walks, so that components are wider than the radius
            prints.add(value)
            for _ in range(pick.randint(1, 4)):
                value ^= 1 << pick.randrange(64)
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(df, radius).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= radius and b < a for a, b in edges)
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, radius)).collect()}
    groups, plain = {}, {}
    for p in prints:
        groups.setdefault(found.get(simhash.signed(p), simhash.signed(p)), set()).add(p)
    for p, r in plain_components(prints, radius).items():
        plain.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_messy_documents(spark):
    docs = messy.documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    texts = messy.rows()
    roots = plain_components({plain_fingerprint(t[1]) for t in texts})
    smallest = {}
    for t in texts:
        r = roots[plain_fingerprint(t[1])]
        smallest[r] = min((i for i in (t[0], smallest.get(r)) if i is not None), default=None)
    expected = sorted(((t[0], simhash.signed(plain_fingerprint(t[1])), smallest[roots[plain_fingerprint(t[1])]]) for t in texts), key=repr)
    assert sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in rows), key=repr) == expected
    assert simhash.near_duplicates(messy.no_documents(spark)).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots.values()))
    assert simhash.one_of_each(messy.no_documents(spark)).count() == 0


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000 + i, 999) for i in range(1, 200)], "a long, b long")
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert all(found[i] == 0 for i in range(301)) and all(found[1000 + i] == 999 for i in range(1, 200))
