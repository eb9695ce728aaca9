"""Which rows may have one of some keys: a Bloom filter as a plain expression, so rows that can't don't move.

The filter is an array of 64-bit words of a bounded size, whatever the number of keys: with too many keys it only lets
more rows through, and what it lets through is always looked at exactly.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits for a key, and bits of a filter at least and at most; three bits are set for each key
BITS_A_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 10, 1 << 20
_PROBES = 3


@dataclass(frozen=True)
class KeyFilter:
    """The words of a filter, as many as a power of two."""

    words: tuple[int, ...]

    def may_contain(self, *key: Column) -> Column:
        """False only for keys that the filter never saw; true now and then for others."""
        if not any(self.words):
            return F.lit(False)
        held = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        found = F.lit(True)
        for bit in _bits(key, 64 * len(self.words)):
            word = F.get(held, F.shiftright(bit, 6).cast("int"))
            mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
            found = found & (word.bitwiseAND(mask) != 0)
        return found


def _bits(key: Sequence[Column], size: int) -> list[Column]:
    """Places in a filter of ``size`` bits, from separate digits of one hash."""
    hashed, digits = F.xxhash64(*key), size.bit_length() - 1
    return [F.shiftrightunsigned(hashed, digits * i).bitwiseAND(F.lit(size - 1)) for i in range(_PROBES)]


def key_filter(keys: DataFrame) -> KeyFilter:
    """The filter of all rows of ``keys``, a stored table; at most ``MOST_BITS / 64`` words come to the driver."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_KEY * keys.count()).bit_length()))
    bits = keys.select(F.explode(F.array(*_bits([F.col(f"`{c}`") for c in keys.columns], size))).alias("bit"))
    bit = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    words = [0] * (size // 64)
    for row in bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return KeyFilter(tuple(words))
