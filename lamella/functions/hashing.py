"""Bit sets of 64 bits in BIGINT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (shift, bits) of three disjoint bands: of any two flipped bits at least one band stays untouched.
BANDS = ((0, 22), (22, 21), (43, 21))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def band(h: Column, index: int) -> Column:
    shift, bits = BANDS[index]
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1))


def is_informative(h: Column) -> Column:
    """Hashes with fewer than 4 or more than 60 bits set say nothing."""
    return F.bit_count(h).between(4, 60)


def hex64(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h), 16, "0"))


def falling_bits(values: list[Column]) -> Column:
    """Bit i, the highest first, says whether values[i] > values[i + 1]; at most 65 values."""
    acc = F.lit(0).cast("bigint")
    for a, b in zip(values, values[1:]):
        acc = F.shiftleft(acc, 1).bitwiseOR((a > b).cast("bigint"))
    return acc
