"""Columns for digests, perceptual hashes and identifiers that are not written alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for "nothing recorded" in a reference, key or lineage value.
EMPTY_WORDS = ("", "-", "?", "n/a", "none", "unknown", "not recorded")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body uses it and wherever the plan moves it."""
    return F.transform(F.array(value), body).getItem(0)


def stripped(text: Column) -> Column:
    """Without white space at either end (tabs and line ends too), lower case."""
    return F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))


def sha256_hex(text: Column) -> Column:
    """64 lower-case hex digits of a SHA-256 however it is written: hex (case, blanks, `sha256:` or `SHA-256=` before it,
    colons between bytes) or base64 of the 32 bytes (both alphabets, padded or not); NULL where it is missing, cut off or
    no digest."""
    value = F.regexp_replace(text, r"(?i)^\s*sha-?256\s*[:=-]|\s", "")

    def read(v: Column) -> Column:
        bare = F.lower(F.regexp_replace(v, "[:-]", ""))
        # The last of 43 digits carries four bits, so its two low ones are zero.
        coded = F.concat(F.rtrim(F.translate(v, "-_", "+/"), F.lit("=")), F.lit("="))
        return F.when(F.length(v) >= 64, F.when(bare.rlike("^[0-9a-f]{64}$"), bare)).when(
            v.rlike("^[A-Za-z0-9+/_-]{42}[AEIMQUYcgkosw048]=?$"), F.lower(F.hex(F.unbase64(coded)))
        )

    return let(value, read)


def hash64(text: Column) -> Column:
    """A 64-bit hash as BIGINT from 16 hex digits (`0x` before them, a hyphen or blanks among them) or 64 binary digits;
    NULL where it is missing or cut off."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), r"^\s*0x", ""), r"[\s:_-]", "")
    return let(
        bare,
        lambda b: F.when(b.rlike("^[0-9a-f]{16}$"), F.conv(b, 16, -10).cast("bigint")).when(b.rlike("^[01]{64}$"), F.conv(b, 2, -10).cast("bigint")),
    )


def named(text: Column) -> Column:
    """An identifier without case and surrounding blanks; NULL where it names nothing."""
    return let(stripped(text), lambda b: F.when(~b.isin(*EMPTY_WORDS), b))


def wide_key(text: Column, *more: Column) -> Column:
    """A 128-bit key for joins on long strings: two independent 64-bit hashes."""
    return F.struct(F.xxhash64(text, *more).alias("k1"), F.xxhash64(F.lit("lamella"), *more, text).alias("k2"))
