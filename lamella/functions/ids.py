"""Identifiers and canonical text forms that are functions of their input alone."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Before every name that becomes a row id.
PREFIX = "lamella"


def uuid5_url(name: Column) -> Column:
    """RFC 4122 version 5 id of a name in the URL namespace, as Python's uuid.uuid5 gives it."""
    digest = F.sha1(F.concat(F.lit(uuid.NAMESPACE_URL.bytes), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3))).bitwiseOR(F.lit(8))))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def row_id(source: Column, path: Column) -> Column:
    """The id of a record: a function of its source and relative path."""
    return uuid5_url(F.concat_ws(":", F.lit(PREFIX), source, path))


def canonical_json(columns: dict[str, Column]) -> Column:
    """One JSON object with sorted keys, no spaces and explicit nulls. Numbers must be whole; doubles print as Spark prints them."""
    return F.to_json(F.struct(*(columns[k].alias(k) for k in sorted(columns))), {"ignoreNullFields": "false"})


def object_hash(columns: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(columns), 256)


def python_canonical_json(value: object) -> str:
    """The same form for metadata objects on the driver; NaN is refused."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def python_object_hash(value: object) -> str:
    return hashlib.sha256(python_canonical_json(value).encode()).hexdigest()


def member_list_id(prefix: str, members: Column) -> Column:
    """prefix and 16 hex digits of the SHA-256 of the sorted member list, as an aggregate. It holds the list of one group;
    group_digest() needs no list."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.to_json(F.array_sort(F.collect_set(members))), 256), 1, 16))


def group_digest(prefix: str, members: Column) -> Column:
    """An id of a group that doesn't depend on order, from partial aggregates only: number, smallest member and the sum of
    48 bits of every member's SHA-256. Members must be distinct rows."""
    bits = F.conv(F.substring(F.sha2(members, 256), 1, 12), 16, 10).cast("decimal(20,0)")
    text = F.concat_ws("|", F.count("*").cast("string"), F.sum(bits).cast("decimal(38,0)").cast("string"), F.min(members))
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 16))
