"""Sorted sets of flags in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _empty(flags: Column) -> Column:
    return F.coalesce(flags, F.array().cast("array<string>"))


def flags_where(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in the order given."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in conditions.items())))


def add_flags(flags: Column, conditions: dict[str, Column]) -> Column:
    return F.array_sort(F.array_union(_empty(flags), flags_where(conditions)))


def drop_flags(flags: Column, *names: str) -> Column:
    return F.array_sort(F.array_except(_empty(flags), F.array(*(F.lit(n) for n in names))))


def sorted_set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(_empty(values)))


def is_unique(values: Column) -> Column:
    return F.size(values) == F.size(F.array_distinct(values))


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0
