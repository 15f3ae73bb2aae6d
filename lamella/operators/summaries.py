"""Counts over a catalog or an inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import paths


def counts_by(df: DataFrame, *dimensions: str) -> DataFrame:
    """dimension, value, n for several columns in one pass; NULL counts as `unspecified`, arrays by element."""
    kinds = dict(df.dtypes)

    def values(d: str):
        if kinds[d].startswith("array"):
            return F.transform(F.coalesce(d, F.array().cast("array<string>")), lambda v: F.struct(F.lit(d).alias("dimension"), v.cast("string").alias("value")))
        return F.array(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("unspecified")).alias("value")))

    return df.select(F.explode(F.concat(*map(values, dimensions))).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def rank_values(df: DataFrame) -> DataFrame:
    """rank, label, n over the three ranks, with label NULL for records without one."""
    ranks = F.array(*(F.struct(F.lit(r).alias("rank"), F.col(c).alias("label")) for r, c in (("group", "taxon_group"), ("genus", "genus"), ("species", "species"))))
    return df.select(F.explode(ranks).alias("x")).groupBy("x.rank", "x.label").agg(F.count("*").alias("n"))


def catalog_summary(records: DataFrame) -> DataFrame:
    """source_id (NULL for all), images, selected, excluded, unique_hashes, leakage_groups: totals and sources in one plan."""
    return records.rollup("source_id").agg(
        F.count("*").alias("images"),
        F.count_if(F.col("selection_status") == "included").alias("selected"),
        F.count_if(F.col("selection_status") != "included").alias("excluded"),
        F.count_distinct("sha256").alias("unique_hashes"),
        F.count_distinct("leakage_group_id").alias("leakage_groups"),
    )


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """collection, folder, images, bytes: by the folder a file lies in."""
    return inventory.groupBy("collection", paths.parent(F.col("path")).alias("folder")).agg(F.count("*").alias("images"), F.sum("bytes").alias("bytes"))


def joined_names(df: DataFrame, key: str, value: str, separator: str = " | ") -> DataFrame:
    """key, names: the sorted distinct values of a key in one text."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), separator).alias("names"))


def policy_counts(records: DataFrame, policies: DataFrame) -> DataFrame:
    """source_id, expected, actual, complete: usage policies (source_id, license, attribution, expected_images) held against
    the records of each source."""
    actual = records.groupBy("source_id").agg(F.count("*").alias("actual"))
    named = lambda c: F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
    return actual.join(policies, "source_id", "left").select(
        "source_id", F.col("expected_images").alias("expected"), "actual",
        (named("license") & named("attribution") & F.coalesce(F.col("expected_images") == F.col("actual"), F.lit(False))).alias("complete"),
    )
