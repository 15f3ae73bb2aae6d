"""The pN_ queries: callables of (spark, folder with the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lamella.llm import components, history, leaks, names, oracles, spam, splits, survivors, tokenize


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return history.duplicate_pairs(_table(spark, folder, "images"))


def p1_latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    return history.latest_batch(_table(spark, folder, "images"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return components.linked_groups(_table(spark, folder, "images"), _table(spark, folder, "near_pairs"))


def p4_leakage_groups(spark: SparkSession, folder: str) -> DataFrame:
    return components.leakage_groups(_table(spark, folder, "images"), _table(spark, folder, "near_pairs"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    chosen = survivors.selection(survivors.surviving_fields(_table(spark, folder, "deliveries")))
    return chosen.filter("exclusion_reason is not null").select("image_id", "canonical_image_id", "exclusion_reason")


def p3_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return survivors.surviving_records(_table(spark, folder, "deliveries"))


def p3_source_quality(spark: SparkSession, folder: str) -> DataFrame:
    return survivors.source_quality(_table(spark, folder, "deliveries"))


def p3_judged(spark: SparkSession, folder: str) -> DataFrame:
    chosen = survivors.selection(survivors.judged_fields(_table(spark, folder, "deliveries")))
    return chosen.filter("exclusion_reason is not null").select("image_id", "canonical_image_id", "exclusion_reason")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return splits.torn_groups(_table(spark, folder, "split_manifest"))


def p5_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.grouped_split(_table(spark, folder, "split_manifest"))


def p5_split_check(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_check(_table(spark, folder, "split_manifest"))


def p5_balance(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_report(_table(spark, folder, "split_manifest"))


def p5_balance_by_contributor(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_report(_table(spark, folder, "split_manifest"), relations=("contributor",))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenize.token_ids(_table(spark, folder, "documents"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return spam.spam_pages(_table(spark, folder, "documents"))


def p8_curves(spark: SparkSession, folder: str) -> DataFrame:
    return spam.page_curves(_table(spark, folder, "documents"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p7_reparameterised(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.reparameterised(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.mapped_labels(_table(spark, folder, "taxon_labels"), _table(spark, folder, "taxon_reference"))


def p2_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return names.unmatched_labels(_table(spark, folder, "taxon_labels"), _table(spark, folder, "taxon_reference"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_latest_batch": p1_latest_batch,
        "p3_found": p3_found,
        "p3_survivors": p3_survivors,
        "p3_source_quality": p3_source_quality,
        "p3_judged": p3_judged,
        "p4_found": p4_found,
        "p4_leakage_groups": p4_leakage_groups,
        "p5_found": p5_found,
        "p5_split": p5_split,
        "p5_split_check": p5_split_check,
        "p5_balance": p5_balance,
        "p5_balance_by_contributor": p5_balance_by_contributor,
        "p6_ids": p6_ids,
        "p8_found": p8_found,
        "p8_curves": p8_curves,
        "p7_found": p7_found,
        "p7_reparameterised": p7_reparameterised,
        "p2_found": p2_found,
        "p2_unmatched": p2_unmatched,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
