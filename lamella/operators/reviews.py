"""Append-only, versioned rows: the latest of each, gates over them, and counts of what they exclude."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions.flags import flags_where
from lamella.functions.taxa import GROUPS

#: Dispositions of a review.
DISPOSITIONS = ("eligible_single_group", "mixed", "unresolved", "no_target_visible", "unusable", "out_of_scope")


def latest(df: DataFrame, key: str, version: str, *tie: str) -> DataFrame:
    """The row of the highest version of every key; ties by the highest of `tie`. Partial aggregation, no window."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(version, *tie)).alias("r"))
    return best.select(key, *(f"r.{c}" for c in rest))


def review_constraints() -> dict[str, Column]:
    """What must hold for each review row."""
    c = F.col
    trimmed = lambda n: (F.length(F.trim(n)) > 0) & (F.trim(n) == c(n))
    return {
        "image_id": trimmed("image_id"),
        "annotator_id": trimmed("annotator_id"),
        "reviewer_id": trimmed("reviewer_id"),
        "image_sha256": c("image_sha256").rlike(r"\A[0-9a-f]{64}\z"),
        "annotation_version": c("annotation_version") > 0,
        "review_status": c("review_status") == "adjudicated",
        "disposition": c("disposition").isin(*DISPOSITIONS),
        "visible_evidence": c("visible_evidence").isNotNull(),
        "usage_approved": c("usage_approved").isNotNull(),
        "scope_approved": c("scope_approved").isNotNull(),
    }


def exclusion_reasons(reviewed: Column) -> Column:
    """The ordered reasons that keep a record out, of its latest review's columns; reviewed says whether it has one."""
    blank = lambda c: F.coalesce(F.length(F.trim(c)) == 0, F.lit(True))
    redundant = F.when(F.col("selection_status") == "excluded_redundant", F.array(F.concat(F.lit("redundant:"), "exclusion_reason"))).otherwise(F.array().cast("array<string>"))
    gate = F.concat(
        F.array_compact(F.array(F.when(F.col("disposition") != "eligible_single_group", F.concat(F.lit("disposition:"), "disposition")))),
        flags_where(
            {
                "unsupported_or_missing_group": ~F.coalesce(F.col("group_label").isin(*GROUPS), F.lit(False)),
                "missing_visible_evidence": blank(F.col("visible_evidence")),
                "usage_not_approved": ~F.coalesce("usage_approved", F.lit(False)),
                "missing_usage_permission_ref": blank(F.col("usage_permission_ref")),
                "scope_not_approved": ~F.coalesce("scope_approved", F.lit(False)),
            }
        ),
    )
    return F.concat(redundant, F.when(reviewed, gate).otherwise(F.array(F.lit("unreviewed"))))


def histogram(df: DataFrame, values: str, name: str = "reason") -> DataFrame:
    """name, n over an array column."""
    return df.select(F.explode(values).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: str, column: str, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """row, column, n with zeros: rows and columns are the two vocabularies (a few values each); only they are crossed."""
    counted = df.groupBy(row, column).agg(F.count("*").alias("n"))
    grid = rows.select(row).distinct().crossJoin(columns.select(column).distinct())
    return grid.join(counted, [row, column], "left").select(row, column, F.coalesce("n", F.lit(0)).alias("n"))
