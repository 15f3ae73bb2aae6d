"""A CSV of group assignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators.checks import ViolationError, orphans, repeated, require, violations
from lamella.operators.labels import SPLITS


def read_assignments(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """leakage_group_id, split. The header must be exactly these two in this order (a byte order mark is passed over); ragged
    rows, unknown or repeated groups and other partitions raise."""
    header = spark.read.text(path).limit(1).collect()
    if not header or header[0][0].lstrip("﻿").strip() != "leakage_group_id,split":
        raise ViolationError("the header must be leakage_group_id,split")
    rows = spark.read.schema("leakage_group_id STRING, split STRING, _bad STRING").option("header", True).option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").csv(path)
    require(rows.cache().filter("_bad is not null").select("_bad"), "malformed rows")
    rows = rows.drop("_bad")
    require(violations(rows, ["leakage_group_id"], {"split": F.col("split").isin(*SPLITS), "leakage_group_id": F.length("leakage_group_id") > 0}), "assignments")
    require(repeated(rows, "leakage_group_id"), "repeated groups")
    require(orphans(rows, "leakage_group_id", known, "leakage_group_id"), "unknown groups")
    return rows
