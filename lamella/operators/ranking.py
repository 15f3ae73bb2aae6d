"""Places within keys that may hold any part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.session import materialize


def places(df: DataFrame, key: str, order: list[Column], name: str = "place") -> DataFrame:
    """df with the place (from 1) of every row within its key. The order must be total.

    Rows are range-partitioned by key and order, so a key spreads over as many tasks as its rows need; a row's place is its
    place within its task plus the rows of its key in the tasks before, and only those counts go through a window.
    """
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    # Written once: positions are those of one and the same sort.
    sorted_ = materialize(ranged.withColumn("_task", F.shiftrightunsigned(at, 33)).withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))))
    same = F.col(key).eqNullSafe(F.col("_key"))
    held = sorted_.groupBy(F.col(key).alias("_key"), "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = held.withColumn("_before", F.sum("_n").over(Window.partitionBy("_key").orderBy("_task")) - F.col("_n"))
    joined = sorted_.join(before.withColumnRenamed("_task", "_held"), same & (F.col("_task") == F.col("_held")))
    return joined.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name))
