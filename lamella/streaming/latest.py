"""The latest version of every key over a growing folder of append-only rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_appended(spark: SparkSession, folder: str, schema: StructType, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(folder)


def latest(stream: DataFrame, key: str, version: str) -> DataFrame:
    """key and the row of its highest version so far, in complete or update mode; state is one row for each key."""
    rest = [c for c in stream.columns if c != key]
    return stream.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(key, *(f"r.{c}" for c in rest))


def counts_by_window(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """window start, key, n; rows later than `late` are left out and the state of closed windows is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def keep_table(stream: DataFrame, key: str, version: str, path: str, checkpoint: str) -> StreamingQuery:
    """A Parquet table of the latest rows, replaced after every batch. Two folders take turns, so a reader always finds a
    whole one, and a repeated batch writes the same."""

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number % 2}")

    return latest(stream, key, version).writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint).start()
