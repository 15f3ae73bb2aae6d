"""Session helpers: a tuned local session, and cutting lineage in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold for every size; partition counts are left to AQE.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lamella").config("spark.driver.memory", memory)
    for key, value in {**SESSION_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset and driver and executors are
    one process (tests). On a cluster a folder of the driver's machine would be none of the executors', so it is an error."""
    context = spark.sparkContext._jsc.sc()
    stored = context.getCheckpointDir()
    if stored.isDefined():
        return stored.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="lamella-"))
    return context.getCheckpointDir().get()


def shared_path(spark: SparkSession, prefix: str = "lamella") -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete what has been written to path when the driver ends."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write df once as Parquet into the shared folder and return the table read back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation. The table is removed when the driver ends,
    or earlier by release().
    """
    spark = df.sparkSession
    path = shared_path(spark)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    remove_at_end(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table._lamella_path = path
    return table


def release(table: DataFrame | None) -> None:
    """Delete a table made by materialize() that nothing reads any more."""
    path = getattr(table, "_lamella_path", None)
    if path:
        spark = table.sparkSession
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
