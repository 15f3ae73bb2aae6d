"""An acquisition tree: its CSV inventory, the files that lie there, and how the two cover each other."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import paths
from lamella.operators.checks import ViolationError, repeated, require, violations
from lamella.sources.schemas import INVENTORY

#: Collection -> (source, folder its images lie in).
COLLECTIONS = {"01_tgfc": ("tgfc", "extracted"), "02_idphy_microscopy": ("idphy", "images"), "03_soil_fungi_phytophthora": ("soil", "images")}
#: Endings of image files.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".tif", ".tiff", ".bmp", ".gif")


def collections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, s, f) for c, (s, f) in COLLECTIONS.items()], "collection string, source_id string, folder string")


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    """The rows of image_inventory.csv with their source, typed; bad rows, repeated paths, missing columns and an empty file raise."""
    path = f"{root}/image_inventory.csv"
    # Columns are found by name, so order and further columns do not matter.
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    missing = set(INVENTORY) - set(raw.columns)
    if missing:
        raise ViolationError(f"the inventory lacks {sorted(missing)}")
    rows = raw.select(*(F.col(f).cast("string") for f in INVENTORY))
    known = rows.join(F.broadcast(collections(spark)), "collection", "left")
    number = lambda c: F.col(c).try_cast("bigint") > 0
    bad = violations(
        known,
        ["path"],
        {
            "unknown_collection": F.col("source_id").isNotNull(),
            "unsafe_path": paths.is_safe(F.col("path")),
            "path_outside_collection": F.col("path").startswith(F.concat_ws("/", "collection", "folder", F.lit(""))),
            "bytes": number("bytes"), "width": number("width"), "height": number("height"),
            "sha256": F.col("sha256").rlike(r"\A[0-9a-f]{64}\z"),
        },
    )
    require(bad, "inventory")
    require(repeated(rows, "path"), "repeated inventory paths")
    if rows.isEmpty():
        raise ViolationError("the inventory is empty")
    return known.select("collection", "source_id", "path", *(F.col(c).cast("bigint").alias(c) for c in ("bytes", "width", "height")), "sha256", "format").orderBy("path")


def files(spark: SparkSession, root: str, folder: str = "", content: bool = False) -> DataFrame:
    """path (relative), length and, if asked for, content of all files below root/folder. Without content only listings are read."""
    base = os.path.abspath(f"{root}/{folder}") if "://" not in root else f"{root}/{folder}"
    prefix = os.path.abspath(root) if "://" not in root else root.rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    bare = F.substring_index(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), prefix + "/", -1)
    return found.select(bare.alias("path"), "length", *(["content"] if content else []))


def empty_files(spark: SparkSession, root: str, folder: str = "") -> DataFrame:
    """path of the files without a byte below root/folder: scans pass over them, so they are found by listing (on the driver,
    which holds only these names)."""
    base = os.path.abspath(root)
    found = [(os.path.relpath(p, base),) for d, _, names in os.walk(os.path.join(base, folder)) for n in names if os.path.getsize(p := os.path.join(d, n)) == 0]
    return spark.createDataFrame(found, "path string")


def image_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length of the image files of all collections."""
    listed = None
    for name, (_, folder) in COLLECTIONS.items():
        part = files(spark, root, f"{name}/{folder}").select("path", "length").unionByName(empty_files(spark, root, f"{name}/{folder}").withColumn("length", F.lit(0).cast("bigint")))
        listed = part if listed is None else listed.unionByName(part)
    return listed.filter(paths.suffix(F.col("path")).isin(*IMAGE_SUFFIXES))


def coverage(inventory: DataFrame, listed: DataFrame) -> DataFrame:
    """path, side: paths that only the inventory (`missing`) or only the folder (`unlisted`) has."""
    a = inventory.select("path", F.lit(True).alias("in_inventory"))
    b = listed.select("path", F.lit(True).alias("on_disk"))
    return a.join(b, "path", "full_outer").filter("in_inventory is null or on_disk is null").select("path", F.when(F.col("on_disk").isNull(), "missing").otherwise("unlisted").alias("side"))


def changed_files(inventory: DataFrame, read: DataFrame) -> DataFrame:
    """path, code of files whose size or digest is not the inventory's; the first that differs is named. read: files(content=True)."""
    joined = inventory.select("path", "bytes", "sha256").join(read.select("path", "length", F.sha2("content", 256).alias("actual")), "path", "left")
    return joined.select(
        "path", F.when(F.col("length").isNull(), "missing").when(F.col("length") != F.col("bytes"), "size_changed").when(F.col("actual") != F.col("sha256"), "checksum_changed").alias("code")
    ).filter("code is not null")
