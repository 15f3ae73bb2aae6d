"""Equivalence of records, their canonical ones, and near duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import flags, hashing


def equivalence_key(frame_count: Column, file_hash: Column, lossless_hash: Column) -> Column:
    """What two records must share to be equivalent: the file where there are several frames (the first may be all they share),
    else the image up to flips and rotations. NULL agrees with nothing."""
    return F.when(frame_count == 1, F.concat(F.lit("l:"), lossless_hash)).otherwise(F.concat(F.lit("b:"), file_hash))


def clusters(records: DataFrame) -> DataFrame:
    """group_key, canonical_image_id, members, conflict, and the canonical record's hashes. records: image_id, relative_path,
    sha256, pixel_sha256, lossless_transform_sha256, frame_count, candidate_groups, genus, species.

    Only mergeable aggregates, so an image with a billion copies is one row after the map side. Labels conflict where
    there are different candidate lists, or different genera or species; a missing one contradicts nothing.
    """
    keyed = records.withColumn("group_key", equivalence_key(F.col("frame_count"), F.col("sha256"), F.col("lossless_transform_sha256"))).filter("group_key is not null")
    groups = F.to_json("candidate_groups")
    differ = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    first = F.min(F.struct("relative_path", "image_id", "sha256", "pixel_sha256"))
    return keyed.groupBy("group_key").agg(
        first.alias("f"), F.count("*").alias("members"), (differ(groups) | differ(F.col("genus")) | differ(F.col("species"))).alias("conflict")
    ).select(
        "group_key", F.col("f.image_id").alias("canonical_image_id"), "members", "conflict", F.col("f.sha256").alias("canonical_sha256"), F.col("f.pixel_sha256").alias("canonical_pixel")
    )


def curate(records: DataFrame) -> DataFrame:
    """records with canonical_image_id, selection_status, exclusion_reason and label_conflict in place of what they held."""
    derived = ("canonical_image_id", "selection_status", "exclusion_reason", "label_conflict")
    kept = [c for c in records.columns if c not in derived]
    keyed = records.select(*kept, equivalence_key(F.col("frame_count"), F.col("sha256"), F.col("lossless_transform_sha256")).alias("group_key"))
    found = clusters(records).filter("members > 1")
    other = F.col("canonical_image_id") != F.col("image_id")
    return keyed.join(found, "group_key", "left").select(
        *kept,
        F.coalesce("canonical_image_id", "image_id").alias("canonical_image_id"),
        F.when(other, "excluded_redundant").otherwise("included").alias("selection_status"),
        F.when(
            other,
            F.when(F.col("sha256") == F.col("canonical_sha256"), "exact_file_duplicate")
            .when(F.col("pixel_sha256") == F.col("canonical_pixel"), "exact_pixel_duplicate")
            .otherwise("lossless_transform_duplicate"),
        ).alias("exclusion_reason"),
        F.coalesce("conflict", F.lit(False)).alias("label_conflict"),
    )


def cluster_report(curated: DataFrame) -> DataFrame:
    """canonical_image_id, image_ids (by path), source_labels_conflict, excluded: a report of clusters of two or more. It
    lists members, so its rows are as long as clusters are large; curate() needs no list."""
    return (
        curated.groupBy("canonical_image_id")
        .agg(
            F.transform(F.sort_array(F.collect_list(F.struct("relative_path", "image_id", "exclusion_reason"))), lambda m: F.struct(m["image_id"].alias("image_id"), m["exclusion_reason"].alias("reason"))).alias("m"),
            F.bool_or("label_conflict").alias("source_labels_conflict"),
        )
        .filter(F.size("m") > 1)
        .select(
            "canonical_image_id",
            F.transform("m", lambda m: m["image_id"]).alias("image_ids"),
            "source_labels_conflict",
            F.filter("m", lambda m: m["reason"].isNotNull()).alias("excluded"),
        )
    )


def hash_groups(df: DataFrame, digest: str, member: str) -> DataFrame:
    """digest, n, first_member of every digest that more than one row has."""
    return df.filter(F.col(digest).isNotNull()).groupBy(digest).agg(F.count("*").alias("n"), F.min(member).alias("first_member")).filter("n > 1")


def near_pairs(df: DataFrame, key: str, h: str, distance: int = 2) -> DataFrame:
    """key_a < key_b, distance: all pairs of informative hashes at most `distance` (2 or less) bits apart.

    Distinct hashes meet on three disjoint bands, of which two flipped bits leave one untouched; each pair is kept on the
    first band it shares, so no distinct follows. Rows are joined back to the pairs of hashes afterwards.
    """
    if distance > 2:
        raise ValueError("three bands find distances up to 2 only")
    rows = df.select(F.col(key).alias("key"), F.col(h).alias("h")).filter(hashing.is_informative(F.col("h")))
    distinct = rows.select("h").distinct()
    bands = F.array(*(F.struct(F.lit(i).cast("tinyint").alias("i"), hashing.band(F.col("h"), i).alias("v")) for i in range(len(hashing.BANDS))))
    keyed = distinct.select("h", F.explode(bands).alias("b")).select("h", "b.i", "b.v")
    a, b = keyed.alias("a"), keyed.alias("b")
    same = [hashing.band(F.col("a.h"), i) == hashing.band(F.col("b.h"), i) for i in range(len(hashing.BANDS))]
    first = F.when(same[0], F.lit(0)).when(same[1], F.lit(1)).otherwise(F.lit(2))
    close = a.join(
        b,
        (F.col("a.i") == F.col("b.i")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.h") < F.col("b.h"))
        & (hashing.hamming(F.col("a.h"), F.col("b.h")) <= distance) & (F.col("a.i") == first),
    ).select(F.col("a.h").alias("h1"), F.col("b.h").alias("h2"), hashing.hamming(F.col("a.h"), F.col("b.h")).alias("distance"))
    different = (
        close.join(rows.select(F.col("key").alias("k1"), F.col("h").alias("h1")), "h1")
        .join(rows.select(F.col("key").alias("k2"), F.col("h").alias("h2")), "h2")
        .select(F.least("k1", "k2").alias("key_a"), F.greatest("k1", "k2").alias("key_b"), F.col("distance").cast("bigint").alias("distance"))
    )
    x, y = rows.alias("x"), rows.alias("y")
    equal = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.key") < F.col("y.key"))).select(
        F.col("x.key").alias("key_a"), F.col("y.key").alias("key_b"), F.lit(0).cast("bigint").alias("distance")
    )
    return equal.unionByName(different)


def flag_near(records: DataFrame, pairs: DataFrame, key: str = "image_id", name: str = "near_duplicate_candidate") -> DataFrame:
    """records whose import_flags hold `name` exactly where the key stands in a pair (key_a, key_b); idempotent."""
    found = pairs.select(F.explode(F.array("key_a", "key_b")).alias(key)).distinct().withColumn("in_pair", F.lit(True))
    joined = records.join(found, key, "left")
    bare = flags.drop_flags(F.col("import_flags"), name)
    return joined.withColumn("import_flags", F.when(F.col("in_pair"), flags.add_flags(bare, {name: F.lit(True)})).otherwise(bare)).drop("in_pair").select(*records.columns)
