"""The catalog records of the images table, their fields written alike, one row for each record_no."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions.digests import hash64, sha256_hex


def records(images: DataFrame) -> DataFrame:
    """image_id is the record's number: records that arrived again are records of their own here."""
    return images.select(
        F.col("record_no").cast("string").alias("image_id"),
        F.col("image_id").alias("entity_id"),
        "record_no", "source_id", "relative_path",
        sha256_hex(F.col("sha256")).alias("sha256"),
        sha256_hex(F.col("pixel_sha256")).alias("pixel_sha256"),
        F.col("lossless_transform_sha256"),
        hash64(F.col("perceptual_dhash64")).alias("dhash"),
        "frame_count", "candidate_groups", "import_flags", "relationship_keys", "lineage", "leakage_group_id", "selection_status",
        F.lit(None).cast("string").alias("genus"), F.lit(None).cast("string").alias("species"), F.lit(None).cast("string").alias("canonical_image_id"),
    )


def sha_sql(column: str) -> str:
    """The same digests in SQL: hex digits in any dress, or the 44 characters of base64 (either alphabet)."""
    value = rf"regexp_replace(regexp_replace({column}, '^\s*sha-?256\s*[:=-]', '', 'i'), '\s', '', 'g')"
    digits = f"replace(replace(lower({value}), ':', ''), '-', '')"
    return (
        f"CASE WHEN regexp_full_match({digits}, '[0-9a-f]{{64}}') THEN {digits} "
        f"WHEN regexp_full_match({value}, '[A-Za-z0-9+/_-]{{42}}[AEIMQUYcgkosw048]=?') "
        f"THEN lower(hex(from_base64(rpad(replace(replace({value}, '-', '+'), '_', '/'), 44, '=')))) END"
    )


#: The hash without what is written around its digits.
BARE_HASH = r"regexp_replace(regexp_replace(lower(perceptual_dhash64), '^\s*0x', ''), '[\s:_-]', '', 'g')"
RECORDS_SQL = f"""
    rec0 AS (SELECT record_no, image_id, source_id, relative_path, {sha_sql('sha256')} AS sha256, {sha_sql('pixel_sha256')} AS pixel_sha256,
        lossless_transform_sha256, {BARE_HASH} AS h, frame_count, candidate_groups FROM images),
    rec AS (SELECT record_no, source_id, relative_path, sha256, pixel_sha256, lossless_transform_sha256, frame_count, candidate_groups,
        CASE WHEN regexp_full_match(h, '[0-9a-f]{{16}}') THEN ('0x' || h)::UBIGINT
             WHEN regexp_full_match(h, '[01]{{64}}') THEN h::BIT::UBIGINT END AS dhash FROM rec0)"""
