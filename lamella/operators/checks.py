"""Constraints, references and equality of relations as tables of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import flags, paths
from lamella.functions.taxa import GROUPS, hierarchy_violations


class ViolationError(ValueError):
    """An input does not satisfy its contract; the message holds the first violations."""


def violations(df: DataFrame, keys: list[str], constraints: dict[str, Column]) -> DataFrame:
    """keys, code: one row for each constraint that does not hold (NULL counts as not holding). One pass, no shuffle."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in constraints.items())))
    return df.select(*keys, F.explode(broken).alias("code"))


def require(found: DataFrame, what: str, shown: int = 5) -> None:
    """Raise with the first rows of a table of violations, if it has any."""
    rows = found.limit(shown).collect()
    if rows:
        raise ViolationError(f"{what}: " + "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that occur more than once, with n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is not NULL and is not among the parents."""
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a missing in b (`-`) and rows of b missing in a (`+`), with their numbers, in column `side`. Columns that
    cannot be compared (maps) go in as sorted JSON."""

    def comparable(df: DataFrame) -> DataFrame:
        cols = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            cols.append((F.to_json(F.array_sort(F.map_entries(c))) if f.dataType.typeName() == "map" else c).alias(f.name))
        return df.select(*cols)

    a, b = comparable(a), comparable(b.select(*a.columns))
    signed = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
    # One aggregation finds both directions, duplicates included.
    return (
        signed.groupBy(*a.columns).agg(F.sum("side").alias("d")).filter("d <> 0")
        .select(*a.columns, F.when(F.col("d") > 0, "-").otherwise("+").alias("side"), F.abs("d").alias("n"))
    )


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return difference(a, b).isEmpty()


def canonical_reference_violations(records: DataFrame) -> DataFrame:
    """image_id, code: canonical ids that do not exist or name an excluded record (a self-join)."""
    targets = records.select(F.col("image_id").alias("canonical_image_id"), F.col("selection_status").alias("target_status")).distinct()
    joined = records.filter("canonical_image_id is not null").select("image_id", "canonical_image_id").join(targets, "canonical_image_id", "left")
    return joined.select(
        "image_id", F.when(F.col("target_status").isNull(), "unknown_canonical_image_id").when(F.col("target_status") == "excluded_redundant", "canonical_image_is_excluded").alias("code")
    ).filter("code is not null")


HEX64, HEX16 = r"\A[0-9a-f]{64}\z", r"\A[0-9a-f]{16}\z"
#: Closed vocabularies of a record.
SOURCES = ("tgfc", "idphy", "soil")
STATUSES = ("included", "excluded_redundant")
REASONS = ("exact_file_duplicate", "exact_pixel_duplicate", "lossless_transform_duplicate")
ROLES = ("full_field", "crop", "unknown")


def record_constraints() -> dict[str, Column]:
    """What must hold for each record of a catalog."""
    c = F.col
    excluded = c("selection_status") == "excluded_redundant"
    return {
        "image_id": F.length(F.trim("image_id")) > 0,
        "source_id": c("source_id").isin(*SOURCES),
        "relative_path": paths.is_normal(c("relative_path")),
        "sha256": c("sha256").rlike(HEX64),
        "pixel_sha256": c("pixel_sha256").isNull() | c("pixel_sha256").rlike(HEX64),
        "lossless_transform_sha256": c("lossless_transform_sha256").isNull() | c("lossless_transform_sha256").rlike(HEX64),
        "perceptual_dhash64": c("perceptual_dhash64").isNull() | c("perceptual_dhash64").rlike(HEX16),
        "bytes": c("bytes") > 0,
        "width_px": c("width_px") > 0,
        "height_px": c("height_px") > 0,
        "frame_count": c("frame_count") >= 1,
        "selection_status": c("selection_status").isin(*STATUSES),
        "exclusion_reason": F.when(excluded, c("exclusion_reason").isin(*REASONS)).otherwise(c("exclusion_reason").isNull()),
        "canonical_image_id": ~excluded | F.coalesce(c("canonical_image_id") != c("image_id"), F.lit(False)),
        "image_role": c("image_role").isin(*ROLES),
        "candidate_groups": flags.is_unique(c("candidate_groups")) & F.forall("candidate_groups", lambda g: g.isin(*GROUPS)),
        "relationship_keys": flags.is_unique(c("relationship_keys")),
        "import_flags": flags.is_unique(c("import_flags")),
    }


def taxa_violations(records: DataFrame, key: str, taxa: str = "taxa") -> DataFrame:
    """key, source_label, code of every taxon whose ranks do not fit each other."""
    return records.select(key, F.explode(taxa).alias("t")).select(key, "t.source_label", F.explode(hierarchy_violations(F.col("t"))).alias("code"))


def eligibility_violations(records: DataFrame, eligible: DataFrame, policies: DataFrame | None = None) -> DataFrame:
    """image_id, code of images (image_id) that may not go into a split of publisher labels: unknown or repeated ones, and
    records that are excluded, have several frames, more or other than one known group, a label conflict, or a review already.
    policies (source_id, license, attribution, expected_images, required_image_role), if given, add sources without
    permission and images of another role than their source's; a source whose number of images is not the expected one has a
    row of its id."""
    c = F.col
    rules = {
        "excluded": c("selection_status") == "included",
        "frame_count": c("frame_count") == 1,
        "candidate_groups": (F.size("candidate_groups") == 1) & F.get("candidate_groups", F.lit(0)).isin(*GROUPS),
        "duplicate_label_conflict": ~F.array_contains(F.coalesce("import_flags", F.array().cast("array<string>")), "duplicate_label_conflict"),
    }
    if "review_status" in records.columns:
        rules["reviewed"] = c("review_status") == "unreviewed"
    if "group_label" in records.columns:
        rules["group_label"] = c("group_label").isNull()
    chosen = records.join(eligible.select("image_id").distinct(), "image_id", "left_semi")
    found = [
        orphans(eligible.select("image_id"), "image_id", records, "image_id").distinct().select("image_id", F.lit("unknown").alias("code")),
        repeated(eligible.select("image_id"), "image_id").select("image_id", F.lit("repeated").alias("code")),
    ]
    if policies is not None:
        named = lambda x: F.length(F.trim(x)) > 0
        chosen = chosen.join(policies.select("source_id", "license", "attribution", "expected_images", "required_image_role"), "source_id", "left")
        rules["permission"] = named("license") & named("attribution")
        rules["image_role"] = c("required_image_role").isNull() | (c("image_role") == c("required_image_role"))
        counted = chosen.groupBy("source_id").agg(F.count("*").alias("n"), F.first("expected_images").alias("expected"))
        found.append(counted.filter(~F.coalesce(c("n") == c("expected"), F.lit(False))).select(c("source_id").alias("image_id"), F.lit("expected_images").alias("code")))
    out = violations(chosen, ["image_id"], rules)
    for more in found:
        out = out.unionByName(more)
    return out
