"""Declared schemas, as DDL; nothing is inferred."""

from __future__ import annotations

SCHEMA_VERSION = "3.0"


#: Columns of a CSV inventory; it is read as text, and types are checked as constraints.
INVENTORY = ("collection", "path", "bytes", "sha256", "width", "height", "format")
DOWNLOAD = (
    "source_id STRING, filename STRING, bytes BIGINT, sha256 STRING, source_url STRING, source_label STRING, parent_image_id STRING, image_role STRING, source_metadata STRING"
)
IMAGE = (
    "schema_version STRING, image_id STRING, source_id STRING, relative_path STRING, sha256 STRING, pixel_sha256 STRING, lossless_transform_sha256 STRING, perceptual_dhash64 STRING,"
    " canonical_image_id STRING, selection_status STRING, exclusion_reason STRING, bytes BIGINT, width_px INT, height_px INT, file_format STRING, image_mode STRING, frame_count INT,"
    " source_labels ARRAY<STRING>, candidate_groups ARRAY<STRING>, taxonomy STRUCT<taxon_group: STRING, genus: STRING, species: STRING, status: STRING, taxa: ARRAY<STRUCT<source_label: STRING, taxon_group: STRING,"
    " genus: STRING, species: STRING, rank: STRING, mapping_note: STRING>>>, source_split STRING, source_url STRING, image_role STRING, source_metadata STRING,"
    " annotations ARRAY<STRUCT<label: STRING, class_id: INT, format: STRING, coordinates: ARRAY<DOUBLE>>>, lineage MAP<STRING, STRING>, relationship_keys ARRAY<STRING>, leakage_group_id STRING,"
    " import_flags ARRAY<STRING>, usage_permission_ref STRING, review_status STRING, group_label STRING"
)
#: What the reader of a frozen split checks.
MANIFEST = (
    "image_id STRING, source_id STRING, relative_path STRING, sha256 STRING, pixel_sha256 STRING, lossless_transform_sha256 STRING, canonical_image_id STRING, source_labels ARRAY<STRING>,"
    " taxonomy STRUCT<taxon_group: STRING, genus: STRING, species: STRING, status: STRING, taxa: ARRAY<STRUCT<source_label: STRING, taxon_group: STRING, genus: STRING, species: STRING, rank: STRING, mapping_note: STRING>>>,"
    " lineage MAP<STRING, STRING>, relationship_keys ARRAY<STRING>, experiment_group_id STRING, split STRING, candidate_group STRING,"
    " group_target BIGINT, genus_target BIGINT, species_target BIGINT, group_mask BOOLEAN, genus_mask BOOLEAN, species_mask BOOLEAN"
)
NEAR_PAIR = "image_id_a STRING, image_id_b STRING, relative_path_a STRING, relative_path_b STRING, dhash_hamming_distance INT, status STRING"
REVIEW = (
    "image_id STRING, image_sha256 STRING, annotation_version BIGINT, review_status STRING, disposition STRING, group_label STRING, visible_evidence STRING, annotator_id STRING, reviewer_id STRING,"
    " usage_approved BOOLEAN, scope_approved BOOLEAN, usage_permission_ref STRING, supporting_evidence_ref STRING, second_review_confirmed BOOLEAN, quality_flags ARRAY<STRING>, notes STRING"
)
ASSIGNMENT = "leakage_group_id STRING, split STRING"
