"""Records of the three source collections from inventory rows and their acquisition metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import codes, flags, ids, paths, taxa
from lamella.operators.checks import require
from lamella.sources.boxes import BOX

#: source -> function of (inventory rows of the source, downloads, boxes); register a source by adding one.
ADAPTERS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {}
#: Flags every imported record has.
BASE_FLAGS = ("source_label_unreviewed", "biological_lineage_unrecoverable")
#: Fields of lineage, all NULL until something is known.
LINEAGE = ("parent_image_id", "tree_id", "case_id", "specimen_id", "slide_id", "video_id", "isolate_id")
_BOXES = "array<struct<label:string,class_id:int,format:string,coordinates:array<double>>>"


def adapter(source: str):
    def register(f):
        ADAPTERS[source] = f
        return f

    return register


def _empty() -> Column:
    return F.array().cast("array<string>")


def _groups(labels: Column, table: dict[str, tuple]) -> Column:
    known = F.create_map(*(F.lit(x) for label, (group, *_) in table.items() for x in (label, group)))
    return F.array_compact(F.transform(labels, lambda x: F.try_element_at(known, x)))


def _unmapped(labels: Column, table: dict[str, tuple]) -> Column:
    return F.size(F.array_except(labels, F.array(*(F.lit(x) for x in table)))) > 0


def _lineage(**known: Column) -> Column:
    items = [x for name in LINEAGE for x in (F.lit(name), known.get(name, F.lit(None).cast("string")))]
    extra = [x for name, c in known.items() if name not in LINEAGE for x in (F.lit(name), c)]
    return F.create_map(*items, *extra)


@adapter("tgfc")
def boxed(rows: DataFrame, downloads: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxed collection. boxes: path, annotations of the images that have an annotation file."""
    mixed = F.array_contains(paths.parts(F.col("path")), "MixedClass")
    split = F.element_at(paths.parts(F.col("path")), -3)
    placed = rows.join(boxes, "path", "left").withColumn("mixed", mixed).withColumn("split", F.when(~mixed, split))
    bad = placed.select("path", F.when(~F.col("mixed") & (~F.col("split").isin("train", "valid", "test") | (paths.parent(F.col("path")) != "images")), "unexpected_location").when(~F.col("mixed") & F.col("annotations").isNull(), "no_annotation_file").alias("code"))
    require(bad.filter("code is not null"), "boxed collection")
    labels = F.when(F.col("mixed"), F.array(F.lit("MixedClass"))).otherwise(flags.sorted_set(F.transform("annotations", lambda a: a["label"])))
    stem = F.regexp_extract(paths.stem(F.col("path")), r"^(.+)\.rf\.[0-9a-fA-F]{32}$", 1)
    found = placed.withColumn("source_labels", labels).withColumn("stem", F.when(~F.col("mixed") & (stem != ""), stem))
    derived = {
        "magnification_kind_unspecified": F.lit(True),
        "multiple_fungal_taxa_source_subset": F.col("mixed"), "per_image_taxa_unavailable": F.col("mixed"), "source_boxes_unavailable": F.col("mixed"),
        "empty_source_annotations": ~F.col("mixed") & (F.size(F.coalesce("annotations", F.array().cast(_BOXES))) == 0),
        "unmapped_source_label": ~F.col("mixed") & _unmapped(F.col("source_labels"), taxa.BOXED),
        "source_split_not_project_split": ~F.col("mixed"),
    }
    return found.select(
        *rows.columns, "source_labels", _groups(F.col("source_labels"), taxa.BOXED).alias("candidate_groups"), F.col("split").alias("source_split"), F.lit("unknown").alias("image_role"),
        F.coalesce("annotations", F.array().cast(_BOXES)).alias("annotations"), _lineage().alias("lineage"),
        F.when(F.col("stem").isNotNull(), F.array(F.concat(F.lit("tgfc:export_stem:"), "stem"))).otherwise(_empty()).alias("relationship_keys"), flags.flags_where(derived).alias("import_flags"),
    )


def _captions(metadata: Column) -> Column:
    """All captions of a gallery record, at its four levels."""
    v = F.try_parse_json(metadata)
    own = F.array(F.try_variant_get(v, "$.caption", "string"))
    linked = F.try_variant_get(v, "$.linked_entity_image_captions", "array<string>")
    records = F.try_variant_get(v, "$.gallery_records", "array<variant>")
    deep = F.flatten(
        F.transform(
            F.coalesce(records, F.array().cast("array<variant>")),
            lambda r: F.concat(F.array(F.try_variant_get(r, "$.caption", "string")), F.coalesce(F.try_variant_get(r, "$.linked_entity_image_captions", "array<string>"), _empty())),
        )
    )
    return F.array_compact(F.concat(own, F.coalesce(linked, _empty()), deep))


@adapter("idphy")
def captioned(rows: DataFrame, downloads: DataFrame, boxes: DataFrame) -> DataFrame:
    """Captioned gallery: labels from the metadata, keys from the asset's address and the culture codes in captions."""
    joined = rows.join(downloads.select("filename", "source_url", "source_metadata"), F.element_at(F.split("path", "/"), -1) == F.col("filename"), "left")
    v = F.try_parse_json("source_metadata")
    labels = F.try_variant_get(v, "$.species_labels", "array<string>")
    require(joined.filter(F.coalesce(F.size(labels) <= 0, F.lit(True))).select("path"), "no species labels")
    found = joined.withColumn("source_labels", flags.sorted_set(labels)).withColumn("culture", flags.sorted_set(F.flatten(F.transform(_captions(F.col("source_metadata")), lambda c: F.transform(codes.references(c), lambda r: F.concat_ws(":", F.lit("idphy:culture"), r["namespace"], r["identifier"]))))))
    oomycetes = F.forall("source_labels", lambda x: x.startswith("Phytophthora "))
    derived = {
        "unmapped_source_label": ~oomycetes, "image_role_requires_review": F.lit(True), "image_rights_markings_require_review": F.lit(True),
        "conflicting_source_taxon_labels": F.coalesce(F.try_variant_get(v, "$.source_label_ambiguity", "boolean"), F.lit(False)) | (F.size("source_labels") > 1),
        "caption_culture_references_unreviewed": F.size("culture") > 0,
    }
    return found.select(
        *rows.columns, "source_labels", F.when(oomycetes, F.array(F.lit("oomycetes"))).otherwise(_empty()).alias("candidate_groups"), F.lit(None).cast("string").alias("source_split"), F.lit("unknown").alias("image_role"),
        F.array().cast(_BOXES).alias("annotations"), _lineage().alias("lineage"), F.concat(F.array(F.concat(F.lit("idphy:asset:"), "source_url")), "culture").alias("relationship_keys"), flags.flags_where(derived).alias("import_flags"),
    )


@adapter("soil")
def fields_and_crops(rows: DataFrame, downloads: DataFrame, boxes: DataFrame) -> DataFrame:
    """Full fields and their crops, linked by the source's parent ids."""
    joined = rows.join(downloads.select("filename", "source_label", F.col("parent_image_id").alias("parent"), "image_role"), F.element_at(F.split("path", "/"), -1) == F.col("filename"), "left")
    require(joined.filter(~F.coalesce((F.length("source_label") > 0) & (F.length("parent") > 0) & F.col("image_role").isin("crop", "full_field"), F.lit(False))).select("path"), "incomplete metadata")
    known = downloads.filter("image_role = 'full_field'").select(F.col("parent_image_id").alias("parent")).distinct().withColumn("present", F.lit(True))
    labels = F.array("source_label")
    crop = F.col("image_role") == "crop"
    derived = {
        "unmapped_source_label": _unmapped(labels, taxa.SOIL), "crop_coordinates_unavailable": crop, "parent_image_not_in_release": crop & F.col("present").isNull(),
        "source_spelling_preserved": F.col("source_label") == "Phytophtora",
    }
    return joined.join(known, "parent", "left").select(
        *rows.columns, labels.alias("source_labels"), _groups(labels, taxa.SOIL).alias("candidate_groups"), F.lit(None).cast("string").alias("source_split"), "image_role",
        F.array().cast(_BOXES).alias("annotations"), _lineage(source_parent_id=F.col("parent")).alias("lineage"), F.array(F.concat(F.lit("soil:source_parent:"), "parent")).alias("relationship_keys"), flags.flags_where(derived).alias("import_flags"),
    )


def image_annotations(found: DataFrame) -> DataFrame:
    """path, annotations (in line order) from labelled_boxes() with column path."""
    row = F.struct("line", F.struct("label", "class_id", F.lit(BOX).alias("format"), "coordinates").alias("a"))
    return found.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(row)), lambda x: x["a"]).alias("annotations"))


def adapt(inventory: DataFrame, downloads: DataFrame, annotations: DataFrame) -> DataFrame:
    """One catalog row for each inventory row, whatever its source, with id, taxonomy and flags."""
    parts = []
    for source, f in ADAPTERS.items():
        mine = inventory.filter(F.col("source_id") == source)
        parts.append(f(mine, downloads.filter(F.col("source_id") == source), annotations))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    groups = flags.sorted_set(F.col("candidate_groups"))
    return rows.select(
        ids.row_id(F.col("source_id"), F.col("path")).alias("image_id"), "source_id", F.col("path").alias("relative_path"), "sha256", "bytes",
        F.col("width").cast("int").alias("width_px"), F.col("height").cast("int").alias("height_px"), F.col("format").alias("file_format"),
        flags.sorted_set(F.col("source_labels")).alias("source_labels"), groups.alias("candidate_groups"), taxa.taxonomy(F.col("source_id"), flags.sorted_set(F.col("source_labels")), groups).alias("taxonomy"),
        "source_split", "image_role", "annotations", "lineage", flags.sorted_set(F.col("relationship_keys")).alias("relationship_keys"),
        flags.sorted_set(F.concat("import_flags", F.array(*(F.lit(x) for x in BASE_FLAGS)))).alias("import_flags"),
        F.concat(F.lit("sources.json#"), "source_id").alias("usage_permission_ref"), F.lit("unreviewed").alias("review_status"), F.lit(None).cast("string").alias("group_label"),
    )


def connect_parents(records: DataFrame) -> DataFrame:
    """Crops of the soil collection with the id of their full field; where it is not there the parent stays NULL and a flag is set."""
    fields = records.filter("source_id = 'soil' and image_role = 'full_field'").groupBy(paths.stem(F.col("relative_path")).alias("key")).agg(F.max("image_id").alias("parent_id"))
    crop = (F.col("source_id") == "soil") & (F.col("image_role") == "crop")
    joined = records.withColumn("key", F.when(crop, F.col("lineage")["source_parent_id"])).join(fields, "key", "left")
    linked = F.transform_values("lineage", lambda k, v: F.when((k == "parent_image_id") & crop, F.col("parent_id")).otherwise(v))
    return joined.withColumn("lineage", linked).withColumn(
        "import_flags", flags.add_flags(F.col("import_flags"), {"parent_image_missing": crop & F.col("key").isNotNull() & F.col("parent_id").isNull()})
    ).select(*records.columns)
