"""Whole dataflows: a raw tree to a catalog, a catalog to a frozen split, a catalog and reviews to a release, and their readers."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import flags, ids, paths, taxa
from lamella.functions.digests import hash64
from lamella.operators import adapters, checks, curation, graph, labels, reviews, splitting, summaries
from lamella.operators.checks import ViolationError, require
from lamella.session import materialize
from lamella.sources import boxes, inventory, lines, manifests, rasters, schemas, sinks
from lamella.sources.assignments import read_assignments

SPLITS = labels.SPLITS


def _local_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def flat(records: DataFrame) -> DataFrame:
    """Records with the ranks of their consensus as columns."""
    return records.select("*", *(F.col("taxonomy")[r].alias(r) for r in ("taxon_group", "genus", "species")))


def _annotations(spark: SparkSession, root: str) -> tuple[DataFrame, dict[int, str]]:
    found = [os.path.join(d, "data.yaml") for d, _, names in os.walk(f"{root}/01_tgfc/extracted") if "data.yaml" in names]
    if len(found) != 1:
        raise ViolationError("exactly one class map is expected")
    with open(found[0], encoding="utf-8") as f:
        classes = manifests.class_map(f.read())
    table = spark.createDataFrame(list(classes.items()), "class_id int, label string")
    read = inventory.files(spark, root, "01_tgfc/extracted", content=True).select("path", F.decode("content", "UTF-8").alias("text"))
    read = read.unionByName(inventory.empty_files(spark, root, "01_tgfc/extracted").withColumn("text", F.lit("")))
    texts = read.filter((paths.suffix(F.col("path")) == ".txt") & (paths.parent(F.col("path")) == "labels"))
    parsed = boxes.labelled_boxes(boxes.boxes(texts, "path"), F.broadcast(table))
    require(parsed.filter("error is not null").select("path", "line", "error"), "annotation files")
    per_file = texts.select("path").join(adapters.image_annotations(parsed), "path", "left")
    key = F.regexp_replace(F.regexp_replace("path", "/labels/([^/]+)$", "/images/$1"), r"\.txt$", "")
    empty = F.array().cast(adapters._BOXES)
    return per_file.select(key.alias("stem_path"), F.coalesce("annotations", empty).alias("annotations")), classes


def build_records(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, dict]:
    """records (materialized), near pairs and the source registry of a raw tree."""
    rows = inventory.read_inventory(spark, root)
    require(inventory.coverage(rows, inventory.image_files(spark, root)), "inventory and files differ")
    registry = manifests.source_registry(root)
    require(manifests.completeness(spark, root).filter("not complete"), "incomplete acquisition")
    acquired = manifests.downloads(spark, root)
    require(manifests.acquisition_mismatch(rows.filter("source_id <> 'tgfc'"), acquired), "inventory and acquisition differ")
    facts = None
    for name, (_, folder) in inventory.COLLECTIONS.items():
        part = rasters.raster_facts(spark, f"{root}/{name}/{folder}")
        facts = part if facts is None else facts.unionByName(part)
    base = os.path.abspath(root) + "/"
    facts = facts.withColumn("path", F.substring_index(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), base, -1))
    facts = materialize(facts.withColumnRenamed("height", "h").withColumnRenamed("width", "w").withColumnRenamed("sha256", "actual_sha256"))
    checked = rows.join(facts, "path", "left").select(
        "path",
        F.when(F.col("h").isNull() | (F.col("h") < 0), "not_decodable").when(F.col("actual_sha256") != F.col("sha256"), "checksum_changed")
        .when((F.col("h") != F.col("height")) | (F.col("w") != F.col("width")), "dimensions_changed").when(F.col("file_format") != F.col("format"), "format_changed").alias("code"),
    )
    require(checked.filter("code is not null"), "images")
    found, _ = _annotations(spark, root)
    annotated = rows.select("path", F.regexp_replace("path", r"\.[^./]+$", "").alias("stem_path")).join(found, "stem_path").select("path", "annotations")
    adapted = materialize(adapters.adapt(rows, acquired, annotated)).join(
        facts.select(F.col("path").alias("relative_path"), "frame_count", "pixel_sha256", "lossless_transform_sha256", "perceptual_dhash64"), "relative_path"
    )
    small = {"native_dimension_below_224": F.least("width_px", "height_px") < 224, "multi_frame_asset": F.col("frame_count") > 1}
    adapted = adapted.withColumn("import_flags", flags.add_flags(F.col("import_flags"), small))
    curated = curate_records(materialize(adapters.connect_parents(adapted)))
    records = materialize(curated[0])
    return records, curated[1], registry


def curate_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Canonical ids, flags and source-level leakage groups; and near pairs among what is kept."""
    c = materialize(curation.curate(flat(records)).drop("taxon_group", "genus", "species"))
    c = c.withColumn("import_flags", flags.add_flags(flags.drop_flags(F.col("import_flags"), "duplicate_label_conflict", "near_duplicate_candidate"), {"duplicate_label_conflict": F.col("label_conflict")})).drop("label_conflict")
    kept = c.filter("selection_status = 'included'").withColumn("h", hash64(F.col("perceptual_dhash64")))
    near = materialize(curation.near_pairs(kept, "image_id", "h"))
    c = curation.flag_near(c, near)
    roots = graph.components(c.select(F.col("source_id").alias("node")), graph.star_edges(graph.catalog_tokens(c).distinct()))
    members = roots.groupBy("root").agg(ids.member_list_id("lg-", F.col("node")).alias("leakage_group_id")).join(roots, "root").select(F.col("node").alias("source_id"), "leakage_group_id")
    where = c.select("image_id", "relative_path")
    pairs = near.join(where.select(F.col("image_id").alias("key_a"), F.col("relative_path").alias("relative_path_a")), "key_a").join(where.select(F.col("image_id").alias("key_b"), F.col("relative_path").alias("relative_path_b")), "key_b")
    pairs = pairs.select(F.col("key_a").alias("image_id_a"), F.col("key_b").alias("image_id_b"), "relative_path_a", "relative_path_b", F.col("distance").cast("int").alias("dhash_hamming_distance"), F.lit("requires_visual_review").alias("status"))
    return c.drop("leakage_group_id").join(members, "source_id"), pairs.orderBy("image_id_b", "image_id_a")


def _summary(records: DataFrame, pairs: DataFrame) -> dict:
    totals = {r["source_id"] or "all": {k: r[k] for k in r.asDict() if k != "source_id"} for r in summaries.catalog_summary(records).collect()}
    counts: dict[str, dict[str, int]] = {}
    for r in summaries.counts_by(records, "candidate_groups", "image_role", "source_split", "import_flags").orderBy("dimension", "value").collect():
        counts.setdefault(r["dimension"], {})[r["value"]] = r["n"]
    reasons = {r["exclusion_reason"]: r["n"] for r in records.filter("exclusion_reason is not null").groupBy("exclusion_reason").agg(F.count("*").alias("n")).collect()}
    return {"totals": totals, "counts": counts, "exclusion_counts": reasons, "near_pairs": pairs.count()}


def _report(summary: dict) -> str:
    out = ["# Catalog", "", "| source | images | selected | excluded |", "| --- | --- | --- | --- |"]
    out += [f"| {s} | {t['images']} | {t['selected']} | {t['excluded']} |" for s, t in sorted(summary["totals"].items())]
    return "\n".join(out) + "\n"


def ingest(spark: SparkSession, root: str, output: str) -> dict:
    """A catalog folder from a raw tree."""
    records, pairs, registry = build_records(spark, root)
    require(checks.violations(records, ["image_id"], checks.record_constraints()), "records")
    mapped = labels.label_map(flat(records).select("taxon_group", "genus", "species"))

    def fill(staging: str) -> dict:
        sinks.write_lines(records, f"{staging}/images.jsonl", "relative_path")
        sinks.write_lines(pairs, f"{staging}/near_duplicate_candidates.jsonl", "image_id_b", "image_id_a")
        sinks.write_lines(curation.cluster_report(records.withColumn("label_conflict", F.array_contains("import_flags", "duplicate_label_conflict"))), f"{staging}/curation.jsonl", "canonical_image_id")
        sinks.write_lines(mapped, f"{staging}/taxonomy_map.jsonl", "rank", "id")
        sinks.write_lines(working_examples(records, mapped), f"{staging}/examples.jsonl", "image_id")
        sinks.write_csv(working_examples(records, mapped), f"{staging}/examples.csv", "image_id")
        sinks.write_csv(review_queue(records), f"{staging}/review_queue.csv", "image_id")
        sinks.write_json(f"{staging}/sources.json", registry)
        sinks.write_json(f"{staging}/image.schema.json", sinks.schema_json(records.schema))
        summary = _summary(records, pairs)
        with open(f"{staging}/report.md", "w", encoding="utf-8") as f:
            f.write(_report(summary))
        return {"schema_version": schemas.SCHEMA_VERSION, "kind": "catalog", "task_groups": ["fungi", "oomycetes"], "summary": summary, "environment": sinks.environment()}

    return sinks.publish(output, "catalog.json", "catalog", fill)


def working_examples(records: DataFrame, mapped: DataFrame) -> DataFrame:
    """Included records with class and hierarchy targets."""
    f = flat(records).filter("selection_status = 'included'")
    t = labels.rank_targets(f, mapped, "image_id")
    single = F.when(F.size("candidate_groups") == 1, F.col("candidate_groups")[0])
    from lamella.functions.taxa import GROUPS

    class_id = F.try_element_at(F.create_map(*(F.lit(x) for p in GROUPS.items() for x in p)), F.col("candidate_group"))
    return f.withColumn("candidate_group", single).join(t, "image_id").select(
        "image_id", "source_id", "relative_path", "sha256", "pixel_sha256", "canonical_image_id", "width_px", "height_px", "candidate_group", class_id.alias("class_id"),
        F.lit("publisher_mapping").alias("label_origin"), "review_status", "leakage_group_id", "import_flags", "source_labels", "taxonomy", "annotations", *t.columns[1:],
    )


def review_queue(records: DataFrame) -> DataFrame:
    return records.select(
        "image_id", "relative_path", "sha256", "canonical_image_id", "selection_status", "exclusion_reason", "source_id", "source_labels", "candidate_groups", "image_role", "width_px", "height_px",
        "leakage_group_id", "import_flags", "review_status", F.lit(None).cast("string").alias("disposition"), "group_label",
    )


def read_catalog(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict]:
    """records, near pairs and metadata of a catalog whose files are as bound and whose rows hold their constraints."""
    metadata = sinks.verify_bound(folder, "catalog.json", "catalog")
    if metadata.get("schema_version") != schemas.SCHEMA_VERSION or metadata.get("kind") != "catalog":
        raise ViolationError("no catalog of this version")
    with open(f"{folder}/image.schema.json", encoding="utf-8") as f:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.load(f))
    records = lines.read_strict(spark, f"{folder}/images.jsonl", schema)
    require(checks.violations(records, ["image_id"], checks.record_constraints()), "records")
    require(checks.repeated(records, "image_id"), "repeated ids")
    require(checks.repeated(records, "relative_path"), "repeated paths")
    require(checks.canonical_reference_violations(records), "canonical ids")
    pairs = lines.read_strict(spark, f"{folder}/near_duplicate_candidates.jsonl", schemas.NEAR_PAIR)
    return records, pairs, metadata


def validate_catalog(spark: SparkSession, folder: str, root: str) -> dict:
    """Derive everything anew from the raw tree and hold it against what is stored."""
    records, pairs, metadata = read_catalog(spark, folder)
    fresh, fresh_pairs, _ = build_records(spark, root)
    for name, a, b in (("records", records, fresh), ("near pairs", pairs, fresh_pairs)):
        require(checks.difference(sinks.json_lines(a), sinks.json_lines(b.select(*a.columns))), f"stored and derived {name} differ")
    return metadata


def build_split(spark: SparkSession, catalog: str, eligible: DataFrame, output: str, seed: int = 42, policies: DataFrame | None = None) -> dict:
    """A frozen three-way split of the eligible images (image_id) of a catalog; groups span all records. Images that may not be
    eligible are an error; policies of the sources, if given, are held against them and bound to the split."""
    sinks.check_isolated(output, catalog)
    records, pairs, metadata = read_catalog(spark, catalog)
    require(checks.eligibility_violations(records, eligible, policies), "not eligible")
    roots = graph.observed_groups(records, pairs)
    named = roots.groupBy("root").agg(ids.group_digest("eg-", F.col("image_id")).alias("experiment_group_id"))
    grouped = materialize(flat(records).join(roots.join(named, "root").drop("root"), "image_id"))
    selected = grouped.join(eligible, "image_id", "left_semi")
    assigned = materialize(splitting.assign_groups(selected, "experiment_group_id", seed))
    placed = materialize(selected.join(assigned, "experiment_group_id"))
    require(splitting.torn_groups(placed, "experiment_group_id", "split"), "groups cross partitions")
    mapped = labels.label_map(selected.select("taxon_group", "genus", "species"))
    support = materialize(labels.label_support(placed, "experiment_group_id", "split"))
    targets = labels.masked_targets(placed, labels.rank_targets(placed, mapped, "image_id"), support, "image_id", "split")
    manifest = placed.join(targets, "image_id").select(
        "image_id", "source_id", "relative_path", "sha256", "pixel_sha256", "lossless_transform_sha256", "canonical_image_id", "source_labels", "taxonomy", "annotations", "lineage", "relationship_keys",
        F.col("leakage_group_id").alias("source_leakage_group_id"), "experiment_group_id", "split", F.col("candidate_groups")[0].alias("candidate_group"), *targets.columns[1:],
        F.concat_ws("/", F.lit("images"), "split", F.col("candidate_groups")[0], F.concat("image_id", paths.suffix(F.col("relative_path")))).alias("partition_image_path"),
    )
    inventory_ = splitting.group_inventory(grouped, "experiment_group_id").join(assigned, "experiment_group_id", "left")
    left_out = grouped.join(eligible, "image_id", "left_anti").join(assigned, "experiment_group_id", "left").select(
        "image_id", "relative_path", "source_id", "experiment_group_id", F.lit("not_eligible").alias("reason"), F.col("split").alias("related_partition")
    )

    def fill(staging: str) -> dict:
        sinks.write_lines(manifest, f"{staging}/manifest.jsonl", "image_id")
        sinks.write_csv(manifest, f"{staging}/manifest.csv", "image_id")
        for s in SPLITS:
            os.makedirs(f"{staging}/partitions", exist_ok=True)
            sinks.write_lines(manifest.filter(F.col("split") == s), f"{staging}/partitions/{s}.jsonl", "image_id")
        sinks.write_lines(inventory_, f"{staging}/groups.jsonl", "experiment_group_id")
        sinks.write_lines(left_out, f"{staging}/exclusions.jsonl", "image_id")
        sinks.write_lines(support, f"{staging}/label_support.jsonl", "rank", "label")
        sinks.write_lines(mapped, f"{staging}/taxonomy_map.jsonl", "rank", "id")
        if policies is not None:
            sinks.write_lines(policies, f"{staging}/source_usage.jsonl", "source_id")
        counts = {r["split"]: {"images": r["images"], "groups": r["groups"]} for r in splitting.split_counts(placed, "experiment_group_id", "split").collect()}
        coverage = {r["rank"]: {k: r[k] for k in ("labels", "trained", "evaluable", "train_only", "untrained")} for r in labels.rank_coverage(support).collect()}
        return {"schema_version": schemas.SCHEMA_VERSION, "kind": "split", "seed": seed, "catalog_id": metadata["id"], "counts": counts, "rank_coverage": coverage, "ratios": list(splitting.RATIOS)}

    return sinks.publish(output, "split.json", "split", fill)


def _wrong_types(spark: SparkSession, path: str, key: str, kinds: dict[str, str]) -> DataFrame:
    """key, code of JSON lines whose fields are not exactly of their types: true is no 1, and "1" is none."""
    named = spark.read.text(path).withColumn(key, F.get_json_object("value", f"$.{key}"))
    return checks.violations(named, [key], {f: lines.typed_field(F.col("value"), f, kind) for f, kind in kinds.items()})


def _check_relations(rows: DataFrame, left_out: DataFrame) -> None:
    """No hash, id, key or lineage value links images of different partitions; ids of images that are not eligible stand for
    the partition of their group."""
    node = F.col("image_id").alias("node")
    named = left_out.filter("related_partition is not null")
    absent = named.select(node, F.explode(F.array(*(F.concat_ws("\u0001", F.lit(k), "image_id") for k in ("canonical", "parent_image_id")))).alias("token"))
    tokens = graph.release_tokens(rows.withColumn("leakage_group_id", F.col("image_id")).withColumn("frame_count", F.lit(1)), with_source=False)
    placed = rows.select(node, "split").unionByName(named.select(node, F.col("related_partition").alias("split")))
    require(graph.crossing_tokens(tokens.unionByName(absent), placed), "known relations cross partitions")
    ids_ = rows.select("image_id").unionByName(left_out.select("image_id"))
    for c in (F.col("canonical_image_id"), F.col("lineage")["parent_image_id"]):
        require(checks.orphans(rows.select(c.alias("related")), "related", ids_, "image_id"), "relations to unknown images")


def _check_inventory(spark: SparkSession, folder: str, rows: DataFrame, left_out: DataFrame) -> None:
    """The group inventory, the manifest and what is left out say the same of groups, their partitions and sizes."""
    shape = "experiment_group_id string, images bigint, split string"
    stored = lines.read_lenient(spark, f"{folder}/groups.jsonl", shape)
    held = rows.select("experiment_group_id", "split", F.lit(True).alias("eligible")).unionByName(
        left_out.select("experiment_group_id", F.col("related_partition").alias("split"), F.lit(False).alias("eligible"))
    )
    require(checks.difference(stored, held.groupBy("experiment_group_id", "split").agg(F.count("*").alias("images")).select(*stored.columns)), "group inventory and manifest differ")
    require(held.groupBy("experiment_group_id", "split").agg(F.max("eligible").alias("eligible")).filter("eligible <> (split is not null)"), "partitions of groups without eligible images")
    require(checks.repeated(rows.select("image_id").unionByName(left_out.select("image_id")), "image_id"), "images both eligible and left out")


def _check_labels(spark: SparkSession, folder: str, rows: DataFrame) -> None:
    """Taxonomy, label map, support, targets and masks are what they are derived to be. A taxonomy without its taxa has
    nothing to be derived from and counts as it stands."""
    # Only eligible records are here, so each has one candidate group.
    derived = taxa.taxonomy(F.col("source_id"), F.col("source_labels"), F.array("candidate_group"))
    require(rows.filter(F.col("taxonomy")["taxa"].isNotNull() & ~F.to_json("taxonomy").eqNullSafe(F.to_json(derived))).select("image_id"), "taxonomy differs from source labels")
    require(_wrong_types(spark, f"{folder}/taxonomy_map.jsonl", "label", {"id": "BIGINT"}), "label map ids")
    kinds = {f"{r}_{what}": kind for r in ("group", "genus", "species") for what, kind in (("target", "BIGINT"), ("mask", "BOOLEAN"))}
    require(_wrong_types(spark, f"{folder}/manifest.jsonl", "image_id", kinds), "targets and masks")
    known = flat(rows)
    mapped = materialize(labels.label_map(known.select("taxon_group", "genus", "species")))
    require(checks.difference(lines.read_lenient(spark, f"{folder}/taxonomy_map.jsonl", mapped.schema), mapped), "label maps differ")
    support = materialize(labels.label_support(known, "experiment_group_id", "split"))
    require(checks.difference(lines.read_lenient(spark, f"{folder}/label_support.jsonl", support.schema), support), "label supports differ")
    targets = labels.masked_targets(known, labels.rank_targets(known, mapped, "image_id"), support, "image_id", "split")
    require(checks.difference(rows.select(*targets.columns), targets), "targets or masks differ")


def read_manifest(spark: SparkSession, folder: str, schema, split: str | None = None) -> DataFrame:
    """The manifest of a frozen split whose files are as bound, whose counts are as stated, whose related images do not cross
    partitions, and whose labels are derived anew. What is checked is read by the manifest's own schema, not the caller's."""
    metadata = sinks.verify_bound(folder, "split.json", "split")
    if metadata.get("kind") != "split" or metadata.get("schema_version") != schemas.SCHEMA_VERSION:
        raise ViolationError("no split")
    if split is not None and split not in SPLITS:
        raise ViolationError(f"no partition {split}")
    rows = lines.read_lenient(spark, f"{folder}/manifest.jsonl", schemas.MANIFEST)
    left_out = lines.read_lenient(spark, f"{folder}/exclusions.jsonl", "image_id string, experiment_group_id string, related_partition string")
    require(checks.violations(rows, ["image_id"], {"image_id": F.length("image_id") > 0, "experiment_group_id": F.length("experiment_group_id") > 0, "split": F.col("split").isin(*SPLITS), "relative_path": paths.is_normal(F.col("relative_path"))}), "manifest")
    require(checks.repeated(rows, "image_id"), "repeated ids")
    counts = {r["split"]: {"images": r["images"], "groups": r["groups"]} for r in splitting.split_counts(rows, "experiment_group_id", "split").collect()}
    if not counts or counts != metadata.get("counts"):
        raise ViolationError(f"images and groups are {counts}, not as stated")
    require(splitting.torn_groups(rows, "experiment_group_id", "split"), "related images cross partitions")
    _check_relations(rows, left_out)
    _check_inventory(spark, folder, rows, left_out)
    _check_labels(spark, folder, rows)
    out = lines.read_lenient(spark, f"{folder}/manifest.jsonl", schema)
    return out if split is None else out.filter(F.col("split") == split)


def read_release(spark: SparkSession, folder: str, schema, split: str | None = None) -> DataFrame:
    """The manifest of a release whose files are as bound, whose class map is the fixed one, whose ids of classes are exact
    integers of it, and whose counts are as stated."""
    metadata = sinks.verify_bound(folder, "release.json", "release")
    if metadata.get("kind") != "release" or metadata.get("schema_version") != "2.0":
        raise ViolationError("no release")
    if split is not None and split not in SPLITS:
        raise ViolationError(f"no partition {split}")
    classes = metadata.get("class_map")
    if classes != taxa.GROUPS or any(type(v) is not int for v in classes.values()):
        raise ViolationError("not the class map")
    path = f"{folder}/manifest.jsonl"
    rows = lines.read_lenient(spark, path, "image_id string, relative_path string, group_label string, class_id bigint, split string")
    require(_wrong_types(spark, path, "image_id", {"class_id": "BIGINT"}), "ids of classes")
    fits = F.col("class_id") == F.try_element_at(F.create_map(*(F.lit(x) for p in classes.items() for x in p)), F.col("group_label"))
    require(checks.violations(rows, ["image_id"], {"image_id": F.length("image_id") > 0, "class_id": fits, "split": F.col("split").isin(*SPLITS), "relative_path": paths.is_normal(F.col("relative_path"))}), "manifest")
    require(checks.repeated(rows, "image_id"), "repeated ids")
    found = {(r["group_label"], r["split"]): r["count"] for r in rows.groupBy("group_label", "split").count().collect()}
    stated = {(g, s): n for g, by in metadata.get("class_split_counts", {}).items() for s, n in by.items() if n}
    if not found or found != stated:
        raise ViolationError("the counts of classes and partitions are not as stated")
    out = lines.read_lenient(spark, path, schema)
    return out if split is None else out.filter(F.col("split") == split)


def build_release(spark: SparkSession, catalog: str, review_lines: str, assignments_csv: str, output: str, version: str) -> dict:
    """A reviewed manifest: latest reviews, their gate, group assignments, and the guard against related images across them."""
    sinks.check_isolated(output, catalog)
    if not version or version != version.strip():
        raise ViolationError("a version is needed")
    records, _, metadata = read_catalog(spark, catalog)
    rows = lines.read_strict(spark, review_lines, schemas.REVIEW)
    require(checks.violations(rows, ["image_id"], reviews.review_constraints()), "reviews")
    require(checks.repeated(rows, "image_id", "annotation_version"), "repeated review versions")
    require(checks.orphans(rows, "image_id", records, "image_id"), "reviews of unknown images")
    assigned = read_assignments(spark, assignments_csv, records)
    last = reviews.latest(rows, "image_id", "annotation_version").drop("review_status")
    joined = records.drop("usage_permission_ref", "group_label").join(last.withColumn("reviewed", F.lit(True)), "image_id", "left")
    require(joined.filter("image_sha256 <> sha256").select("image_id"), "reviews of other bytes")
    roots = graph.components(records.select(F.col("leakage_group_id").alias("node")), graph.star_edges(graph.release_tokens(records).distinct()))
    crossing = roots.join(assigned.select(F.col("leakage_group_id").alias("node"), "split"), "node").groupBy("root").agg(F.count_distinct("split").alias("n")).filter("n > 1")
    require(crossing, "related material crosses partitions")
    gated = materialize(joined.withColumn("reasons", reviews.exclusion_reasons(F.coalesce("reviewed", F.lit(False)))))
    ready = gated.filter(F.size("reasons") == 0).join(assigned, "leakage_group_id", "left")
    require(ready.filter("split is null").select("leakage_group_id").distinct(), "eligible groups without a partition")
    require(ready.filter("frame_count <> 1").select("image_id"), "multi-frame images")
    require(ready.filter("split = 'test' and not (coalesce(second_review_confirmed, false) and annotator_id <> reviewer_id)").select("image_id"), "test images without a second review")
    if ready.isEmpty():
        counts = {r["reason"]: r["n"] for r in reviews.histogram(gated, "reasons").collect()}
        raise ViolationError(f"nothing is eligible: {counts}")
    class_id = F.try_element_at(F.create_map(*(F.lit(x) for p in taxa.GROUPS.items() for x in p)), F.col("group_label")).alias("class_id")
    manifest = ready.select("image_id", "source_id", "relative_path", "sha256", "width_px", "height_px", "group_label", class_id, "leakage_group_id", "split", "annotation_version", "source_labels", "taxonomy", "annotations")

    def fill(staging: str) -> dict:
        sinks.write_lines(manifest, f"{staging}/manifest.jsonl", "image_id")
        sinks.write_csv(manifest, f"{staging}/manifest.csv", "image_id")
        sinks.write_lines(gated.filter(F.size("reasons") > 0).select("image_id", "reasons"), f"{staging}/exclusions.jsonl", "image_id")
        dims = [spark.createDataFrame([(x,) for x in v], f"{n} string") for n, v in (("group_label", ("fungi", "oomycetes")), ("split", SPLITS))]
        table: dict[str, dict[str, int]] = {}
        for r in reviews.crosstab(manifest, "group_label", "split", *dims).collect():
            table.setdefault(r["group_label"], {})[r["split"]] = r["n"]
        excluded = {r["reason"]: r["n"] for r in reviews.histogram(gated, "reasons").collect()}
        return {"schema_version": "2.0", "kind": "release", "release_version": version, "catalog_id": metadata["id"], "class_map": dict(taxa.GROUPS), "class_split_counts": table, "exclusion_reason_counts": excluded}

    return sinks.publish(output, "release.json", "release", fill)
