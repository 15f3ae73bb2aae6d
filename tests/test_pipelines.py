import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lamella.operators.checks import ViolationError
from lamella.plans import pipelines
from lamella.sources import inventory, sinks
from tests.tree import png, pattern, write_tree


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    write_tree(root)
    return root


@pytest.fixture(scope="module")
def catalog(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("out") / "catalog"
    pipelines.ingest(spark, str(raw), str(out))
    return out


def _rows(path):
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines()]


def test_catalog(catalog):
    rows = {r["relative_path"].split("/")[-1]: r for r in _rows(catalog / "images.jsonl")}
    assert len(rows) == 9
    assert rows["f.png"]["exclusion_reason"] == "exact_file_duplicate" and rows["f.png"]["canonical_image_id"] == rows["a_jpg.rf.0123456789abcdef0123456789abcdef.png"]["image_id"]
    assert {rows["b.png"]["exclusion_reason"], rows["c.png"]["exclusion_reason"]} == {None, "lossless_transform_duplicate"}
    assert rows["e.png"]["taxonomy"]["species"] == "Phytophthora ramorum" and rows["e.png"]["relationship_keys"] == ["idphy:asset:https://example.org/e.png", "idphy:culture:CBS:1234", "idphy:culture:PH:168"]
    assert rows["g.png"]["taxonomy"]["species"] == "Phytophthora cinnamomi" and "idphy:culture:P:168" in rows["g.png"]["relationship_keys"]
    assert rows["f.png"]["taxonomy"]["species"] is None and rows["f.png"]["taxonomy"]["genus"] == "Phytophthora"
    assert rows["Fusarium_12_crop1.png"]["lineage"]["parent_image_id"] == rows["Fusarium_12.png"]["image_id"]
    assert "duplicate_label_conflict" in rows["f.png"]["import_flags"] and "native_dimension_below_224" in rows["d.png"]["import_flags"]
    a = rows["a_jpg.rf.0123456789abcdef0123456789abcdef.png"]
    assert a["relationship_keys"] == ["tgfc:export_stem:a_jpg"] and len(a["annotations"]) == 2 and a["taxonomy"]["status"] == "multiple_taxa" and a["taxonomy"]["taxon_group"] == "fungi"
    # The copy links the boxed collection and the gallery; soil stays apart.
    assert a["leakage_group_id"] == rows["e.png"]["leakage_group_id"] != rows["Fusarium_12.png"]["leakage_group_id"]


def test_publishing_twice_gives_the_same(spark, raw, catalog, tmp_path):
    again = pipelines.ingest(spark, str(raw), str(tmp_path / "again"))
    first = json.loads((catalog / "catalog.json").read_text())
    assert again["file_sha256"] == first["file_sha256"] and again["id"] == first["id"]
    assert pipelines.ingest(spark, str(raw), str(tmp_path / "again"))["id"] == first["id"]


def test_validate(spark, raw, catalog):
    assert pipelines.validate_catalog(spark, str(catalog), str(raw))["id"].startswith("catalog-")


def test_changed_catalog_is_refused(spark, catalog, tmp_path):
    import shutil

    copy = tmp_path / "copy"
    shutil.copytree(catalog, copy)
    (copy / "images.jsonl").write_text((copy / "images.jsonl").read_text().replace("full_field", "crop", 1))
    with pytest.raises(ViolationError, match="bound files differ"):
        pipelines.read_catalog(spark, str(copy))


def test_changed_image_is_refused_and_leaves_nothing(spark, tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    write_tree(root)
    (root / "01_tgfc/extracted/main/valid/images/b.png").write_bytes(png(pattern(77)))
    with pytest.raises(ViolationError, match="checksum_changed"):
        pipelines.ingest(spark, str(root), str(tmp_path / "out/catalog"))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())


def test_unlisted_image_is_refused(spark, tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    write_tree(root)
    (root / "02_idphy_microscopy/images/z ö.png").write_bytes(png(pattern(78)))
    with pytest.raises(ViolationError, match="unlisted"):
        pipelines.build_records(spark, str(root))


def test_files_are_listed_by_relative_path(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b/ö+1.txt").write_bytes(b"x")
    assert [tuple(r) for r in inventory.files(spark, str(tmp_path), content=True).collect()] == [("a b/ö+1.txt", 1, bytearray(b"x"))]


def _big_catalog(spark, tmp_path):
    """A published catalog of 24 records without rasters."""
    def record(i, group):
        return {"image_id": f"i{i:02}", "source_id": "tgfc" if group == "fungi" else "idphy", "relative_path": f"x/{i:02}.png", "sha256": hashlib.sha256(str(i).encode()).hexdigest(), "group": group, "key": f"k{i // 2}"}

    base = spark.createDataFrame([record(i, "fungi" if i < 12 else "oomycetes") for i in range(24)], "image_id string, source_id string, relative_path string, sha256 string, group string, key string")
    genus = F.when(F.col("group") == "fungi", "Fusarium").otherwise("Phytophthora")
    rows = base.select(
        "image_id", "source_id", "relative_path", "sha256", F.sha2("image_id", 256).alias("pixel_sha256"), F.sha2(F.concat(F.lit("l"), "image_id"), 256).alias("lossless_transform_sha256"), F.lit("00ff00ff00ff00ff").alias("perceptual_dhash64"),
        F.col("image_id").alias("canonical_image_id"), F.lit("included").alias("selection_status"), F.lit(None).cast("string").alias("exclusion_reason"), F.lit(10).cast("bigint").alias("bytes"), F.lit(8).alias("width_px"), F.lit(6).alias("height_px"),
        F.lit("PNG").alias("file_format"), F.lit(1).alias("frame_count"), F.array(genus).alias("source_labels"), F.array("group").alias("candidate_groups"),
        F.struct(F.col("group").alias("taxon_group"), genus.alias("genus"), F.lit(None).cast("string").alias("species"), F.lit("single_taxon").alias("status")).alias("taxonomy"),
        F.lit("unknown").alias("image_role"), F.array().cast("array<struct<label:string,class_id:int,format:string,coordinates:array<double>>>").alias("annotations"), F.create_map(F.lit("tree_id"), F.lit(None).cast("string")).alias("lineage"),
        F.array("key").alias("relationship_keys"), F.concat(F.lit("lg-"), "key").alias("leakage_group_id"), F.array().cast("array<string>").alias("import_flags"), F.lit("x").alias("usage_permission_ref"), F.lit("unreviewed").alias("review_status"), F.lit(None).cast("string").alias("group_label"),
    )

    def fill(staging):
        sinks.write_lines(rows, f"{staging}/images.jsonl", "image_id")
        (tmp_path / "none").mkdir(exist_ok=True)
        open(f"{staging}/near_duplicate_candidates.jsonl", "w").close()
        sinks.write_json(f"{staging}/image.schema.json", sinks.schema_json(rows.schema))
        return {"schema_version": "3.0", "kind": "catalog", "summary": {}}

    sinks.publish(str(tmp_path / "catalog"), "catalog.json", "catalog", fill)
    return tmp_path / "catalog", rows


def test_split(spark, tmp_path):
    catalog, rows = _big_catalog(spark, tmp_path)
    eligible = rows.select("image_id").filter("image_id <> 'i00'")
    meta = pipelines.build_split(spark, str(catalog), eligible, str(tmp_path / "split"))
    manifest = _rows(tmp_path / "split/manifest.jsonl")
    assert len(manifest) == 23 and meta["id"].startswith("split-")
    where = {}
    for r in manifest:
        assert where.setdefault(r["relationship_keys"][0], r["split"]) == r["split"]
    for group in ("fungi", "oomycetes"):
        assert {r["split"] for r in manifest if r["candidate_group"] == group} == {"train", "validation", "test"}
    left = _rows(tmp_path / "split/exclusions.jsonl")
    assert [x["image_id"] for x in left] == ["i00"] and left[0]["related_partition"] == where["k0"]
    schema = spark.read.json(str(tmp_path / "split/manifest.jsonl")).schema
    assert pipelines.read_manifest(spark, str(tmp_path / "split"), schema, "test").count() == sum(r["split"] == "test" for r in manifest)
    again = pipelines.build_split(spark, str(catalog), eligible, str(tmp_path / "split2"))
    assert again["id"] == meta["id"]
    with pytest.raises(ViolationError, match="output exists"):
        pipelines.build_split(spark, str(catalog), eligible, str(tmp_path / "split"))


def _review(i, sha, version=1, **more):
    return {"image_id": i, "image_sha256": sha, "annotation_version": version, "review_status": "adjudicated", "disposition": "eligible_single_group", "group_label": "fungi", "visible_evidence": "hyphae", "annotator_id": "a", "reviewer_id": "b",
            "usage_approved": True, "scope_approved": True, "usage_permission_ref": "x", "second_review_confirmed": True, **more}


def test_release(spark, tmp_path):
    catalog, rows = _big_catalog(spark, tmp_path)
    sha = {r["image_id"]: r["sha256"] for r in rows.collect()}
    lines = [_review("i00", sha["i00"]), _review("i01", sha["i01"], scope_approved=False), _review("i02", sha["i02"], usage_approved=False), _review("i02", sha["i02"], 2), _review("i13", sha["i13"], group_label="oomycetes", disposition="mixed")]
    (tmp_path / "reviews.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    (tmp_path / "assign.csv").write_text("﻿leakage_group_id,split\nlg-k0,train\nlg-k1,train\n", encoding="utf-8")
    go = lambda out, assign="assign.csv": pipelines.build_release(spark, str(catalog), str(tmp_path / "reviews.jsonl"), str(tmp_path / assign), str(tmp_path / out), "1")
    meta = go("release")
    assert sorted(r["image_id"] for r in _rows(tmp_path / "release/manifest.jsonl")) == ["i00", "i02"]
    reasons = {r["image_id"]: r["reasons"] for r in _rows(tmp_path / "release/exclusions.jsonl")}
    assert reasons["i01"] == ["scope_not_approved"] and reasons["i13"] == ["disposition:mixed"] and reasons["i05"] == ["unreviewed"]
    assert meta["class_split_counts"]["fungi"] == {"train": 2, "validation": 0, "test": 0} and meta["class_split_counts"]["oomycetes"]["test"] == 0
    (tmp_path / "cross.csv").write_text("leakage_group_id,split\nlg-k0,train\nlg-k1,test\n")
    with pytest.raises(ViolationError, match="crosses"):
        go("r2", "cross.csv")
    (tmp_path / "swapped.csv").write_text("split,leakage_group_id\ntrain,lg-k0\n")
    with pytest.raises(ViolationError, match="header"):
        go("r3", "swapped.csv")
    (tmp_path / "unknown.csv").write_text("leakage_group_id,split\nlg-zz,train\n")
    with pytest.raises(ViolationError, match="unknown groups"):
        go("r4", "unknown.csv")
    (tmp_path / "reviews.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines) + json.dumps(_review("i02", sha["i02"], 2)) + "\n")
    with pytest.raises(ViolationError, match="repeated review"):
        go("r5")
    (tmp_path / "reviews.jsonl").write_text('{"image_id": "i00", "image_id": "i01"}\n')
    with pytest.raises(ViolationError, match="invalid_json"):
        go("r6")


def _forged(source, target, metadata_name, prefix, **changes):
    """A copy of an artifact with changed files (lines -> lines) that is bound anew."""
    metadata = json.loads((source / metadata_name).read_text())

    def fill(staging):
        for p in source.iterdir():
            if p.is_file() and p.name != metadata_name:
                text = p.read_text()
                change = changes.get(p.stem) if p.suffix == ".jsonl" else None
                open(f"{staging}/{p.name}", "w").write("".join(json.dumps(r) + "\n" for r in change([json.loads(x) for x in text.splitlines()])) if change else text)
        return {k: v for k, v in metadata.items() if k not in ("id", "file_sha256")} | changes.get("metadata", {})

    sinks.publish(str(target), metadata_name, prefix, fill)
    return str(target)


def test_readers_check_everything(spark, tmp_path):
    catalog, rows = _big_catalog(spark, tmp_path)
    pipelines.build_split(spark, str(catalog), rows.select("image_id").filter("image_id <> 'i00'"), str(tmp_path / "split"))
    schema = "image_id string, split string"
    read = lambda i, **c: pipelines.read_manifest(spark, _forged(tmp_path / "split", tmp_path / f"s{i}", "split.json", "split", **c), schema)
    assert read(0).count() == 23
    manifest = _rows(tmp_path / "split/manifest.jsonl")
    a = next(r for r in manifest if r["split"] == "train")["image_id"]
    b = next(r for r in manifest if r["split"] == "test")["image_id"]

    def alike(**values):
        return lambda rs: [{**r, **values} if r["image_id"] in (a, b) else r for r in rs]

    def one(**values):
        return lambda rs: [{**r, **values} if r["image_id"] == a else r for r in rs]

    for i, values in enumerate([{"sha256": "0" * 64}, {"pixel_sha256": "0" * 64}, {"lineage": {"slide_id": "s"}}, {"lineage": {"parent_image_id": b}}], 1):
        with pytest.raises(ViolationError, match="known relations cross"):
            read(i, manifest=alike(**values))
    assert read(10, manifest=alike(lineage={"source_parent_id": None})).count() == 23
    other = next(r["split"] for r in manifest if r["relationship_keys"] != ["k0"] and r["split"] != next(x["split"] for x in manifest if x["image_id"] == "i01"))
    child = next(r["image_id"] for r in manifest if r["split"] == other)
    with pytest.raises(ViolationError, match="known relations cross"):  # a parent that is not eligible
        read(11, manifest=lambda rs: [{**r, "lineage": {"parent_image_id": "i00"}} if r["image_id"] == child else r for r in rs])
    with pytest.raises(ViolationError, match="unknown images"):
        read(12, manifest=one(canonical_image_id="none"))
    for i, (match, changes) in enumerate(
        [
            ("not as stated", {"manifest": lambda rs: rs[1:]}),
            ("targets or masks differ", {"manifest": one(genus_target=7)}),
            ("targets and masks", {"manifest": one(group_target=True)}),
            ("label map ids", {"taxonomy_map": lambda rs: [{**r, "id": bool(r["id"])} for r in rs]}),
            ("label maps differ", {"taxonomy_map": lambda rs: rs[1:]}),
            ("label supports differ", {"label_support": lambda rs: [{**r, "images": r["images"] + 1} for r in rs]}),
            ("group inventory", {"groups": lambda rs: rs[1:]}),
            ("taxonomy differs", {"manifest": one(taxonomy={"taxon_group": "fungi", "genus": "Fusarium", "species": None, "status": "single_taxon", "taxa": []})}),
        ],
        20,
    ):
        with pytest.raises(ViolationError, match=match):
            read(i, **changes)


def test_release_reader(spark, tmp_path):
    catalog, rows = _big_catalog(spark, tmp_path)
    sha = {r["image_id"]: r["sha256"] for r in rows.collect()}
    (tmp_path / "reviews.jsonl").write_text("".join(json.dumps(_review(i, sha[i])) + "\n" for i in ("i00", "i02")))
    (tmp_path / "assign.csv").write_text("leakage_group_id,split\nlg-k0,train\nlg-k1,train\n")
    pipelines.build_release(spark, str(catalog), str(tmp_path / "reviews.jsonl"), str(tmp_path / "assign.csv"), str(tmp_path / "release"), "1")
    read = lambda i, split=None, **c: pipelines.read_release(spark, _forged(tmp_path / "release", tmp_path / f"r{i}", "release.json", "release", **c), "image_id string, class_id bigint, split string", split)
    assert sorted(tuple(r) for r in read(0, "train").collect()) == [("i00", 0, "train"), ("i02", 0, "train")] and read(1, "test").count() == 0
    for i, (match, changes) in enumerate([("class map", {"metadata": {"class_map": {"fungi": False, "oomycetes": True}}}), ("ids of classes", {"manifest": lambda rs: [{**r, "class_id": "0"} for r in rs]}), ("class_id", {"manifest": lambda rs: [{**r, "class_id": 1} for r in rs]}), ("not as stated", {"manifest": lambda rs: rs[1:]})], 2):
        with pytest.raises(ViolationError, match=match):
            read(i, **changes)
