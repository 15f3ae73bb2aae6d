import io
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.operators.checks import ViolationError
from lamella.sources import archives, boxes, inventory, lines, manifests, rasters, sinks
from tests.tree import pattern, png, write_tree


def test_inventory(spark, tmp_path):
    write_tree(tmp_path)
    rows = inventory.read_inventory(spark, str(tmp_path))
    assert rows.count() == 9 and [r["path"] for r in rows.collect()] == sorted(r["path"] for r in rows.collect())
    assert inventory.coverage(rows, inventory.image_files(spark, str(tmp_path))).isEmpty()
    assert inventory.changed_files(rows, inventory.files(spark, str(tmp_path), content=True)).isEmpty()
    text = (tmp_path / "image_inventory.csv").read_text()
    for change, message in ((lambda t: t.replace("01_tgfc,", "09_x,", 1), "unknown_collection"), (lambda t: t + t.splitlines()[1] + "\n", "repeated"), (lambda t: t.replace("sha256", "sha", 1), "lacks"), (lambda t: t.splitlines()[0] + "\n", "empty"), (lambda t: t.replace(",32,", ",wide,", 1), "width")):
        (tmp_path / "image_inventory.csv").write_text(change(text))
        with pytest.raises(ViolationError, match=message):
            inventory.read_inventory(spark, str(tmp_path))


def test_manifests(spark, tmp_path):
    write_tree(tmp_path)
    assert manifests.downloads(spark, str(tmp_path)).count() == 5
    assert manifests.completeness(spark, str(tmp_path)).filter("not complete").isEmpty()
    path = tmp_path / "03_soil_fungi_phytophthora/download_manifest.json"
    value = json.loads(path.read_text())
    path.write_text(json.dumps({**value, "downloads": value["downloads"] * 2}))
    with pytest.raises(ViolationError, match="repeated"):
        manifests.downloads(spark, str(tmp_path))
    assert manifests.completeness(spark, str(tmp_path)).filter("not complete").count() == 1
    path.write_text(json.dumps({**value, "errors": ["x"]}))
    with pytest.raises(ViolationError, match="errors remain"):
        manifests.source_registry(str(tmp_path))


@pytest.mark.parametrize("text", ["nc: 2\nnames: [a, 'b c']\n", "names:\n  0: a\n  1: b c\nnc: 2\n", "nc: 2\nnames:\n- a\n- b c\n"])
def test_class_map(text):
    assert manifests.class_map(text) == {0: "a", 1: "b c"}


@pytest.mark.parametrize("text", ["nc: 3\nnames: [a, b]\n", "nc: 2\nnames:\n  0: a\n  2: b\n", "nc: 0\n"])
def test_bad_class_map(text):
    with pytest.raises(ViolationError):
        manifests.class_map(text)


def test_boxes(spark):
    text = "0 0.5 0.5 0.25 0.25\n\n 1\t0.1 0.2 0.1 0.1 \r\n7 0 0 1 1\n0 nan 0 1 1\n0 0 0 0 1\n0 0 0 1\n0 0 0 1.5 1\nx 0 0 1 1"
    found = boxes.labelled_boxes(boxes.boxes(spark.createDataFrame([("p", text)], "path string, text string"), "path"), spark.createDataFrame([(0, "a"), (1, "b")], "class_id int, label string"))
    assert {r["line"]: (r["label"], r["error"]) for r in found.collect()} == {
        1: ("a", None), 3: ("b", None), 4: (None, "unknown_class"), 5: ("a", "outside"), 6: ("a", "empty_box"), 7: ("a", "token_count"), 8: ("a", "outside"), 9: (None, "not_a_number")
    }


@pytest.mark.parametrize(("line", "error"), [("", "blank_line"), ("[1]", "not_an_object"), ('{"a": 1, "a": 2}', "invalid_json"), ("{", "invalid_json"), ('{"z": 1}', "unknown_field"), ('{"a": 1}', None)])
def test_strict_lines(spark, tmp_path, line, error):
    (tmp_path / "x.jsonl").write_text('{"a": 5}\n' + line + "\n")
    if error:
        with pytest.raises(ViolationError, match=error):
            lines.read_strict(spark, str(tmp_path / "x.jsonl"), "a INT")
    else:
        assert [r["a"] for r in lines.read_strict(spark, str(tmp_path / "x.jsonl"), "a INT").collect()] == [5, 1]


def test_typed_fields(spark):
    df = spark.createDataFrame([('{"v": 1}',), ('{"v": "1"}',), ('{"v": true}',), ("{",)], "l string")
    assert [r[0] for r in df.select(lines.typed_field(F.col("l"), "v", "BIGINT")).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(lines.typed_field(F.col("l"), "v", "BOOLEAN")).collect()] == [False, False, True, False]


def test_formats_and_frames():
    tiff = lambda n: b"II*\0" + struct.pack("<I", 8) + b"".join(struct.pack("<HI", 0, 8 + 6 * (i + 1) if i < n - 1 else 0) for i in range(n))
    frame = b"\x2c" + b"\0" * 8 + b"\0" + b"\x02\x01\x00\x00"
    gif = lambda n: b"GIF89a" + b"\0" * 4 + b"\0\0\0" + b"\x21\xfe\x01a\0" + frame * n + b"\x3b"
    assert [rasters.frame_count(x) for x in (tiff(1), tiff(3), gif(1), gif(2), png(pattern(1)))] == [1, 3, 1, 2, 1]
    assert [rasters.image_format(x) for x in (tiff(1), gif(1), png(pattern(1)), b"\xff\xd8\xff\xe0", b"BM..", b"text")] == ["TIFF", "GIF", "PNG", "JPEG", "BMP", None]


def test_fingerprints():
    rgb = np.fromfunction(lambda y, x, c: np.choose(c.astype(int), [(13 * x + 7 * y) % 256, (3 * x * y) % 256, (x + 11 * y) % 256]), (23, 31, 3)).astype(np.uint8)
    pixel, lossless, bits = rasters.fingerprints(rgb)
    variants = [rasters.fingerprints(v) for v in rasters.symmetries(rgb)]
    assert len({v[0] for v in variants}) == 8 and {v[1] for v in variants} == {lossless} and len(bits) == 16
    assert rasters.fingerprints(np.full((8, 9, 3), 7, np.uint8))[2] == "0" * 16
    ramp = np.repeat(np.arange(90, 0, -1, dtype=np.uint8)[None, :, None], 16, 0).repeat(3, 2)
    assert rasters.fingerprints(ramp)[2] == "f" * 16


def test_raster_facts(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(pattern(1)))
    (tmp_path / "bad.png").write_bytes(b"no image")
    got = {r["path"].split("/")[-1]: r for r in rasters.raster_facts(spark, str(tmp_path)).collect()}
    assert got["a.png"]["pixel_sha256"] == rasters.pixel_hash(pattern(1)) and (got["a.png"]["width"], got["a.png"]["height"]) == (32, 24)
    assert got["bad.png"]["height"] == -1 and got["bad.png"]["pixel_sha256"] is None


def test_tensor(spark, tmp_path):
    config = rasters.TensorConfig(8, (0.5, 0.25, 0.75), (1.0, 1.0, 1.0))
    white = rasters.to_tensor(np.full((4, 1, 3), 255, np.uint8), config)
    assert white.shape == (3, 8, 8) and np.allclose(white[:, 3, 3], [0.5, 0.75, 0.25]) and np.allclose(white[:, 0, 0], np.array([128, 64, 191]) / 255 - [0.5, 0.25, 0.75], atol=1e-6)
    assert rasters.TensorConfig.from_dict(config.to_dict()) == config
    for bad in ({"image_size": 0}, {"image_size": True}, {"mean": (2, 0, 0)}, {"std": (0, 1, 1)}, {"mean": (float("nan"), 0, 0)}):
        with pytest.raises(ViolationError):
            rasters.TensorConfig(**bad)
    (tmp_path / "a.png").write_bytes(png(pattern(3)))
    images = rasters.read_images(spark, str(tmp_path)).select("image.*")
    value = rasters.tensors(images, ["origin"], "origin string", config).first()["value"]
    assert np.allclose(value, rasters.to_tensor(pattern(3), config).ravel(), atol=1e-6)


def test_archive(spark):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a/x.PNG", b"123")
        z.writestr("a/y.txt", b"4")
    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("../x.png", b"1")
    df = spark.createDataFrame([("ok.zip", raw.getvalue()), ("bad.zip", bad.getvalue())], "path string, content binary")
    assert {tuple(r) for r in archives.archive_totals(archives.entries(df), inventory.IMAGE_SUFFIXES).collect()} == {("ok.zip", 2, 1, 4, None), ("bad.zip", 1, 1, 1, "unsafe_path")}


def test_csv_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("b", None, ["x"]), ('a"q,', 1, None)], "k string, n int, l array<string>")
    sinks.write_csv(df, str(tmp_path / "x.csv"), "k")
    assert (tmp_path / "x.csv").read_bytes() == b'k,n,l\r\n"a""q,",1,\r\nb,,"[""x""]"\r\n'
    sinks.write_lines(df, str(tmp_path / "x.jsonl"), "k")
    assert (tmp_path / "x.jsonl").read_text() == '{"k":"a\\"q,","l":null,"n":1}\n{"k":"b","l":["x"],"n":null}\n'
    sinks.write_partitions(df.withColumn("split", F.lit("train")), str(tmp_path / "p"))
    assert (tmp_path / "p/split=train").is_dir()


def test_publish_fails_clean(tmp_path):
    def broken(staging):
        open(f"{staging}/x", "w").close()
        raise RuntimeError

    with pytest.raises(RuntimeError):
        sinks.publish(str(tmp_path / "out"), "m.json", "m", broken)
    assert list(tmp_path.iterdir()) == []
    sinks.publish(str(tmp_path / "out"), "m.json", "m", lambda s: {"a": 1})
    with pytest.raises(ViolationError, match="exists"):
        sinks.publish(str(tmp_path / "out"), "m.json", "m", lambda s: {"a": 2})
    sinks.verify_bound(str(tmp_path / "out"), "m.json", "m")
    with pytest.raises(ViolationError):
        sinks.check_isolated(str(tmp_path / "out/in"), str(tmp_path / "out"))


def test_bound_hashes_by_executors(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"1")
    (tmp_path / "b").write_bytes(b"2")
    bound = {**sinks.file_hashes(str(tmp_path)), "c": "0" * 64}
    (tmp_path / "b").write_bytes(b"3")
    assert {tuple(r) for r in sinks.bound_hash_mismatches(spark, str(tmp_path), bound).collect()} == {("b", "differs"), ("c", "missing")}


def test_links_and_tensor_file(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.png").write_bytes(b"x")
    sinks.link_tree([("a.png", "images/train/fungi/1.png")], str(tmp_path / "raw"), str(tmp_path / "out"))
    assert (tmp_path / "out/images/train/fungi/1.png").read_bytes() == b"x" and (tmp_path / "out/images/train/fungi/1.png").is_symlink()
    sinks.write_tensor(str(tmp_path / "t.npz"), np.zeros(3, np.float32), {"a": 1})
    with pytest.raises(ViolationError):
        sinks.write_tensor(str(tmp_path / "t.npz"), np.zeros(3), {})
