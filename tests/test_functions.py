import base64
import hashlib
import json
import uuid

import pytest
from pyspark.sql import functions as F

from lamella.functions import codes, flags, hashing, ids, paths, scan, taxa
from lamella.functions.digests import hash64, named, sha256_hex


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if not isinstance(v, int) else 'bigint'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


def many(spark, values, column, ddl="string"):
    return [r["x"] for r in spark.createDataFrame([(v,) for v in values], f"v {ddl}").select(column.alias("x")).collect()]


def test_digest_forms(spark):
    h = hashlib.sha256(b"x").hexdigest()
    colons = ":".join(h[i : i + 2] for i in range(0, 64, 2))
    good = [h, h.upper(), f" {h}\n", f"sha256:{h}", f"SHA-256={h.upper()}", colons]
    raw = bytes.fromhex(h)
    coded = base64.b64encode(raw).decode()
    good += [coded, f" {coded}\n", coded.rstrip("="), base64.urlsafe_b64encode(raw).decode(), f"sha256-{coded}", f"sha256:{coded}"]
    assert many(spark, good, sha256_hex(F.col("v"))) == [h] * len(good)
    marked = [bytes([i]) * 31 + b"\xfb" for i in (0xFB, 0xFF, 0x3E)]  # + and / in the one alphabet, - and _ in the other
    both = [f(m).decode() for m in marked for f in (base64.b64encode, base64.urlsafe_b64encode)]
    assert many(spark, both, sha256_hex(F.col("v"))) == [m.hex() for m in marked for _ in range(2)]
    assert many(spark, [coded[:-2], coded[1:], coded[:-2] + "B=", coded + "A"], sha256_hex(F.col("v"))) == [None] * 4
    assert many(spark, [None, "", "-", "n/a", "pending", h[:-1], h + "0", h[:40]], sha256_hex(F.col("v"))) == [None] * 8


def test_hash_forms(spark):
    h = 0xA5A5A5A5000000FF
    signed = h - (1 << 64)
    good = [f"{h:016x}", f"0x{h:016X}", f" {h:016x} ", f"{h:016x}"[:8] + "-" + f"{h:016x}"[8:], f"{h:064b}"]
    assert many(spark, good, hash64(F.col("v"))) == [signed] * len(good)
    assert many(spark, [None, "", "none", "a5a5", "2" * 64], hash64(F.col("v"))) == [None] * 5


def test_named(spark):
    assert many(spark, [" A b ", "UNKNOWN ", "?", None, "n/a", "Not Recorded"], named(F.col("v"))) == ["a b", None, None, None, None, None]


def test_uuid5_and_json(spark):
    for name in ("lamella:tgfc:a/b.png", "ö:ß", ""):
        assert one(spark, ids.uuid5_url(F.col("n")), n=name) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))
    text = one(spark, ids.canonical_json({"b": F.col("b"), "a": F.col("a"), "n": F.lit(None).cast("string")}), a="ü\"", b=3)
    assert text == ids.python_canonical_json({"a": 'ü"', "b": 3, "n": None})
    with pytest.raises(ValueError):
        ids.python_canonical_json(float("nan"))


def test_group_ids_do_not_depend_on_order(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "m string")
    b = spark.createDataFrame([("z",), ("x",), ("y",)], "m string").repartition(3)
    for f in (ids.member_list_id, ids.group_digest):
        assert a.agg(f("g-", F.col("m"))).first() == b.agg(f("g-", F.col("m"))).first() != a.filter("m <> 'y'").agg(f("g-", F.col("m"))).first()
    assert a.agg(ids.member_list_id("g-", F.col("m"))).first()[0] == "g-" + hashlib.sha256(json.dumps(["x", "y", "z"], separators=(",", ":")).encode()).hexdigest()[:16]


def test_paths(spark):
    cases = {"a/b.png": (True, True, True), "/a": (False, False, False), "a/../b": (False, False, False), "a\\b": (False, False, False), "": (False, False, False), "a//b": (True, False, False), "./a": (True, False, False), "c:/x": (True, True, False), None: (False, False, False)}
    for f, i in ((paths.is_safe, 0), (paths.is_normal, 1), (paths.is_portable, 2)):
        assert many(spark, list(cases), f(F.col("v"))) == [c[i] for c in cases.values()]
    assert many(spark, ["a/b.tar.GZ", ".hidden", "x", "d/e."], paths.suffix(F.col("v"))) == [".gz", "", "", ""]
    assert many(spark, ["a/b.tar.gz", ".hidden", "x"], paths.stem(F.col("v"))) == ["b.tar", ".hidden", "x"]
    assert [tuple(r) for r in many(spark, ["Fusarium_12.png", "Fusarium_12_crop_1.png"], paths.sample_name(F.col("v")))] == [("Fusarium", "Fusarium_12", "full_field"), ("Fusarium", "Fusarium_12", "crop")]
    url = F.col("v")
    assert many(spark, ["https://u@Ex.org:8/x?y#z", "nope"], F.concat_ws("|", paths.scheme(url), paths.host(url), paths.url_path(url))) == ["https|ex.org|/x", "||"]
    assert many(spark, ["https://ex.org/a", "http://ex.org/a", "https://evil.org/a", None], paths.may_fetch(url, F.lit("a.zip"), ["ex.org"])) == [True, False, False, False]
    assert one(spark, paths.may_fetch(F.col("u"), F.lit("../a"), ["ex.org"]), u="https://ex.org") is False


def test_bits(spark):
    assert one(spark, hashing.hamming(F.col("a"), F.col("b")), a=-1, b=0) == 64
    assert one(spark, hashing.hex64(F.col("a")), a=-1) == "f" * 16
    assert one(spark, hashing.falling_bits([F.lit(3), F.lit(2), F.lit(2), F.lit(1)]), a=1) == 0b101
    df = spark.range(1).select(F.lit(-6510615555426900571).cast("bigint").alias("h"))
    bands = df.select(*(hashing.band(F.col("h"), i) for i in range(3))).first()
    h = 0xA5A5A5A5A5A5A5A5
    assert list(bands) == [h & (1 << 22) - 1, h >> 22 & (1 << 21) - 1, h >> 43]


def test_flags(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (None,)], "f array<string>")
    assert [r[0] for r in df.select(flags.add_flags(F.col("f"), {"c": F.lit(True), "d": F.lit(False), "e": F.lit(None).cast("boolean")})).collect()] == [["a", "b", "c"], ["c"]]
    assert [r[0] for r in df.select(flags.drop_flags(F.col("f"), "a")).collect()] == [["b"], []]
    assert df.select(flags.is_unique(F.col("f"))).first()[0] is False


@pytest.mark.parametrize(
    ("text", "rules"),
    [
        ("see /Users/anna/x", ["personal-machine-path"]), ("C:\\Users\\anna\\x", ["personal-machine-path"]), ("a.b@c.org", ["email-address"]), ("https://u:p@host/x", ["authenticated-url"]),
        ("-----BEGIN RSA PRIVATE KEY-----", ["private-key"]), ("ghp_" + "a" * 20, ["credential-token"]), ("api_key = 'abcdefgh1'", ["credential-assignment"]), ("nothing here", []), ("", []),
    ],
)
def test_text_rules(spark, text, rules):
    assert one(spark, scan.text_findings(F.col("t")), t=text) == rules


def test_file_rules(spark):
    rows = [("a/model.tar.pt", 3, b"abc"), ("b.txt", 2, b"\xff\xfe"), ("c.txt", 3, b"a\0b"), ("d.txt", 2_000_000, b"x"), ("e.webp", 1, b"x"), ("f.webp", 1, b"y"), ("g.md", 1, b"ok")]
    found = scan.file_findings(spark.createDataFrame(rows, "path string, length bigint, content binary"), {"e.webp": hashlib.sha256(b"x").hexdigest(), "f.webp": "0" * 64})
    assert [tuple(r) for r in found.collect()] == [("a/model.tar.pt", "dataset-or-model-artifact"), ("b.txt", "non-UTF8-file"), ("c.txt", "binary-file"), ("d.txt", "over-1-MiB"), ("f.webp", "public-asset-sha256-mismatch")]


@pytest.mark.parametrize(
    ("source", "label", "want"),
    [
        ("tgfc", "Olivea tectonae", ("fungi", "Olivea", "Olivea tectonae", "species")), ("tgfc", "Neopestalotiopsis sp.", ("fungi", "Neopestalotiopsis", None, "genus")), ("tgfc", "MixedClass", ("fungi", None, None, "group")),
        ("soil", "Phytophtora", ("oomycetes", "Phytophthora", None, "genus")), ("soil", "Other", (None, None, None, "unresolved")),
        ("idphy", "Phytophthora ramorum", ("oomycetes", "Phytophthora", "Phytophthora ramorum", "species")), ("idphy", "Phytophthora x-y (in progress, new)", ("oomycetes", "Phytophthora", "Phytophthora x-y", "species")),
        ("idphy", "Phytophthora sp", ("oomycetes", "Phytophthora", None, "genus")), ("idphy", "Phytophthora Ramorum", ("oomycetes", "Phytophthora", None, "genus")), ("idphy", "Phytophthora", ("oomycetes", "Phytophthora", None, "genus")), ("idphy", "Phytophthoraceae", (None, None, None, "unresolved")),
    ],
)
def test_taxon(spark, source, label, want):
    t = one(spark, taxa.taxon(F.col("s"), F.col("l"), F.lit(None).cast("string")), s=source, l=label)
    assert (t["taxon_group"], t["genus"], t["species"], t["rank"]) == want and t["source_label"] == label


def test_consensus(spark):
    def of(labels, groups):
        df = spark.createDataFrame([(labels, groups)], "l array<string>, g array<string>")
        t = df.select(taxa.taxonomy(F.lit("tgfc"), F.col("l"), F.col("g")).alias("t")).first()["t"]
        return t["taxon_group"], t["genus"], t["species"], t["status"]

    assert of(["Olivea tectonae"], ["fungi"]) == ("fungi", "Olivea", "Olivea tectonae", "single_taxon")
    assert of(["Olivea tectonae", "Colletotrichum siamense"], ["fungi"]) == ("fungi", None, None, "multiple_taxa")
    assert of([], ["fungi"]) == ("fungi", None, None, "group_only")
    assert of([], []) == (None, None, None, "unresolved")
    assert of(["odd"], []) == (None, None, None, "unresolved")
    assert of(["odd", "MixedClass"], []) == (None, None, None, "multiple_taxa")


def test_codes_stay_apart(spark):
    got = {(r["namespace"], r["identifier"]) for r in one(spark, codes.references(F.col("t")), t="PH168, P168, cphst bl 168 and CBS 12.5; CH98UK1 VI 3-ab, AKWA 58.1-0708, RHS 2")}
    assert got == {("PH", "168"), ("P", "168"), ("CPHST_BL", "168"), ("CBS", "12.5"), ("CH", "98UK1"), ("VI", "3-ab"), ("AKWA", "58.1-0708"), ("RHS", "2")}
