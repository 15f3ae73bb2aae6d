import datetime
import random

import pytest

from lamella.llm import splits, survivors

DELIVERIES = "delivery_id bigint, image_id string, feed string, checksum_verified boolean, delivered_at timestamp, relative_path string, sha256 string, pixel_sha256 string, lossless_transform_sha256 string, frame_count int, image_role string, source_url string, usage_permission_ref string, rank string, group_key string"
T0 = datetime.datetime(2024, 1, 1)


def day(n):
    return T0 + datetime.timedelta(days=n)


def delivery(no, image, verified=None, at=0, path=None, sha=None, pixel=None, lossless=None, frames=None, feed="publisher", role=None, url=None):
    return (no, image, feed, verified, None if at is None else day(at), path, sha, pixel, lossless, frames, role, url, None, "clash", "clash")


def fields(spark, rows):
    return {r["image_id"]: r for r in survivors.surviving_fields(spark.createDataFrame(rows, DELIVERIES)).collect()}


def test_precedence_by_field(spark):
    a, b, c = ("%064x" % i for i in (1, 2, 3))
    rows = [
        delivery(1, "x", True, 1, "old", a), delivery(2, "x", None, 9, "new", b), delivery(3, "x", True, 5, " ", "n/a", c.upper()), delivery(4, "x", True, 5, "-", None, f"sha256:{b}"),
        delivery(5, "y", False, 2, "p1"), delivery(6, "y", None, 2, "p2", "bad", None, None, 3), delivery(7, "y", None, None, "p3"), delivery(None, "y", True, 9, "p4"), delivery(8, None, True, 9, "p5"), delivery(2, "x", None, 9, "new", b),
    ]
    got = fields(spark, rows)
    assert (got["x"]["relative_path"], got["x"]["sha256"], got["x"]["pixel_sha256"]) == ("old", a, b)
    assert (got["y"]["relative_path"], got["y"]["sha256"], got["y"]["frame_count"]) == ("p2", None, 3)


def test_selection(spark):
    s, p, q, l = ("%064x" % i for i in (1, 2, 3, 4))  # noqa: E741
    rows = [
        delivery(1, "a", path="ö", sha=s, pixel=p, lossless=l, frames=1), delivery(2, "b", path="Z", sha=s, pixel=p, lossless=l, frames=1), delivery(3, "c", path="z", sha=None, pixel=p, lossless=l, frames=1), delivery(4, "d", path="zz", sha=q, pixel=q, lossless=l, frames=1),
        delivery(5, "e", path="1", sha=s, frames=None), delivery(6, "f", path="2", sha=s, frames=7), delivery(7, "g", path="3", sha=s, frames=1), delivery(8, "h", path=None, sha=s), delivery(9, "i"), delivery(10, "j"),
    ]
    got = {r["image_id"]: (r["canonical_image_id"], r["exclusion_reason"]) for r in survivors.selection(survivors.surviving_fields(spark.createDataFrame(rows, DELIVERIES))).collect()}
    file = "exact_file_duplicate"
    assert got == {"a": ("b", file), "b": ("b", None), "c": ("b", "exact_pixel_duplicate"), "d": ("b", "lossless_transform_duplicate"), "e": ("e", None), "f": ("e", file), "g": ("g", None), "h": ("e", file), "i": ("i", None), "j": ("j", None)}


def test_model_finds_the_liar(spark):
    rows, no = [], 0
    for i in range(120):
        for feed in ("good", "fair", "liar"):
            no += 1
            rows.append(delivery(no, f"i{i}", None, 0, feed=feed, role="crop" if feed != "liar" else f"odd{i % 7}"))
    df = spark.createDataFrame(rows, DELIVERIES)
    quality = {r["source"]: r for r in survivors.source_quality(df).filter("field = 'image_role'").collect()}
    assert quality["good/unverified"]["sensitivity"] > 0.9 > quality["liar/unverified"]["sensitivity"] and quality["liar/unverified"]["specificity"] < 0.5
    assert {r["value"] for r in survivors.true_values(df).filter("field = 'image_role'").collect()} == {"crop"}


def test_survivors_of_nothing(spark):
    df = spark.createDataFrame([], DELIVERIES)
    assert survivors.surviving_records(df).count() == survivors.source_quality(df).count() == 0
    one = survivors.surviving_records(spark.createDataFrame([delivery(1, "a", path="p"), delivery(2, "b")], DELIVERIES)).collect()
    assert {r["canonical_image_id"] for r in one} == {"a", "b"}


MANIFEST = "assignment_no bigint, image_id string, leakage_group_id string, split string, taxonomy struct<taxon_group:string,genus:string,species:string,status:string>, assigned_at timestamp, grp string, component string, size int, contributor string"
TAX = ("fungi", "G", "G s", "single_taxon")


def assignment(no, image, group, split, at=0, taxonomy=TAX, contributor=None):
    return (no, image, group, split, taxonomy, day(at), "clash", "clash", 1, contributor)


def test_torn_groups(spark):
    g, h, k = ("%016x" % i for i in (1, 2, 3))
    rows = [
        assignment(1, "a", f"lg-{g}", "train"), assignment(2, "b", f" LG-{g.upper()} ", "TEST\n"), assignment(3, "c", h, "training"), assignment(4, "d", f"lg-{h}", "Train"), assignment(5, "d", f"lg-{h}", "test", -1),
        assignment(6, "e", f"lg-{k}", "val"), assignment(7, "f", f"lg-{k}", "unassigned"), assignment(8, "g", f"lg-{k}", None), assignment(9, "h", None, "train"), assignment(10, "i", "lg-12", "train"), assignment(11, None, f"lg-{k}", "test"), assignment(1, "a", f"lg-{g}", "train"),
    ]
    assert [r[0] for r in splits.torn_groups(spark.createDataFrame(rows, MANIFEST)).collect()] == [f"lg-{g}"]
    assert splits.torn_groups(spark.createDataFrame([], MANIFEST)).count() == 0


def test_grouped_split(spark):
    rows, no = [], 0
    for g in range(400):
        for _ in range(1 + g % 4):
            no += 1
            rows.append(assignment(no, f"i{no}", "%016x" % g, None, taxonomy=("fungi", f"G{g % 5}", f"G{g % 5} s{g % 20}", "x")))
    for i in range(150):
        rows.append(assignment(1000 + i, f"x{i}", "f" * 16, None, taxonomy=None))
    rows += [assignment(2000 + i, f"y{i}", None, None, taxonomy=("fungi", "G0", None, "x")) for i in range(50)]
    out = splits.grouped_split(spark.createDataFrame(rows, MANIFEST)).collect()
    assert len(out) == len({r["image_id"] for r in out}) == len(rows)
    where = {}
    for r in out:
        assert where.setdefault(r["component"], r["split"]) == r["split"]
    by_id = {r[1]: r for r in rows}
    for genus in range(5):
        share = [r["split"] for r in out if by_id[r["image_id"]][4] and by_id[r["image_id"]][4][1] == f"G{genus}"]
        assert share.count("train") / len(share) == pytest.approx(0.7, abs=0.05) and share.count("test") / len(share) == pytest.approx(0.15, abs=0.05)
    again = {r["image_id"]: r["split"] for r in splits.grouped_split(spark.createDataFrame(rows[::-1], MANIFEST)).collect()}
    assert again == {r["image_id"]: r["split"] for r in out}
    assert splits.grouped_split(spark.createDataFrame([], MANIFEST)).count() == 0


def test_rarest_outstanding_label_goes_first():
    # Two labels: after the first component of the rarer one the other is the rarest, so it goes next.
    classes = {1: (1, {"all": 6.0, "a": 6.0}), 2: (1, {"all": 5.0, "a": 5.0}), 3: (1, {"all": 12.0, "b": 12.0}), 4: (1, {"all": 3.0, "b": 3.0, "a": 1.0})}
    totals = {"all": 26.0, "a": 12.0, "b": 15.0}
    placed = splits.place(classes, totals, (0.5, 0.25, 0.25))
    assert all(sum(v) == 1 for v in placed.values()) and set(placed) == {1, 2, 3, 4}
    # 1 (a, largest) goes where a is needed most; then a has 6 outstanding, still the rarest, so 2 goes to the next; 4 holds a too.
    assert placed[1] == [1, 0, 0] and placed[2] in ([0, 1, 0], [0, 0, 1])


def test_whole_vectors_and_single_classes_are_used_up():
    classes = {k: (1000, {"all": 1.0, f"l{k}": 1.0}) for k in range(5)}
    placed = splits.place(classes, {"all": 5000.0, **{f"l{k}": 1000.0 for k in range(5)}})
    for got in placed.values():
        assert sum(got) == 1000 and abs(got[0] - 700) <= 35 and abs(got[1] - 150) <= 35


def test_coarser_classes_keep_components_whole(spark, monkeypatch):
    rows, no = [], 0
    for g in range(120):
        for i in range(1 + g % 50):
            no += 1
            rows.append(assignment(no, f"i{no}", "%016x" % g, None, taxonomy=("fungi", f"G{(g + i) % 7}", None, "x")))
    table = spark.createDataFrame(rows, MANIFEST)
    for most in (200_000, 100, 3):
        monkeypatch.setattr(splits, "MAX_CLASSES", most)
        got = splits.split_check(table).first()
        assert (got["images"], got["components"], got["torn"], got["unassigned"], got["near_target"]) == (no, 120, 0, 0, True)


def one_by_one(classes, totals, ratios=(14, 3, 3)):
    """Every component placed by itself, by its own vector: the method without any shortcut. ratios: twentieths."""
    need, outstanding = {x: [r * n for r in ratios] for x, n in totals.items()}, dict(totals)
    left, placed = {k: m for k, (m, _) in classes.items()}, {k: [0, 0, 0] for k in classes}
    while any(left.values()):
        label = min((x for x in outstanding if outstanding[x]), key=lambda x: (x == "all", outstanding[x], x))
        key = min((k for k in classes if left[k] and label in classes[k][1]), key=lambda k: (-classes[k][1][label], -classes[k][1]["all"], k))
        best = max(range(3), key=lambda s: (need[label][s], need["all"][s], -s))
        placed[key][best] += 1
        left[key] -= 1
        for x, n in classes[key][1].items():
            need[x][best] -= 20 * n
            outstanding[x] -= n
    return placed


def test_classes_are_placed_as_their_components_one_by_one():
    for seed in range(40):
        draw = random.Random(seed)
        classes = {}
        for k in range(draw.randint(1, 12)):
            vector = {f"l{x}": draw.choice((1, 1, 2, 7, 40)) for x in range(6) if draw.random() < 0.5}
            classes[k] = (draw.choice((1, 2, 90, 400)), {**vector, "all": max([1, *vector.values()]) + draw.randint(0, 3)})
        totals = {x: sum(m * v.get(x, 0) for m, v in classes.values()) for x in {x for _, v in classes.values() for x in v}}
        assert splits.place(classes, totals) == one_by_one(classes, totals), seed


def test_number_of_classes_changes_no_result(spark, monkeypatch):
    """More different vectors than MAX_CLASSES, counts above 32 among them: the same split as of few, that of the vectors themselves."""
    rows, no = [], 0
    for g in range(150):
        for i in range(1 + g % 50 if g % 3 else 2):
            no += 1
            rows.append(assignment(no, f"i{no}", "%016x" % g, None, taxonomy=("fungi", f"G{(g % 3 + i) % 7}", None, "x")))
    table = spark.createDataFrame(rows, MANIFEST)
    got = []
    for most in (200_000, 40, 3):
        monkeypatch.setattr(splits, "MAX_CLASSES", most)
        got.append({r["image_id"]: (r["component"], r["split"]) for r in splits.grouped_split(table).collect()})
    assert got[0] == got[1] == got[2] and len(got[0]) == no
    vectors, where = {}, {}
    for r in rows:
        component, where[component] = got[0][r[1]]
        vector = vectors.setdefault(component, {})
        for x in ("all", "genus:" + r[4][1], "taxon_group:fungi"):
            vector[x] = vector.get(x, 0) + 1
    alike = {}
    for component, vector in vectors.items():
        alike.setdefault(tuple(sorted(vector.items(), key=lambda x: (x[0] == "all", x))), []).append(where[component])
    keys = sorted(alike, key=lambda v: (-dict(v)["all"], v))
    classes = {k: (len(alike[v]), dict(v)) for k, v in enumerate(keys)}
    totals = {x: sum(m * v.get(x, 0) for m, v in classes.values()) for x in {x for v in vectors.values() for x in v}}
    assert {k: [alike[v].count(s) for s in splits.SPLITS] for k, v in enumerate(keys)} == one_by_one(classes, totals)
    assert len(classes) > 40


def test_relations_join_groups(spark):
    rows = [assignment(i, f"i{i}", "%016x" % (i // 2), None, contributor=f"c{i % 40}") for i in range(200)] + [assignment(900, "n1", "e" * 16, None, contributor="unknown"), assignment(901, "n2", "d" * 16, None, contributor="Unknown ")]
    table = spark.createDataFrame(rows, MANIFEST)
    alone, joined = splits.split_report(table).first(), splits.split_report(table, relations=("contributor",)).first()
    assert alone["torn_contributor"] > 0 and joined["torn_contributor"] == 0 and joined["torn"] == joined["unassigned"] == 0
    assert alone["components"] == 102 and joined["components"] == 22  # contributors 2k and 2k + 1 share groups; the two unknown ones stay apart


def test_quality_model_converges(spark):
    """A reliable source and one that makes values up: the model tells them apart, and ends."""
    rows, no = [], 0
    for i in range(300):
        for feed, url in (("good", f"u{i}"), ("fine", f"u{i}"), ("bad", f"u{i}" if i % 3 == 0 else f"made-up-{i}")):
            no += 1
            rows.append(delivery(no, f"i{i}", True, feed=feed, url=url))
    quality = {r["source"]: r for r in survivors.source_quality(spark.createDataFrame(rows, DELIVERIES)).filter("field = 'source_url'").collect()}
    assert quality["good/verified"]["sensitivity"] > quality["bad/verified"]["sensitivity"] and quality["good/verified"]["specificity"] > quality["bad/verified"]["specificity"]
    kept = {(r["image_id"], r["value"]) for r in survivors.true_values(spark.createDataFrame(rows, DELIVERIES)).filter("field = 'source_url'").collect()}
    assert kept == {(f"i{i}", f"u{i}") for i in range(300)}


def test_judged_fields_take_the_most_probable(spark):
    rows = [delivery(1, "a", True, 1, path="p", feed="x"), delivery(2, "a", True, 2, path="p", feed="y"), delivery(3, "a", True, 3, path="q", feed="z"), delivery(4, "b", None, 1)]
    got = {r["image_id"]: r["relative_path"] for r in survivors.judged_fields(spark.createDataFrame(rows, DELIVERIES)).collect()}
    assert got == {"a": "p", "b": None}
    assert survivors.judged_fields(spark.createDataFrame([], DELIVERIES)).count() == 0
