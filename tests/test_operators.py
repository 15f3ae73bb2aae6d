import itertools
import random

import pytest
from pyspark.sql import functions as F

from lamella.operators import checks, curation, graph, labels, reviews, splitting, summaries


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    hashes = base + [b ^ sum(1 << i for i in rng.sample(range(64), rng.choice((0, 1, 2, 3)))) for b in base for _ in range(3)] + [0, (1 << 64) - 1, 1, 3]
    rows = list(enumerate(hashes))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    got = {tuple(r) for r in curation.near_pairs(spark.createDataFrame([(i, signed(h)) for i, h in rows], "k bigint, h bigint"), "k", "h").collect()}
    want = {(a, b, (x ^ y).bit_count()) for (a, x), (b, y) in itertools.combinations(rows, 2) if (x ^ y).bit_count() <= 2 and all(4 <= z.bit_count() <= 60 for z in (x, y))}
    assert got == want
    with pytest.raises(ValueError):
        curation.near_pairs(spark.range(1).withColumn("h", F.col("id")), "id", "h", 3)


@pytest.mark.parametrize(("seed", "last"), [(0, 100_000), (1, 0), (2, 40)])
def test_components_equal_union_find(spark, monkeypatch, seed, last):
    monkeypatch.setattr(graph, "LAST_EDGES", last)
    rng = random.Random(seed)
    n = 300
    edges = [(f"n{rng.randrange(n):03}", f"n{rng.randrange(n):03}") for _ in range(220)] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(100, 160)] + [("n000", f"n{i:03}") for i in range(200, 240)]
    parent = {f"n{i:03}": f"n{i:03}" for i in range(n)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = dict(map(tuple, graph.components(spark.createDataFrame([(x,) for x in parent], "node string"), spark.createDataFrame(edges, "u string, v string")).collect()))
    assert got == {x: find(x) for x in parent}


def test_components_without_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("a",)], "node string")
    assert sorted(map(tuple, graph.components(nodes, spark.createDataFrame([], "u string, v string")).collect())) == [("a", "a"), ("b", "b")]


def _records(spark, rows):
    ddl = "image_id string, source_id string, sha256 string, pixel_sha256 string, lossless_transform_sha256 string, frame_count int, relationship_keys array<string>, lineage map<string,string>, canonical_image_id string, leakage_group_id string"
    return spark.createDataFrame(rows, ddl)


def test_rule_sets(spark):
    rows = [
        ("a", "s1", "f1", "p1", "l1", 2, ["k"], {"source_parent_id": "x"}, None, "g1"),
        ("b", "s1", "f2", "p1", "l2", 2, [], {"source_parent_id": "x"}, None, "g2"),
        ("c", "s2", "f3", "p1", "l3", 1, [], {"source_parent_id": "x"}, None, "g3"),
        ("d", "s2", "f4", None, "l4", 1, ["k"], {"odd_id": "z", "tree_id": ""}, None, "g4"),
        ("e", "s3", "f5", None, "l5", 1, [], {"odd_id": "z"}, "c", "g5"),
        ("f", "s4", "f6", None, None, 1, None, None, None, "g6"),
    ]
    r = _records(spark, rows)
    split = dict(map(tuple, graph.observed_groups(r).collect()))
    # Several frames: equal pixels do not link; the parent id counts within a source; any lineage key and canonical ids link.
    assert split == {"a": "a", "b": "a", "d": "a", "e": "a", "c": "a", "f": "f"}
    sources = dict(map(tuple, graph.components(r.select(F.col("source_id").alias("node")), graph.star_edges(graph.catalog_tokens(r).distinct())).collect()))
    assert sources == {"s1": "s1", "s2": "s1", "s3": "s3", "s4": "s4"}
    groups = lambda t: dict(map(tuple, graph.components(r.select(F.col("leakage_group_id").alias("node")), graph.star_edges(t.distinct())).collect()))
    assert groups(graph.release_tokens(r, with_source=False)) == {"g1": "g1", "g2": "g1", "g3": "g1", "g4": "g1", "g5": "g1", "g6": "g6"}
    pairs = spark.createDataFrame([("f", "a")], "image_id_a string, image_id_b string")
    assert dict(map(tuple, graph.observed_groups(r, pairs).collect()))["f"] == "a"


def test_curate(spark):
    ddl = "image_id string, relative_path string, sha256 string, pixel_sha256 string, lossless_transform_sha256 string, frame_count int, candidate_groups array<string>, genus string, species string"
    rows = [
        ("1", "b", "f", "p", "l", 1, ["fungi"], "A", None), ("2", "a", "f", "p", "l", 1, ["fungi"], None, None), ("3", "c", "g", "p", "l", 1, ["fungi"], "B", None), ("4", "d", "h", "q", "l", 1, ["fungi"], None, None),
        ("5", "e", "m", "p", "l", 2, [], None, None), ("6", "f", "m", "p", "l", 2, [], None, None), ("7", "g", None, None, None, None, None, None, None),
    ]
    got = {r["image_id"]: r for r in curation.curate(spark.createDataFrame(rows, ddl)).collect()}
    assert {k: v["exclusion_reason"] for k, v in got.items()} == {"1": "exact_file_duplicate", "2": None, "3": "exact_pixel_duplicate", "4": "lossless_transform_duplicate", "5": None, "6": "exact_file_duplicate", "7": None}
    assert [got[k]["canonical_image_id"] for k in "1234567"] == ["2", "2", "2", "2", "5", "5", "7"]
    assert [got[k]["label_conflict"] for k in "1257"] == [True, True, False, False]
    again = curation.curate(curation.curate(spark.createDataFrame(rows, ddl)))
    assert checks.same_rows(again, curation.curate(spark.createDataFrame(rows, ddl).repartition(3)))


def test_difference(spark):
    a = spark.createDataFrame([(1, {"x": "1"}), (1, {"x": "1"}), (2, None)], "k int, m map<string,string>")
    b = spark.createDataFrame([(1, {"x": "1"}), (3, None)], "k int, m map<string,string>")
    assert sorted((r["k"], r["side"], r["n"]) for r in checks.difference(a, b).collect()) == [(1, "-", 1), (2, "-", 1), (3, "+", 1)]
    assert checks.same_rows(a, a)


def _groups(spark, rows):
    return spark.createDataFrame(rows, "grp string, taxon_group string, genus string, species string, source_id string")


def test_assignment(spark):
    rows = [(f"g{i}", "fungi" if i % 2 else "oomycetes", f"G{i % 4}", None, "tgfc") for i in range(60) for _ in range(1 + i % 3)]
    out = {r["grp"]: r["split"] for r in splitting.assign_groups(_groups(spark, rows), "grp").collect()}
    assert len(out) == 60
    share = {s: sum(out[g] == s for g, *_ in rows) / len(rows) for s in labels.SPLITS}
    assert abs(share["train"] - 0.7) < 0.06 and abs(share["test"] - 0.15) < 0.05
    for group in ("fungi", "oomycetes"):
        assert {out[g] for g, t, *_ in rows if t == group} == set(labels.SPLITS)
    again = {r["grp"]: r["split"] for r in splitting.assign_groups(_groups(spark, rows[::-1]), "grp").collect()}
    assert again == out


@pytest.mark.parametrize("seed", range(6))
def test_shared_groups_leave_both_labels_everywhere(seed):
    sizes = {"x": {("group", "fungi"): 1, ("group", "oomycetes"): 1}, "y": {("group", "fungi"): 1, ("group", "oomycetes"): 1}, "f": {("group", "fungi"): 5}, "o": {("group", "oomycetes"): 5}}
    out = splitting.balance(sizes, seed)
    for label in splitting.BROAD:
        assert {s for g, s in out.items() if ("group", label) in sizes[g]} == set(labels.SPLITS)


def test_too_few_groups():
    with pytest.raises(ValueError, match="fewer than three"):
        splitting.balance({"a": {("group", "fungi"): 1}}, 1)


def test_support_and_masks(spark):
    rows = [("1", "g1", "train", "fungi", "A", "A a", "s"), ("2", "g2", "validation", "fungi", "A", None, "s"), ("3", "g3", "test", "fungi", "A", "A a", "s"), ("4", "g4", "test", "fungi", "B", None, "s")]
    df = spark.createDataFrame(rows, "image_id string, grp string, split string, taxon_group string, genus string, species string, source_id string")
    extra = spark.createDataFrame([("genus", "C")], "rank string, label string")
    got = {(r["rank"], r["label"]): r for r in labels.label_support(df, "grp", "split", extra).collect()}
    assert got["genus", "A"]["evaluation_supported"] and got["genus", "A"]["observed_groups"] == 3
    assert got["genus", "B"]["reasons"] == ["fewer_than_three_observed_groups", "no_training_examples", "incomplete_threeway_coverage"]
    assert got["genus", "C"]["images"] == 0 and got["group", "fungi"]["evaluation_supported"] and got["source", "s"]["reasons"] == []
    t = labels.rank_targets(df, labels.label_map(df), "image_id")
    m = {r["image_id"]: r for r in labels.masked_targets(df, t, labels.label_support(df, "grp", "split"), "image_id", "split").collect()}
    assert m["4"]["genus_target"] == 1 and not m["4"]["genus_mask"] and m["1"]["species_mask"] and not m["3"]["species_mask"] and m["2"]["species_target"] == -1


def test_latest_and_gate(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, v int, t string")
    assert sorted((r["k"], r["v"], r["t"]) for r in reviews.latest(df, "k", "v").collect()) == [("a", 3, "z"), ("b", 1, None)]
    assert checks.repeated(df.unionByName(df.limit(1)), "k", "v").count() == 1


def test_inventory_violations(spark):
    groups = [("g1", "train"), ("g2", None), ("g3", "test"), ("g4", "odd"), ("g4", "train"), ("g5", None), ("", None)]
    members = [("g1", "a", True), ("g1", "b", False), ("g2", "b", False), ("g3", "c", False), ("g4", "d", True), ("g4", "d", True), ("g9", "e", False), ("", "f", False)]
    found = splitting.inventory_violations(spark.createDataFrame(groups, "group_id string, split string"), spark.createDataFrame(members, "group_id string, image_id string, eligible boolean"))
    assert {tuple(r) for r in found.collect()} == {
        ("g1", "repeated_member"), ("g3", "split"), ("g4", "split"), ("g4", "repeated_member"), ("g4", "repeated_group"), ("g5", "members"), ("g9", "unlisted_group"), ("", "group_id"),
    }


def test_feasibility_against_brute_force():
    """Every way to hand the groups to come to partitions, for all small cases."""
    import itertools

    subsets = [set(c) for n in range(4) for c in itertools.combinations(range(3), n)]
    for lack_a, lack_b in itertools.product(subsets, subsets):
        for only_a, only_b, both in itertools.product(range(3), range(3), range(4)):
            kinds = ["a"] * only_a + ["b"] * only_b + ["ab"] * both
            can = any(
                lack_a <= {p for p, k in zip(where, kinds) if "a" in k} and lack_b <= {p for p, k in zip(where, kinds) if "b" in k}
                for where in itertools.product(range(3), repeat=len(kinds))
            ) if len(kinds) <= 5 else None
            if can is not None:
                assert splitting._can_be_filled([lack_a, lack_b], [only_a, only_b], both) == can


def test_places(spark):
    from lamella.operators import ranking

    rows = [(i, "hot" if i % 3 else None if i % 2 else "cold", (i * 7919) % 1000) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, k string, v int")
    got = {r["i"]: r["place"] for r in ranking.places(df, "k", [F.desc("v"), F.col("i")]).collect()}
    for key in ("hot", "cold", None):
        own = sorted((r for r in rows if r[1] == key), key=lambda r: (-r[2], r[0]))
        assert [got[r[0]] for r in own] == list(range(1, len(own) + 1))
    assert ranking.places(df.limit(0), "k", [F.col("v")]).count() == 0


def test_eligibility(spark):
    shape = "image_id string, source_id string, selection_status string, frame_count int, candidate_groups array<string>, import_flags array<string>, image_role string, review_status string, group_label string"
    ok = ("included", 1, ["fungi"], [], "full_field", "unreviewed", None)
    rows = [("a", "s", *ok), ("b", "s", "excluded_redundant", 2, ["fungi", "oomycetes"], ["duplicate_label_conflict"], "crop", "adjudicated", "fungi"), ("c", "t", None, None, None, None, None, None, None), ("z", "s", *ok)]
    records = spark.createDataFrame(rows, shape)
    chosen = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), ("nobody",)], "image_id string")
    policies = spark.createDataFrame([("s", "CC0", "them", 2, "full_field")], "source_id string, license string, attribution string, expected_images int, required_image_role string")
    broken = ["excluded", "frame_count", "candidate_groups"]
    want = {("b", x) for x in [*broken, "duplicate_label_conflict", "reviewed", "group_label"]} | {("c", x) for x in [*broken, "reviewed"]} | {("nobody", "unknown"), ("c", "repeated")}
    assert {tuple(r) for r in checks.eligibility_violations(records, chosen).collect()} == want
    assert {tuple(r) for r in checks.eligibility_violations(records, chosen, policies).collect()} == want | {("b", "image_role"), ("c", "permission"), ("t", "expected_images")}


def test_crosstab_has_zeros(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x")], "r string, c string")
    dims = [spark.createDataFrame([(v,) for v in vs], f"{n} string") for n, vs in (("r", "ab"), ("c", "xy"))]
    assert {tuple(r) for r in reviews.crosstab(df, "r", "c", *dims).collect()} == {("a", "x", 2), ("a", "y", 0), ("b", "x", 0), ("b", "y", 0)}


def test_counts_by(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), (None, None)], "d string, f array<string>")
    assert {tuple(r) for r in summaries.counts_by(df, "d", "f").collect()} == {("d", "a", 1), ("d", "unspecified", 1), ("f", "x", 1), ("f", "y", 1)}
