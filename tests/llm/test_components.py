import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.llm import components

IMAGES = "image_id string, source_id string, canonical_image_id string, relationship_keys array<string>, lineage map<string,string>, vertex string, root string, u string"
PAIRS = "image_id_a string, image_id_b string, status string, u string"


def find_all(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_local_union_find(seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(50, 90)]
    roots = find_all(200, edges)
    vertices, got = components.local_union_find(*(np.array(x, np.int64) for x in zip(*edges)))
    assert dict(zip(vertices.tolist(), got.tolist())) == {v: roots[v] for e in edges for v in e}


@pytest.mark.parametrize("per_cell", [5, 50, 100_000])
def test_grid(spark, per_cell):
    rng = random.Random(per_cell)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(100, 180)] + [(0, i) for i in range(300, 390)]
    roots = find_all(400, edges)
    got = {r["vertex"]: r["root"] for r in components.grid_components(spark.createDataFrame(edges, "u bigint, v bigint"), per_cell).collect()}
    assert got == {v: roots[v] for a, b in edges if a != b for v in (a, b)}


def groups(spark, images, pairs):
    out = components.linked_groups(spark.createDataFrame(images, IMAGES), spark.createDataFrame(pairs, PAIRS))
    found = {}
    for r in out.collect():
        found.setdefault(r["group_image_id"], set()).add(r["image_id"])
    return found


def image(i, source="s", canonical=None, keys=None, lineage=None):
    return (i, source, canonical, keys, lineage, "clash", "clash", "clash")


def test_rules(spark):
    images = [
        image("a", keys=["K1 ", None, "unknown"]), image("b", keys=[" k1"]), image("c", keys=["unknown", "-"], lineage={"tree_id": "T", "case_id": "x"}), image("d", lineage={"tree_id": " t "}), image("e", lineage={"case_id": "t"}),
        image("f", "s1", lineage={"source_parent_id": "p"}), image("g", "s2", lineage={"source_parent_id": "p"}), image("h", "s1", lineage={"source_parent_id": "P"}),
        image("i", canonical=" A "), image("j", lineage={"parent_image_id": "E"}), image("k", canonical="nobody"), image("l", canonical="l"), image("m"), image("n"), image("o"), image("p"), image("a", keys=["zz"]), image("q", keys=["zz"]), image(None, keys=["k1"]),
    ]
    pairs = [("m", "N ", None, "x"), ("o", "p", " REJECTED", "x"), ("o", "o", "confirmed", "x"), ("o", "ghost", "confirmed", "x"), ("ghost", "p", "confirmed", "x"), (None, "p", "confirmed", "x")]
    assert groups(spark, images, pairs) == {"a": {"a", "b", "i", "q"}, "c": {"c", "d"}, "e": {"e", "j"}, "f": {"f", "h"}, "m": {"m", "n"}}


def test_hot_key(spark):
    images = [image(f"i{i:04}", keys=["hot"] if i % 3 == 0 else [f"k{i // 2}"]) for i in range(900)]
    found = groups(spark, images, [])
    assert len(found["i0000"]) == 300


def test_empty(spark):
    assert groups(spark, [], []) == {} and groups(spark, [image("a")], []) == {}
    every = components.leakage_groups(spark.createDataFrame([image("a"), image("b")], IMAGES), spark.createDataFrame([], PAIRS))
    assert every.count() == 2 and every.select("leakage_group_id").distinct().count() == 2


def test_every_cell_is_a_task_of_its_own(spark):
    rng = random.Random(8)
    edges = spark.createDataFrame([(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(2000)], "u bigint, v bigint")
    side = 4
    cell = F.pmod(F.xxhash64("u"), F.lit(side)) * side + F.pmod(F.xxhash64("v"), F.lit(side))
    spread = edges.withColumn("cell", cell).repartitionById(side * side, cell.cast("int")).withColumn("part", F.spark_partition_id())
    assert spread.filter("cell <> part").count() == 0 and spread.select("part").distinct().count() == side * side


def test_a_long_chain_over_many_cells(spark):
    """Representatives travel over several rounds; 400 vertices in a row, in shuffled order of their hashes."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)], "u bigint, v bigint")
    assert {r["root"] for r in components.grid_components(edges, 10).collect()} == {0}
