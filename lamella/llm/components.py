"""Problem 4: one group identifier for all records linked directly or through others.

Method: a two-dimensional grid. Vertices are hashed into B blocks, edges into B x B cells by the blocks of their ends,
and a local union-find runs over the edges of every cell. A vertex gets a representative from each cell of its row and
column; they are exchanged by taking the first and keeping an edge from it to each other one. The next round runs on those
edges only, until no representative differs, and the rounds' parent tables are followed from the last to the first. Which
vertex comes first is drawn anew each round: in any order of the ids a third of the vertices of a long chain fall away,
even where every cell holds loose edges only. A hub's edges lie in all B cells of its row, so no task holds them all.

Shared values (relationship keys, lineage values) become a star around the smallest record that has the value: the
smallest is found with partial aggregation and joined back, so a value shared by a third of all records makes neither
pairs nor one large group.

Defined results: ids and values are compared without case and surrounding blanks; what names nothing links nothing;
a reference to an unknown id links nothing; self-pairs, repeats and either order make no difference; images that
arrived several times under one id are one record; empty tables give no groups; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions.digests import named, stripped
from lamella.session import materialize, release

#: Edges a cell is meant to hold; the grid grows with the edges.
EDGES_PER_CELL = 50_000
#: Blocks of vertices at most: 90,000 cells, which hold more than EDGES_PER_CELL each from 4.5 billion edges on. A task then
#: holds the distinct vertices of its cell (16 bytes each), never the edges.
MOST_BLOCKS = 300


def local_union_find(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """vertices, smallest vertex of each one's component, by hooking the larger root under the smaller and halving paths."""
    vertices, codes = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = codes[: len(left)], codes[len(left) :]
    parent = np.arange(len(vertices))
    while True:
        roots_a, roots_b = parent[a], parent[b]
        open_ = roots_a != roots_b
        if not open_.any():
            return vertices, vertices[parent]
        a, b = a[open_], b[open_]
        low, high = np.minimum(roots_a, roots_b)[open_], np.maximum(roots_a, roots_b)[open_]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


_ODD = 0x9E3779B97F4A7C15
_TO, _BACK = np.uint64(_ODD), np.uint64(pow(_ODD, -1, 1 << 64))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A one-to-one mapping of 64-bit integers, another for each salt."""
    y = (x.astype(np.int64).view(np.uint64) ^ np.uint64(salt)) * _TO
    return (y ^ (y >> np.uint64(32))).view(np.int64)


def _unmixed(y: np.ndarray, salt: int) -> np.ndarray:
    x = y.view(np.uint64)
    return (((x ^ (x >> np.uint64(32))) * _BACK) ^ np.uint64(salt)).view(np.int64)


def _forest(salt: int):
    """Edges of a cell -> (vertex, root, key), root the vertex of the component whose key comes first. Batches are merged as
    they come, so only distinct vertices and a spanning forest of them are held, not the edges."""

    def grow(batches):
        held_l, held_r = np.empty(0, np.int64), np.empty(0, np.int64)
        waiting: list[pd.DataFrame] = []
        size = 0

        def merged():
            return local_union_find(*(np.concatenate([held, *(_mixed(x[c].to_numpy(), salt) for x in waiting)]) for held, c in ((held_l, "u"), (held_r, "v"))))

        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size > max(200_000, len(held_l)):
                held_l, held_r = merged()
                waiting, size = [], 0
        if waiting:
            held_l, held_r = merged()
        for start in range(0, len(held_l), 100_000):
            l, r = held_l[start : start + 100_000], held_r[start : start + 100_000]
            yield pd.DataFrame({"vertex": _unmixed(l, salt), "root": _unmixed(r, salt), "key": r})

    return grow


def grid_components(edges: DataFrame, edges_per_cell: int = EDGES_PER_CELL, max_rounds: int = 100, smallest: bool = True) -> DataFrame:
    """vertex, root for every vertex of edges (u bigint, v bigint); root is the smallest vertex of the component, or with
    smallest=False any one of it."""
    spark = edges.sparkSession
    current = materialize(edges.select("u", "v").filter("u <> v"))
    levels: list[DataFrame] = []
    for number in range(max_rounds):
        count = current.count()
        if count == 0:
            break
        salt = (number + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1
        side = min(MOST_BLOCKS, max(1, math.ceil(math.sqrt(count / edges_per_cell))))
        block = lambda c: F.pmod(F.xxhash64(F.lit(number), c), F.lit(side))  # noqa: B023, E731
        # The cell's number is the partition's: no two cells share a task.
        roots = materialize(current.repartitionById(side * side, (block("u") * side + block("v")).cast("int")).mapInPandas(_forest(salt), "vertex bigint, root bigint, key bigint"))
        best = F.struct("key", "root")
        parents = materialize(roots.groupBy("vertex").agg(F.min(best).alias("first"), F.max(best).alias("far")).select("vertex", F.col("first.root").alias("root"), F.col("far.root").alias("far")))
        levels.append(parents)
        split = parents.filter("far <> root").select("vertex", F.col("root").alias("u"))
        following = materialize(roots.join(split, "vertex").select("u", F.col("root").alias("v")).filter("u <> v").distinct())
        release(current)
        release(roots)
        current = following
    else:
        raise RuntimeError("representatives did not stabilise")
    release(current)
    if not levels:
        return spark.createDataFrame([], "vertex bigint, root bigint")
    labels = levels[-1].select("vertex", "root")
    for parents in reversed(levels[:-1]):
        above = labels.select(F.col("vertex").alias("root"), F.col("root").alias("top"))
        labels = parents.select("vertex", "root").join(above, "root", "left").select("vertex", F.coalesce("top", "root").alias("root"))
    if smallest:
        labels = materialize(labels)
        labels = labels.join(labels.groupBy("root").agg(F.min("vertex").alias("first")), "root").select("vertex", F.col("first").alias("root"))
    return labels


def _vertex(text, salt: int):
    return F.xxhash64(text, F.lit(salt)), F.xxhash64(F.lit(salt + 1), text)


def vertices(images: DataFrame) -> tuple[DataFrame, int]:
    """vertex, image_id, check: one row for each image; 64-bit vertices are proved to be distinct, else salted anew."""
    ids = images.select(stripped(F.col("image_id")).alias("id"), "image_id").filter("id <> ''")
    for salt in range(5):
        vertex, check = _vertex(F.col("id"), salt)
        table = materialize(
            ids.groupBy(vertex.alias("vertex")).agg(F.min("image_id").alias("image_id"), F.min(check).alias("check"), F.max(check).alias("check_max"))
        )
        if table.filter("check <> check_max").isEmpty():
            return table.select("vertex", "image_id", "check"), salt
        release(table)
    raise RuntimeError("no salt keeps the vertices apart")


def links(images: DataFrame, near_pairs: DataFrame, known: DataFrame, salt: int) -> DataFrame:
    """u, v: the edges between known images."""
    ident = stripped(F.col("image_id"))
    lineage = F.transform(
        F.map_entries(F.coalesce("lineage", F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("field"), named(e["value"]).alias("value")),
    )
    tokens = F.concat(
        F.transform(F.coalesce("relationship_keys", F.array().cast("array<string>")), lambda k: F.struct(F.lit("key").alias("field"), named(k).alias("value"))),
        F.filter(lineage, lambda e: e["field"] != "parent_image_id"),
    )
    vertex, _ = _vertex(ident, salt)
    base = images.filter(ident != "").select(vertex.alias("v"), "source_id", "canonical_image_id", lineage.alias("lineage"), tokens.alias("tokens"))
    shared = (
        base.select("v", "source_id", F.explode("tokens").alias("t"))
        .filter("t.value is not null")
        .select("v", F.concat_ws("\u0001", "t.field", F.when(F.col("t.field") == "source_parent_id", F.coalesce(stripped(F.col("source_id")), F.lit("")))  .otherwise(F.lit("")), "t.value").alias("token"))
        .select("v", F.xxhash64("token").alias("k1"), F.xxhash64(F.lit("check"), "token").alias("k2"))
    )
    shared = materialize(shared)
    hubs = shared.groupBy("k1", "k2").agg(F.min("v").alias("u"), F.max("v").alias("far")).filter("far > u").select("k1", "k2", "u")
    stars = shared.join(hubs, ["k1", "k2"]).filter("u <> v").select("u", "v")

    parents = F.transform(F.filter("lineage", lambda e: e["field"] == "parent_image_id"), lambda e: e["value"])
    target, check = _vertex(F.col("ref"), salt)
    names = base.select("v", F.explode(F.concat(parents, F.array(named(F.col("canonical_image_id"))))).alias("ref"))
    references = names.filter("ref is not null").select(target.alias("u"), check.alias("check"), "v").filter("u <> v")

    a, b = stripped(F.col("image_id_a")), stripped(F.col("image_id_b"))
    (va, ca), (vb, cb) = _vertex(a, salt), _vertex(b, salt)
    pairs = near_pairs.filter(F.coalesce(stripped(F.col("status")) != "rejected", F.lit(True)) & a.isNotNull() & b.isNotNull()).select(
        va.alias("u"), ca.alias("check"), vb.alias("v"), cb.alias("check_v")
    ).filter("u <> v")
    pairs = pairs.join(known.select(F.col("vertex").alias("v"), F.col("check").alias("check_v")), ["v", "check_v"], "left_semi").select("u", "check", "v")
    named_pairs = references.unionByName(pairs).join(known.select(F.col("vertex").alias("u"), "check"), ["u", "check"], "left_semi").select("u", "v")
    return stars.unionByName(named_pairs).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def linked_groups(images: DataFrame, near_pairs: DataFrame) -> DataFrame:
    """group_image_id, image_id: one row for every image of each group of two or more."""
    known, salt = vertices(images)
    labels = grid_components(links(images, near_pairs, known, salt), smallest=False)
    members = labels.join(known, "vertex").select("root", "image_id")
    smallest = members.groupBy("root").agg(F.min("image_id").alias("group_image_id"))
    return members.join(smallest, "root").select("group_image_id", "image_id")


def leakage_groups(images: DataFrame, near_pairs: DataFrame) -> DataFrame:
    """image_id, leakage_group_id for every image, single ones included: `lg-` and 16 hex digits of the smallest id's SHA-256."""
    every = images.select("image_id").filter(stripped(F.col("image_id")) != "").distinct()
    return every.join(linked_groups(images, near_pairs), "image_id", "left").select(
        "image_id", F.concat(F.lit("lg-"), F.substring(F.sha2(F.coalesce("group_image_id", "image_id"), 256), 1, 16)).alias("leakage_group_id")
    )
