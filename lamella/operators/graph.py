"""Connected components by contraction, and the token rules that make edges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.session import materialize, release


def star_edges(tokens: DataFrame) -> DataFrame:
    """u, v from (node, token): every node of a token to the token's smallest node. A token held by a third of all nodes makes
    as many edges as it has nodes, not pairs, and its smallest node comes from a partial aggregation."""
    hubs = tokens.groupBy("token").agg(F.min("node").alias("u"), F.max("node").alias("far")).filter("far > u").select("token", "u")
    return tokens.join(hubs, "token").filter(F.col("node") != F.col("u")).select("u", F.col("node").alias("v"))


#: Edges that are joined in one task once contraction has left no more: so few that rounds would only wait for each other.
LAST_EDGES = 5_000


def _join_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The few edges that are left -> (node, to), `to` the smallest node of each component."""
    up: dict = {}

    def top(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for b in batches:
        for u, v in zip(b["u"], b["v"]):
            up.setdefault(u, u)
            up.setdefault(v, v)
            u, v = top(u), top(v)
            if u != v:
                up[max(u, v)] = min(u, v)
    yield pd.DataFrame({"node": list(up), "to": [top(x) for x in up]})


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root for every row of nodes (node); root is the smallest node of the component. edges: u, v.

    Every round a vertex joins the neighbour with the smallest hash (salted anew each round, so no order of ids is the
    worst case), and edges between different ones go on; their number falls by a constant factor. When LAST_EDGES or fewer
    are left, one task joins them. Tables of the rounds are written once and composed from the last to the first.
    """
    live = materialize(edges.select("u", "v").filter("u <> v").distinct())
    steps: list[DataFrame] = []
    for salt in range(max_rounds):
        left = live.count()
        if left <= LAST_EDGES:
            if left:
                kind = dict(live.dtypes)["u"]
                steps.append(materialize(live.coalesce(1).mapInPandas(_join_all, f"node {kind}, to {kind}")))
            break
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        order = lambda c: F.struct(F.xxhash64(F.lit(salt), c).alias("o"), F.col(c).alias("n"))
        nearest = both.groupBy("u").agg(F.min(order("v")).alias("m"))
        parent = materialize(nearest.select(F.col("u").alias("node"), F.least(order("u"), F.col("m")).getField("n").alias("to")))
        steps.append(parent)
        up = lambda c: parent.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        moved = live.join(up("u"), "u").join(up("v"), "v")
        following = materialize(
            moved.select(F.col("u_to").alias("u"), F.col("v_to").alias("v")).filter("u <> v")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        )
        release(live)
        live = following
    else:
        raise RuntimeError("components did not settle")
    release(live)
    if not steps:
        return nodes.select("node", F.col("node").alias("root")).distinct()
    labels = steps[-1]
    for parent in reversed(steps[:-1]):
        above = labels.select(F.col("node").alias("to"), F.col("to").alias("top"))
        labels = parent.join(above, "to", "left").select("node", F.coalesce("top", "to").alias("to"))
    labels = materialize(labels)
    smallest = labels.groupBy("to").agg(F.min("node").alias("root"))
    found = labels.join(smallest, "to").select("node", "root")
    return nodes.select("node").distinct().join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _present(value: Column) -> Column:
    return value.isNotNull() & (F.length(value) > 0)


#: Fields of lineage that link sources of a catalog.
CATALOG_LINEAGE = ("tree_id", "case_id", "specimen_id", "slide_id", "video_id", "isolate_id")
RELEASE_LINEAGE = (*CATALOG_LINEAGE, "parent_image_id", "source_parent_id")


def _rows(records: DataFrame, node: Column, tokens: list[Column]) -> DataFrame:
    return records.select(node.alias("node"), F.explode(F.array_compact(F.concat(*tokens))).alias("token"))


def _one(kind: str, *values: Column) -> Column:
    ok = _present(values[-1])
    return F.array(F.when(ok, F.concat_ws("\u0001", F.lit(kind), *values)))


def _hashes(single_frame_only: bool) -> list[Column]:
    single = F.col("frame_count") == 1
    parts = [_one("file", F.col("sha256"))]
    for kind, c in (("pixels", F.col("pixel_sha256")), ("lossless", F.col("lossless_transform_sha256"))):
        parts.append(_one(kind, F.when(single, c) if single_frame_only else c))
    return parts


def _keys() -> Column:
    return F.transform(F.filter(F.coalesce("relationship_keys", F.array().cast("array<string>")), _present), lambda k: F.concat_ws("\u0001", F.lit("relationship"), k))


def catalog_tokens(records: DataFrame) -> DataFrame:
    """node = source_id: whole sources, linked by equal files, single-frame images, parents, keys and lineage."""
    own = [_one("image", F.col("image_id")), _one("image", F.col("lineage")["parent_image_id"])]
    return _rows(records, F.col("source_id"), [*_hashes(True), *own, _keys(), *(_one(f, F.col("lineage")[f]) for f in CATALOG_LINEAGE)])


def split_tokens(records: DataFrame) -> DataFrame:
    """node = image_id, linked by equal files, single-frame images, keys and any lineage value; a source's own parent ids
    count within it; parent and canonical ids name images."""
    lineage = F.transform(
        F.filter(F.map_entries(F.coalesce("lineage", F.create_map().cast("map<string,string>"))), lambda e: _present(e["value"]) & (e["key"] != "parent_image_id")),
        lambda e: F.when(e["key"] == "source_parent_id", F.concat_ws("\u0001", e["key"], F.col("source_id"), e["value"])).otherwise(F.concat_ws("\u0001", F.lit("lineage"), e["key"], e["value"])),
    )
    named = [_one("id", c) for c in (F.col("image_id"), F.col("lineage")["parent_image_id"], F.col("canonical_image_id"))]
    return _rows(records, F.col("image_id"), [*_hashes(True), _keys(), lineage, *named])


def release_tokens(records: DataFrame, with_source: bool = True) -> DataFrame:
    """node = leakage_group_id, linked by source, hashes whatever the frames, canonical and parent ids, keys and lineage.
    Without the source token it is the rule of readers."""
    named = [_one("canonical", F.col("image_id")), _one("canonical", F.col("canonical_image_id")), _one("parent_image_id", F.col("image_id"))]
    lineage = [_one(f, F.col("source_id"), F.col("lineage")[f]) if f == "source_parent_id" else _one(f, F.col("lineage")[f]) for f in RELEASE_LINEAGE]
    source = [_one("source", F.col("source_id"))] if with_source else []
    return _rows(records, F.col("leakage_group_id"), [*source, *_hashes(False), *named, _keys(), *lineage])


def pair_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("image_id_a").alias("u"), F.col("image_id_b").alias("v")).filter("u is not null and v is not null")


def observed_groups(records: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """image_id, root over all records, excluded ones included: they may be bridges."""
    edges = star_edges(split_tokens(records).distinct())
    if pairs is not None:
        edges = edges.unionByName(pair_edges(pairs))
    return components(records.select(F.col("image_id").alias("node")), edges).select(F.col("node").alias("image_id"), "root")


def crossing_tokens(tokens: DataFrame, assigned: DataFrame) -> DataFrame:
    """token, partitions: what links groups of more than one partition. tokens: node, token; assigned: node, split."""
    return tokens.join(assigned, "node").groupBy("token").agg(F.min("split").alias("a"), F.max("split").alias("b")).filter("a <> b").select("token", F.array("a", "b").alias("partitions"))
