"""Problem 5: splits that keep related records together.

Method: grouped iterative stratification. Components are found first: images of one group belong together, and so do groups
that share a value of the relations asked for (linked as in problem 4). The label vector of a component counts its images
by label. The rarest outstanding label goes first, and is looked for again after every placement; of the components that
hold it those with most of it go first, into the split that needs that label most, whole.

Components of one vector are interchangeable, so one task places classes of them. Its result is that of placing every component
by itself: as long as the same label stays the rarest, members of a class are dealt out at once by the formula that gives
each to the split in need at that time. Vectors are exact, counts are integers, and the class's tables lie in files of the
task, so neither size nor number of the classes changes how a component is placed. Every component then takes its place by an
exact rank within its class. Ranks are formed in hash ranges, so no task holds a whole class.

Defined results: of each image only the row with the latest assigned_at counts (repeats at one time: one that has group
and partition, then the highest assignment_no); a group is 16 hex digits, with `lg-` or not; what is no partition is
none; images without a group are components of their own; an image
without taxonomy counts towards the sizes of the splits only.
"""

from __future__ import annotations

import heapq
import math
import os
import tempfile
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lamella.functions.digests import let, named, stripped
from lamella.llm.components import grid_components
from lamella.session import materialize, release

SPLITS = ("train", "validation", "test")
RATIOS = (0.70, 0.15, 0.15)
#: Spellings of the three partitions.
SPELLINGS = {"train": "train", "training": "train", "val": "validation", "valid": "validation", "validation": "validation", "dev": "validation", "test": "test", "testing": "test"}
#: Hash ranges of a class in which ranks are counted apart.
RANGES = 1024
#: Classes in one batch of what the placing task returns; the result is the same for any number.
MAX_CLASSES = 200_000
#: The label of every image, after all others in rarity.
ALL = "all"


def group_id(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), r"\s+", ""), "^lg[-_:]?", "")
    return let(bare, lambda b: F.when(b.rlike("^[0-9a-f]{16}$"), F.concat(F.lit("lg-"), b)))


def partition(text: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in SPELLINGS.items() for x in pair))
    return F.try_element_at(names, stripped(text))


def latest(manifest: DataFrame, relations: tuple[str, ...] = ()) -> DataFrame:
    """image_id, grp, split, taxon_group, genus, species, relations of the one row that counts of each image."""
    grp, split = group_id(F.col("leakage_group_id")), partition(F.col("split"))
    fields = ["grp", "split", "taxon_group", "genus", "species", "relations"]
    rows = manifest.filter("image_id is not null").select(
        "image_id", "assigned_at", "assignment_no", grp.alias("grp"), split.alias("split"), "taxonomy.taxon_group", "taxonomy.genus", "taxonomy.species",
        F.array(*(F.concat(F.lit(f"{r}:"), named(F.col(r))) for r in relations)).cast("array<string>").alias("relations"),
    )
    rank = F.struct("assigned_at", (F.col("grp").isNotNull() & F.col("split").isNotNull()).cast("int"), "assignment_no")
    kept = rows.groupBy("image_id").agg(F.max_by(F.struct(*fields), rank).alias("r"))
    return kept.select("image_id", "r.*")


def with_components(rows: DataFrame, related: bool = False) -> DataFrame:
    """rows with `component`: the group, or the image itself where it has none; with relations, groups that share a value of
    one are a single component, named by the smallest of them."""
    alone = rows.withColumn("component", F.coalesce("grp", F.concat(F.lit("image:"), "image_id")))
    if not related:
        return alone
    alone = materialize(alone)
    held = alone.select("component", F.explode(F.array_compact("relations")).alias("value")).distinct()
    hubs = held.groupBy("value").agg(F.min("component").alias("hub"))
    links = held.join(hubs, "value").filter("component <> hub").select(F.xxhash64("hub").alias("u"), F.xxhash64("component").alias("v"))
    roots = grid_components(links)
    names = alone.select("component").distinct().withColumn("vertex", F.xxhash64("component")).join(roots, "vertex", "left").select("component", F.coalesce("root", "vertex").alias("root"))
    first = names.groupBy("root").agg(F.min("component").alias("first"))
    return alone.join(names.join(first, "root").select("component", "first"), "component").drop("component").withColumnRenamed("first", "component")


def label_vectors(rows: DataFrame) -> DataFrame:
    """component, label, n, and for each component once for every label: partitions, the number of those its images stand in now."""
    labels = F.array_compact(F.array(F.lit(ALL), *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), c)) for c in ("taxon_group", "genus", "species"))))
    return rows.select("component", "split", F.explode(labels).alias("label")).groupBy("component", "label").agg(F.count("*").alias("n"), F.min("split").alias("a"), F.max("split").alias("b"))


def torn_groups(manifest: DataFrame) -> DataFrame:
    """leakage_group_id of every group whose images stand in more than one partition: of the components that the split is
    made of, those whose vector of all images spans several of the stored partitions."""
    rows = with_components(latest(manifest)).filter("grp is not null and split is not null")
    return label_vectors(rows.select("component", "split", *(F.lit(None).cast("string").alias(c) for c in ("taxon_group", "genus", "species")))).filter("a <> b").select(F.col("component").alias("leakage_group_id"))


def numbered(counts: DataFrame) -> DataFrame:
    """component, vector: number and n of each of its labels. Labels have numbers in the order of their names, ALL the last."""
    numbers = counts.select("label").distinct().select("label", (F.row_number().over(Window.orderBy(F.col("label") == ALL, "label")) - 1).alias("no"))
    return counts.join(numbers, "label").groupBy("component").agg(F.array_sort(F.collect_list(F.struct("no", "n"))).alias("vector"))


def classed(vectors: DataFrame) -> DataFrame:
    """vector, members, class of every different vector. Classes have numbers, those of the largest components the first."""
    size = F.element_at("vector", -1)["n"]
    return vectors.groupBy("vector").agg(F.count("*").alias("members")).withColumn("class", F.row_number().over(Window.orderBy(size.desc(), "vector")) - 1)


def dealt(need: list[int], need_all: list[int], own: int, size: int, count: int) -> list[int]:
    """How many of count equal components each split gets, if each goes where the need (then need_all) is largest at that time,
    and lowers it by own (need_all by size)."""
    # The needs end near one level: what lies a whole component above it is given for certain, the last few one by one.
    high = sorted(need, reverse=True)
    level = max(-((count * own - sum(high[:k])) // k) for k in range(1, len(high) + 1))
    given = [max(0, (n - level) // own) for n in need]
    for _ in range(count - sum(given)):
        given[max(range(len(need)), key=lambda s: (need[s] - given[s] * own, need_all[s] - given[s] * size, -s))] += 1
    return given


def fill(members: np.ndarray, starts: np.ndarray, labels: np.ndarray, amounts: np.ndarray, totals: np.ndarray, firsts: np.ndarray, holders: np.ndarray, ratios: tuple[float, ...]) -> np.ndarray:
    """For every class (row) and split (column), how many members go there. Class c has the labels and amounts from starts[c] to
    starts[c + 1]; label x is held by the holders from firsts[x] to firsts[x + 1], in the order they go; the last label is ALL."""
    shares = [Fraction(str(r)) for r in ratios]
    unit = math.lcm(*(r.denominator for r in shares))
    need = [[int(r * unit) * n for r in shares] for n in totals.tolist()]
    outstanding = totals.tolist()
    left = array("q", members.tobytes())
    placed = np.zeros((len(members), len(ratios)), "int64")
    at = firsts.tolist()
    last = len(outstanding) - 1
    queue: list[tuple[bool, int, int]] = []
    while True:
        # Entries that are no longer true are passed over; all are made anew before they outnumber the labels by far.
        if not queue or len(queue) > 4 * len(outstanding) + 1024:
            queue = [(x == last, n, x) for x, n in enumerate(outstanding) if n]
            heapq.heapify(queue)
            if not queue:
                return placed
        _, n, x = heapq.heappop(queue)
        if n != outstanding[x]:
            continue
        while not left[holders[at[x]]]:
            at[x] += 1
        key = int(holders[at[x]])
        vector = dict(zip(labels[starts[key] : starts[key + 1]].tolist(), amounts[starts[key] : starts[key + 1]].tolist()))
        own, count = vector[x], left[key]
        for y, m in vector.items():
            # Of y more goes with each member: after so many of them y is the rarest.
            if y != last and m > own:
                steps, rest = divmod(outstanding[y] - n, m - own)
                count = min(count, steps + (rest > 0 or x < y))
        given = dealt(need[x], need[last], own * unit, vector[last] * unit, count)
        placed[key] += given
        left[key] -= count
        for y, m in vector.items():
            need[y] = [a - m * unit * g for a, g in zip(need[y], given)]
            outstanding[y] -= m * count
            if outstanding[y]:
                heapq.heappush(queue, (y == last, outstanding[y], y))


def place(classes: dict[int, tuple[int, dict[str, float]]], totals: dict[str, float], ratios: tuple[float, ...] = RATIOS) -> dict[int, list[int]]:
    """How many members of each class go to each split, of a few classes. classes: members and the vector of one member, which
    holds ALL; totals: of each label over all members."""
    keys = sorted(classes, key=lambda k: (-classes[k][1][ALL], k))
    no = {x: i for i, x in enumerate(sorted(totals, key=lambda x: (x == ALL, x)))}
    entries = np.array([(c, no[x], n) for c, k in enumerate(keys) for x, n in classes[k][1].items()], "int64").reshape(-1, 3)
    held = entries[np.lexsort((entries[:, 0], -entries[:, 2], entries[:, 1]))]
    placed = fill(
        np.array([classes[k][0] for k in keys], "int64"), np.searchsorted(entries[:, 0], np.arange(len(keys) + 1)), entries[:, 1], entries[:, 2],
        np.array([totals[x] for x in no], "int64"), np.searchsorted(held[:, 1], np.arange(len(no) + 1)), held[:, 0], ratios,
    )
    return dict(zip(keys, placed.tolist()))


def placements(classes: DataFrame, ratios: tuple[float, ...] = RATIOS) -> DataFrame:
    """class, to_train, to_validation: of the members of every class those up to the first number go to train, up to the second to
    validation. One task; what grows with the number of classes lies in its files, but for some 64 bytes a class and a
    kilobyte a label."""
    most = MAX_CLASSES
    entries = classes.select("class", "members", F.explode("vector").alias("e")).select("class", "members", "e.no", "e.n")
    both = entries.withColumn("held", F.explode(F.array(F.lit(False), F.lit(True))))
    # First by class, then by label with the holders of most of it first: Spark sorts, on disk where it must.
    ordered = both.repartition(1).sortWithinPartitions("held", F.when(F.col("held"), F.col("no")).otherwise(F.col("class")), F.when(F.col("held"), -F.col("n")), "class", "no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            paths = {x: os.path.join(folder, x) for x in ("class", "members", "no", "n", "holder", "label", "total")}
            files = {x: open(path, "wb") for x, path in paths.items()}
            for batch in batches:
                column = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in ("class", "members", "no", "n", "held")}
                held = column.pop("held").astype(bool)
                for x, values in column.items():
                    values[~held].astype("int64").tofile(files[x])
                for x, values in (("holder", column["class"]), ("label", column["no"]), ("total", column["n"] * column["members"])):
                    values[held].astype("int64").tofile(files[x])
            for file in files.values():
                file.close()
            if not os.path.getsize(paths["class"]):
                return
            stored = {x: np.asarray(np.memmap(path, "int64", "r")) for x, path in paths.items()}
            starts, firsts = (np.searchsorted(stored[x], np.arange(stored[x][-1] + 2)) for x in ("class", "label"))
            given = fill(stored["members"][starts[:-1]], starts, stored["no"], stored["n"], np.add.reduceat(stored["total"], firsts[:-1]), firsts, stored["holder"], ratios)
            for i in range(0, len(given), most):
                part = given[i : i + most]
                yield pa.RecordBatch.from_pydict({"class": np.arange(i, i + len(part), dtype="int64"), "to_train": part[:, 0], "to_validation": part[:, 0] + part[:, 1]})

    return ordered.mapInArrow(run, "class bigint, to_train bigint, to_validation bigint")


def grouped_split(manifest: DataFrame, ratios: tuple[float, ...] = RATIOS, relations: tuple[str, ...] = ()) -> DataFrame:
    """image_id, component, split for every image, all images of a component in one split. relations: columns of the manifest
    (contributor, source_id) whose values no two splits may share; values that name nothing link nothing."""
    rows = materialize(with_components(latest(manifest, relations), bool(relations)).select("image_id", "component", "split", "taxon_group", "genus", "species"))
    counts = materialize(label_vectors(rows).select("component", "label", "n"))
    vectors = materialize(numbered(counts))
    classes = materialize(classed(vectors))
    bounds = classes.select("class", "vector").join(placements(classes, ratios), "class")
    h = F.xxhash64("component")
    hashed = materialize(vectors.join(bounds, "vector").select("component", "class", "to_train", "to_validation", h.alias("h"), F.pmod(F.shiftright(h, 40), F.lit(RANGES)).alias("range")))
    for table in (counts, vectors, classes):
        release(table)
    before = hashed.groupBy("class", "range").agg(F.count("*").alias("c")).withColumn("before", F.sum("c").over(Window.partitionBy("class").orderBy("range")) - F.col("c"))
    ranked = hashed.withColumn("within", F.row_number().over(Window.partitionBy("class", "range").orderBy("h", "component")))
    place_no = F.col("before") + F.col("within")
    assigned = (
        ranked.join(before.drop("c"), ["class", "range"])
        .select("component", F.when(place_no <= F.col("to_train"), "train").when(place_no <= F.col("to_validation"), "validation").otherwise("test").alias("split"))
    )
    return rows.select("image_id", "component").join(assigned, "component").select("image_id", "component", "split")


def split_report(manifest: DataFrame, relations: tuple[str, ...] = (), watched: str = "contributor") -> DataFrame:
    """One row: images, components, torn (components in several splits), unassigned, torn_<watched> (values of that column in
    several splits: 0 if it is one of the relations), and off_<kind>: the largest distance of a share from its target over all
    images, and over the images of any label with 100 or more (a component may hold most of a label's images)."""
    split = materialize(grouped_split(manifest, relations=relations))
    there = (watched,) if watched in manifest.columns else ()
    rows = materialize(latest(manifest, there).select("image_id", "taxon_group", "genus", "species", F.get("relations", F.lit(0)).alias(watched)).join(split, "image_id", "left"))

    def across(key: str) -> DataFrame:
        return rows.filter(F.col(key).isNotNull()).groupBy(key).agg((F.min("split") < F.max("split")).alias("several"))

    torn = across("component").agg(F.count("*").alias("components"), F.count_if("several").alias("torn"))
    torn_watched = across(watched).agg(F.count_if("several").alias(f"torn_{watched}"))
    kinds = F.array(F.struct(F.lit(ALL).alias("kind"), F.lit(ALL).alias("label")), *(F.struct(F.lit(c).alias("kind"), F.col(c).alias("label")) for c in ("taxon_group", "genus", "species")))
    counted = rows.select("split", F.explode(kinds).alias("k")).filter("k.label is not null").groupBy("k.kind", "k.label").agg(
        F.count("*").alias("n"), *(F.count_if(F.col("split") == x).alias(x) for x in SPLITS)
    )
    worst = F.greatest(*(F.abs(F.col(x) / F.col("n") - r) for x, r in zip(SPLITS, RATIOS)))
    far = counted.filter("n >= 100 or kind = 'all'").agg(*(F.round(F.max(F.when(F.col("kind") == k, worst)), 4).alias(f"off_{k}") for k in (ALL, "taxon_group", "genus", "species")))
    # Four tables of one row each.
    return rows.agg(F.count("*").alias("images"), F.count_if(F.col("split").isNull()).alias("unassigned")).crossJoin(torn).crossJoin(torn_watched).crossJoin(far)


def split_check(manifest: DataFrame) -> DataFrame:
    """What any split must hold: images, components, torn, unassigned, and whether all shares are within 0.05 of their targets."""
    return split_report(manifest).select("images", "components", "torn", "unassigned", (F.coalesce("off_all", F.lit(0.0)) <= 0.05).alias("near_target"))
