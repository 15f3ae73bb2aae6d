"""Label maps, targets and their support."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.taxa import GROUPS, RANKS

SPLITS = ("train", "validation", "test")


def rank_names(taxa: DataFrame) -> DataFrame:
    """rank, label, parent of every name in a table with taxon_group, genus and species; distinct."""
    return (
        taxa.select(
            F.explode(
                F.array(
                    F.struct(F.lit("genus").alias("rank"), F.col("genus").alias("label"), F.col("taxon_group").alias("parent")),
                    F.struct(F.lit("species").alias("rank"), F.col("species").alias("label"), F.col("genus").alias("parent")),
                )
            ).alias("x")
        )
        .select("x.*")
        .filter("label is not null")
        .distinct()
    )


def parent_conflicts(names: DataFrame) -> DataFrame:
    """rank, label, parents: names with more than one parent."""
    return names.filter("parent is not null").groupBy("rank", "label").agg(F.count_distinct("parent").alias("parents")).filter("parents > 1")


def label_map(taxa: DataFrame) -> DataFrame:
    """rank, label, id, parent: the fixed groups, and ids of genera and species by name, from 0. A map is as long as there are
    names, so ranking a rank's names in one task is bounded by the vocabulary, not by the records."""
    names = rank_names(taxa).groupBy("rank", "label").agg(F.min("parent").alias("parent"))
    ranked = names.select("rank", "label", (F.row_number().over(Window.partitionBy("rank").orderBy("label")) - 1).cast("bigint").alias("id"), "parent")
    fixed = taxa.sparkSession.createDataFrame([("group", g, i, None) for g, i in GROUPS.items()], "rank string, label string, id bigint, parent string")
    return fixed.unionByName(ranked)


def rank_targets(records: DataFrame, mapped: DataFrame, key: str) -> DataFrame:
    """key, and for each rank its id (-1 without one) and mask. Three left joins to the map; AQE broadcasts it where it is small."""
    out = records.select(key, *RANKS)
    for rank, column in zip(("group", "genus", "species"), RANKS):
        ids = mapped.filter(F.col("rank") == rank).select(F.col("label").alias(column), F.col("id").alias(f"{rank}_id"))
        out = out.join(ids, column, "left")
    return out.select(key, *(F.coalesce(f"{r}_id", F.lit(-1)).cast("bigint").alias(f"{r}_target") for r in ("group", "genus", "species")), *(F.col(f"{r}_id").isNotNull().alias(f"{r}_mask") for r in ("group", "genus", "species")))


def features(records: DataFrame, *keys: str) -> DataFrame:
    """keys, rank, label: group, genus, species and source of each record that has them."""
    pairs = F.array(*(F.struct(F.lit(r).alias("rank"), F.col(c).alias("label")) for r, c in (("group", "taxon_group"), ("genus", "genus"), ("species", "species"), ("source", "source_id"))))
    return records.select(*keys, F.explode(pairs).alias("f")).select(*keys, "f.rank", "f.label").filter("label is not null")


def feature_support(records: DataFrame, group: str) -> DataFrame:
    """rank, label, images, groups."""
    per_group = features(records, group).groupBy(group, "rank", "label").agg(F.count("*").alias("n"))
    return per_group.groupBy("rank", "label").agg(F.sum("n").alias("images"), F.count("*").alias("groups"))


def label_support(records: DataFrame, group: str, split: str, extra_labels: DataFrame | None = None) -> DataFrame:
    """rank, label, images, observed_groups, and images and groups by split, training_supported, evaluation_supported,
    reasons. A group lies in one split, so groups are counted after one aggregation by group. extra_labels (rank, label)
    come out with zeros where no record has them."""
    per_group = features(records, group, split).groupBy("rank", "label", split, group).agg(F.count("*").alias("n"))
    in_split = lambda s, v: F.coalesce(F.sum(F.when(F.col(split) == s, v)), F.lit(0)).cast("bigint")
    counted = per_group.groupBy("rank", "label").agg(
        F.sum("n").cast("bigint").alias("images"),
        F.count_distinct(group).alias("observed_groups"),
        *(in_split(s, F.col("n")).alias(f"{s}_images") for s in SPLITS),
        *(in_split(s, F.lit(1)).alias(f"{s}_groups") for s in SPLITS),
    )
    if extra_labels is not None:
        numbers = [c for c in counted.columns if c not in ("rank", "label")]
        universe = counted.select("rank", "label").unionByName(extra_labels.select("rank", "label")).distinct()
        counted = universe.join(counted, ["rank", "label"], "left").select("rank", "label", *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers))
    fine = F.col("rank").isin("genus", "species")
    reasons = F.array_compact(
        F.array(
            F.when(fine & (F.col("observed_groups") < 3), F.lit("fewer_than_three_observed_groups")),
            F.when(fine & (F.col("train_images") == 0), F.lit("no_training_examples")),
            F.when(fine & (F.least(*(F.col(f"{s}_images") for s in SPLITS)) == 0), F.lit("incomplete_threeway_coverage")),
        )
    )
    return counted.withColumn("training_supported", F.col("train_images") > 0).withColumn("reasons", reasons).withColumn("evaluation_supported", F.size("reasons") == 0)


def rank_coverage(support: DataFrame) -> DataFrame:
    """rank, labels, trained, evaluable, train_only, untrained counts over a support table."""
    train_only = F.col("rank").isin("genus", "species") & F.col("training_supported") & ~F.col("evaluation_supported")
    return support.groupBy("rank").agg(
        F.count("*").alias("labels"),
        F.count_if("training_supported").alias("trained"),
        F.count_if("evaluation_supported").alias("evaluable"),
        F.count_if(train_only).alias("train_only"),
        F.count_if(~F.col("training_supported")).alias("untrained"),
    )


def masked_targets(records: DataFrame, targets: DataFrame, support: DataFrame, key: str, split: str) -> DataFrame:
    """targets with genus and species masked outside train where their label cannot be evaluated. Ids stay."""
    out = records.select(key, split, "genus", "species").join(targets, key)
    for rank in ("genus", "species"):
        usable = support.filter(F.col("rank") == rank).select(F.col("label").alias(rank), F.col("evaluation_supported").alias(f"{rank}_ok"))
        out = out.join(usable, rank, "left")
        out = out.withColumn(f"{rank}_mask", F.col(f"{rank}_mask") & ((F.col(split) == "train") | F.coalesce(f"{rank}_ok", F.lit(False))))
    return out.select(*targets.columns)
