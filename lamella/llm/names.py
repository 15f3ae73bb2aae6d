"""Problem 2: typed names mapped to a list of accepted ones.

Method: token-level repair. Every distinct token of the typed fields is joined to the reference vocabulary by edit
distance: both sides list the strings left by deleting up to two letters, equal ones meet in an equi-join, and the true
distance decides. Corrected tokens are then combined by soft TF-IDF: an entry's score is the inverse document frequency
of each of its tokens found, times its similarity, and the complete entry of the highest score is the one meant.
Equal rows are worked out once; tokens are worked out once however many rows have them.

What is written is folded first: markup, entities, accents, look-alike letters, capitals and joined words
(`GenusEpithet`). Tokens meet in two spellings, as they are and with what scanners confuse made alike on both sides (rn
and m, cl and d). A token that no vocabulary token is near, next to a genus, is held against that genus' own epithets.

Which entry is meant: the species of an epithet that stands without a qualifier, else the genus, else none. The label
goes before the species field, that before the genus field. An epithet after cf., aff. and the like is no epithet;
infraspecific parts, authors, years and notes are passed over. An epithet of an unlisted genus names nothing.

Defined results: rows without anything but blanks in the three fields, and those whose label is a reference name
character for character, are left out; what names nothing has taxon_id -1; ties go to the smaller taxon_id; repeated
rows come out once for each label_id; an empty reference gives -1 everywhere; extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.functions.digests import stripped
from lamella.llm.leaks import _FOLD, plain
from lamella.session import materialize

FIELDS = ("source_label", "species", "genus")
#: What makes the next epithet uncertain.
QUALIFIERS = ("cf", "aff", "affinis", "confer", "nr", "near", "prope", "indet")
#: Words that are no part of a name.
NOTES = frozenset("sp spp ssp subsp var forma genus gen species label isolate culture old unreviewed in progress ex et and see as determined the".split())
_CAMEL = regex.compile(r"(?<=\p{Ll}{3})(?=\p{Lu}\p{Ll}{2})")
_TOKEN = regex.compile(r"[^\W_]+\.?")
_TAGS = regex.compile(r"<[^<>]*>")


def fold_tokens(text: str | None) -> list[dict]:
    """The tokens of a field: t (folded), short (an abbreviation)."""
    if not text:
        return []
    out = []
    for m in _TOKEN.finditer(_CAMEL.sub(" ", plain(_TAGS.sub(" ", text)))):
        raw = m.group()
        word = raw.rstrip(".").lower().translate(_FOLD)
        mixed = any(c.isalpha() for c in word) and any(c.isdigit() for c in word)
        if mixed:
            word = word.replace("0", "o").replace("1", "l")
        if not word or word.isdigit():
            continue
        out.append({"t": word, "short": raw.endswith(".") or len(word) == 1})
    return out


_TOKENS = T.ArrayType(T.StructType([T.StructField("t", T.StringType()), T.StructField("short", T.BooleanType())]))


@F.pandas_udf(_TOKENS)
def tokens_of(texts: pd.Series) -> pd.Series:
    return pd.Series([fold_tokens(t) for t in texts], dtype=object)


def allowed(length: Column) -> Column:
    """Edits that a token of this length may have."""
    return F.when(length < 5, 0).when(length < 7, 1).otherwise(2)


def deletions(token: Column) -> Column:
    """All strings left by deleting up to the allowed number of letters."""

    def once(t: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))

    one = F.when(F.length(token) >= 5, once(token)).otherwise(F.array().cast("array<string>"))
    two = F.when(F.length(token) >= 7, F.flatten(F.transform(one, once))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(token), one, two))


def entries(reference: DataFrame) -> DataFrame:
    """taxon_id, taxon_rank, genus_key, epithet_key of the reference."""
    name = F.when(F.col("taxon_rank") == "genus", F.col("genus")).otherwise(F.col("species"))
    parts = tokens_of(name)
    return (
        reference.filter("taxon_id is not null").select("taxon_id", "taxon_rank", parts.alias("p"))
        .select(
            "taxon_id",
            "taxon_rank",
            F.try_element_at("p", F.lit(1)).getField("t").alias("genus_key"),
            F.when(F.col("taxon_rank") != "genus", F.try_element_at("p", F.lit(2)).getField("t")).alias("epithet_key"),
        )
        .filter("genus_key is not null")
    )


def vocabulary(listed: DataFrame) -> DataFrame:
    """v, kind (genus, epithet, joined), idf: the distinct tokens of the entries."""
    total = listed.agg(F.count("*").alias("n"))
    tokens = listed.select(F.explode(F.array(
        F.struct(F.col("genus_key").alias("v"), F.lit("genus").alias("kind")),
        F.struct(F.col("epithet_key").alias("v"), F.lit("epithet").alias("kind")),
        F.struct(F.concat("genus_key", "epithet_key").alias("v"), F.lit("joined").alias("kind")),
    )).alias("x")).select("x.*").filter("v is not null")
    return tokens.groupBy("v", "kind").agg(F.count("*").alias("df")).crossJoin(F.broadcast(total)).select("v", "kind", F.log1p(F.col("n") / F.col("df")).alias("idf"))


def alike(token: Column) -> Column:
    """The token with what scanners confuse made alike."""
    return F.replace(F.replace(token, F.lit("rn"), F.lit("m")), F.lit("cl"), F.lit("d"))


def repaired(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """t, v, kind, idf, similarity: every vocabulary token within the allowed distance of each token. Which of several is meant
    is for the entries' scores to say."""

    def keyed(table: DataFrame, token: str, *more: str) -> DataFrame:
        spelt = table.select(token, *more, F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col(token).alias("s")), F.struct(F.lit(1).alias("way"), alike(F.col(token)).alias("s")))).alias("x"))
        return spelt.select(token, *more, F.col("x.s").alias(f"{token}_s"), F.explode(deletions(F.col("x.s"))).alias("left"), "x.way").select(
            token, *more, f"{token}_s", F.xxhash64("way", "left").alias("k")
        )

    length = F.greatest(F.length("t_s"), F.length("v_s"))
    near = (
        keyed(tokens, "t").join(keyed(words, "v", "kind", "idf"), "k").select("t", "v", "kind", "idf", "t_s", "v_s").distinct()
        .withColumn("d", F.levenshtein("t_s", "v_s")).filter(F.col("d") <= allowed(length))
    )
    nearest = near.groupBy("t", "kind", "v").agg(F.min("d").alias("d"), F.first("idf").alias("idf"))
    return nearest.select("t", "kind", "v", "idf", (1 - F.col("d") / F.greatest(F.length("t"), F.length("v"))).alias("similarity"))


def meanings(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """key, taxon_id for every row of (key, source_label, species, genus) that names an entry."""
    listed = materialize(entries(reference))
    fields = rows.select("key", F.posexplode(F.array(*(tokens_of(F.col(f)) for f in FIELDS))).alias("field", "tokens"))
    placed = materialize(fields.select("key", "field", F.posexplode("tokens").alias("pos", "x"), "tokens").select(
        "key", "field", "pos", "x.t", "x.short",
        F.when(F.col("pos") > 0, F.try_element_at("tokens", F.col("pos")).getField("t")).alias("before"),
    ))
    words = materialize(vocabulary(listed))
    # A token longer than every vocabulary token by more than the edits allowed is near none, and its deletions are not listed.
    longest = (words.agg(F.max(F.length("v"))).first()[0] or 0) + 2
    short = placed.filter(~F.col("t").isin(*NOTES, *QUALIFIERS) & (F.length("t") <= longest)).select("t").distinct()
    # Few bytes, much work each: the number of tasks is given, since AQE would join them into one by size.
    short = short.repartition(2 * short.sparkSession.sparkContext.defaultParallelism, "t")
    fixes = materialize(repaired(short, words))
    found = materialize(placed.join(fixes, "t").select("key", "field", "pos", "kind", "v", "idf", "similarity", F.coalesce(F.col("before").isin(*QUALIFIERS), F.lit(False)).alias("qualified")))

    genera = found.filter("kind = 'genus'").groupBy("key", F.col("v").alias("genus_key")).agg(
        F.max(F.struct((-F.col("field")).alias("rank"), (F.col("idf") * F.col("similarity")).alias("score"))).alias("g")
    ).select("key", "genus_key", F.col("g.score").alias("genus_score"), F.col("g.rank").alias("genus_rank"))

    species = listed.filter("epithet_key is not null")
    by_epithet = found.filter("kind = 'epithet' and not qualified").join(species.select("taxon_id", "genus_key", F.col("epithet_key").alias("v")), "v")
    by_joined = found.filter("kind = 'joined'").join(species.select("taxon_id", "genus_key", F.concat("genus_key", "epithet_key").alias("v")), "v")
    # A whole word before the epithet that is no listed genus and no note: the epithet is of some other genus.
    named = found.filter("kind = 'genus'").select("key", "field", "pos").distinct()
    strange = placed.join(named, ["key", "field", "pos"], "left_anti").filter((F.col("pos") == 0) & ~F.col("short") & ~F.col("t").isin(*NOTES, *QUALIFIERS)).select("key", "field", "t")
    # A token after a genus that nothing in the vocabulary is near: held against the epithets of that genus.
    unread = placed.join(fixes.select("t").distinct(), "t", "left_anti").filter(
        ~F.col("short") & (F.length("t") >= 5) & ~F.col("t").isin(*NOTES, *QUALIFIERS) & ~F.coalesce(F.col("before").isin(*QUALIFIERS), F.lit(False))
    )
    beside = found.filter("kind = 'genus'").select("key", F.col("v").alias("genus_key"), F.col("field").alias("g_field"), F.col("pos").alias("g_pos"), "idf")
    by_genus = (
        unread.join(beside, "key")
        .filter((F.col("field") != F.col("g_field")) & (F.col("pos") == 0) | (F.col("field") == F.col("g_field")) & (F.abs(F.col("pos") - F.col("g_pos")) == 1))
        .join(species.select("taxon_id", "genus_key", F.col("epithet_key").alias("v")), "genus_key")
        .withColumn("similarity", 1 - F.levenshtein("t", "v") / F.greatest(F.length("t"), F.length("v")))
        .filter("similarity >= 0.65")
        .select("key", "field", "pos", F.lit("epithet").alias("kind"), "v", "idf", "similarity", F.lit(False).alias("qualified"), "taxon_id", "genus_key")
    )
    epithets = by_epithet.unionByName(by_joined).unionByName(by_genus)
    scored = (
        epithets.join(genera, ["key", "genus_key"], "left")
        .join(strange.withColumnRenamed("t", "leading"), ["key", "field"], "left")
        .withColumn("other_genus", F.col("leading").isNotNull() & (F.col("pos") > 0) & F.col("genus_score").isNull() & (F.levenshtein("leading", "genus_key") > 3))
        .filter("not other_genus")
        .select("key", "field", "taxon_id", (F.col("idf") * F.col("similarity") + F.coalesce("genus_score", F.lit(0.0))).alias("score"))
    )
    genus_entries = listed.filter("epithet_key is null").select(F.col("taxon_id").alias("genus_id"), "genus_key")
    as_genus = genera.join(genus_entries, "genus_key").select("key", (-F.col("genus_rank")).alias("field"), F.col("genus_id").alias("taxon_id"), F.col("genus_score").alias("score"))
    ranked = scored.select("key", F.struct(F.lit(1).alias("level"), F.col("score"), -F.col("field"), -F.col("taxon_id")).alias("rank"), "taxon_id").unionByName(
        as_genus.select("key", F.struct(F.lit(0).alias("level"), F.col("score"), -F.col("field"), -F.col("taxon_id")).alias("rank"), "taxon_id")
    )
    return ranked.groupBy("key").agg(F.max_by("taxon_id", "rank").alias("taxon_id"))


def mapped_labels(labels: DataFrame, reference: DataFrame) -> DataFrame:
    """label_id, taxon_id of every row that is not written as the reference has it."""
    names = reference.select(F.when(F.col("taxon_rank") == "genus", F.col("genus")).otherwise(F.col("species")).alias("source_label")).filter("source_label is not null").distinct()
    something = F.coalesce(*(F.nullif(stripped(F.col(f)), F.lit("")) for f in FIELDS)).isNotNull()
    key = F.struct(*(F.xxhash64(F.lit(salt), *(x for f in FIELDS for x in (F.col(f).isNull(), F.col(f)))).alias(f"k{salt}") for salt in (1, 2)))
    open_ = labels.filter(F.col("label_id").isNotNull() & something).select("label_id", *FIELDS).join(names, "source_label", "left_anti").withColumn("key", key)
    distinct = open_.groupBy("key").agg(*(F.first(f).alias(f) for f in FIELDS))
    return open_.select("label_id", "key").join(meanings(distinct, reference), "key", "left").select("label_id", F.coalesce("taxon_id", F.lit(-1).cast("bigint")).alias("taxon_id")).distinct()


def unmatched_labels(labels: DataFrame, reference: DataFrame) -> DataFrame:
    """source_label, genus, species, n: what was typed and names no entry, with its number of rows."""
    none = mapped_labels(labels, reference).filter("taxon_id = -1").select("label_id")
    return labels.join(none, "label_id", "left_semi").groupBy("source_label", "genus", "species").agg(F.count("*").alias("n"))
