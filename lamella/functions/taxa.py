"""Label -> taxon rules and the consensus of several taxa, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamella.functions.digests import let

RANKS = ("taxon_group", "genus", "species")
#: The two groups and their ids.
GROUPS = {"fungi": 0, "oomycetes": 1}
#: Labels of the boxed collection -> (group, genus, species).
BOXED = {
    "Colletotrichum siamense": ("fungi", "Colletotrichum", "Colletotrichum siamense"),
    "Olivea tectonae": ("fungi", "Olivea", "Olivea tectonae"),
    "Neopestalotiopsis sp.": ("fungi", "Neopestalotiopsis", None),
    "MixedClass": ("fungi", None, None),
}
#: Labels of the soil collection -> (group, genus, species).
SOIL = {
    "Fusarium": ("fungi", "Fusarium", None),
    "Trichoderma": ("fungi", "Trichoderma", None),
    "Verticillium": ("fungi", "Verticillium", None),
    "Phytophtora": ("oomycetes", "Phytophthora", None),
    "Phytophthora": ("oomycetes", "Phytophthora", None),
}
#: What is no epithet in a gallery label.
NO_EPITHET = ("sp", "spp", "cf", "aff", "complex", "hybrid")
_BINOMIAL = r"^(Phytophthora ([a-z][a-z-]+))(?:(?U:\s)+(\(in progress[^()]*\)))?$"
TAXON = "struct<source_label:string,taxon_group:string,genus:string,species:string,rank:string,mapping_note:string>"


def _table(table: dict[str, tuple], label: Column) -> Column:
    entries = [F.lit(x) if isinstance(x, str) else F.struct(*(F.lit(v).cast("string").alias(r) for v, r in zip(x, RANKS))) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), label)


def taxon(source: Column, label: Column, fallback_group: Column) -> Column:
    """The taxon a publisher's label gives, as a struct; a label no rule knows keeps the record's single candidate group."""
    # Everything that is looked up or matched is bound once; the rules below then only compare.
    seen = F.struct(
        label.alias("label"),
        fallback_group.alias("fallback"),
        F.when(source == "tgfc", _table(BOXED, label)).when(source == "soil", _table(SOIL, label)).alias("known"),
        ((source == "idphy") & label.rlike(r"^Phytophthora((?U:\s)|$)")).alias("gallery"),
        F.regexp_extract(label, _BINOMIAL, 1).alias("binomial"),
        F.regexp_extract(label, _BINOMIAL, 2).alias("epithet"),
        F.regexp_extract(label, _BINOMIAL, 3).alias("suffix"),
        source.alias("source"),
    )

    def rules(x: Column) -> Column:
        known, gallery = x["known"].isNotNull(), x["gallery"]
        plain = gallery & (x["binomial"] != "") & ~x["epithet"].isin(*NO_EPITHET)
        note = (
            F.when(known & (x["source"] == "tgfc") & (x["label"] == "MixedClass"), "individual taxa are not given")
            .when(known & (x["source"] == "soil") & (x["label"] == "Phytophtora"), "publisher's spelling of Phytophthora")
            .when(plain & (x["suffix"] != ""), "editorial suffix left out")
            .when(gallery & ~plain, "no unqualified binomial")
            .when(~known & ~gallery, "no rule for this label")
        )
        return F.struct(
            x["label"].alias("source_label"),
            F.when(known, x["known"]["taxon_group"]).when(gallery, "oomycetes").otherwise(x["fallback"]).alias("taxon_group"),
            F.when(known, x["known"]["genus"]).when(gallery, "Phytophthora").alias("genus"),
            F.when(known, x["known"]["species"]).when(plain, x["binomial"]).alias("species"),
            note.alias("mapping_note"),
        )

    def ranked(t: Column) -> Column:
        rank = F.when(t["species"].isNotNull(), "species").when(t["genus"].isNotNull(), "genus").when(t["taxon_group"].isNotNull(), "group").otherwise("unresolved")
        return F.struct(*(t[c].alias(c) for c in ("source_label", *RANKS)), rank.alias("rank"), t["mapping_note"].alias("mapping_note"))

    return let(let(seen, rules), ranked)


def consensus(taxa: Column, empty_group: Column) -> Column:
    """taxon_group, genus, species, status over an array of taxa: a rank counts only where all agree on a value, and below
    a missing rank there is none."""

    def agreed(rank: str) -> Column:
        values = F.array_distinct(F.transform(taxa, lambda t: t[rank]))
        return let(values, lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0))))

    several = F.size(F.array_distinct(F.transform(taxa, lambda t: F.struct(*(t[r].alias(r) for r in RANKS))))) > 1
    seen = F.struct(F.when(F.size(taxa) == 0, empty_group).otherwise(agreed("taxon_group")).alias("g"), agreed("genus").alias("n"), agreed("species").alias("s"), several.alias("several"))

    def below(x: Column) -> Column:
        genus = F.when(x["g"].isNotNull(), x["n"])
        status = F.when(x["several"], "multiple_taxa").when(x["g"].isNull(), "unresolved").when(genus.isNotNull(), "single_taxon").otherwise("group_only")
        return F.struct(x["g"].alias("taxon_group"), genus.alias("genus"), F.when(genus.isNotNull(), x["s"]).alias("species"), status.alias("status"))

    return let(seen, below)


def taxonomy(source: Column, labels: Column, candidate_groups: Column) -> Column:
    """taxa (in order of their labels) and their consensus of a record."""
    single = F.when(F.size(candidate_groups) == 1, F.get(candidate_groups, F.lit(0)))
    taxa = F.transform(F.array_sort(labels), lambda label: taxon(source, label, single))

    def both(x: Column) -> Column:
        found = consensus(x, single)
        return let(found, lambda c: F.struct(*(c[r].alias(r) for r in RANKS), c["status"].alias("status"), x.alias("taxa")))

    return let(taxa, both)


def hierarchy_violations(t: Column) -> Column:
    """What is wrong with a taxon struct: ranks without their parents, or a rank that is not the deepest."""
    deepest = F.when(t["species"].isNotNull(), "species").when(t["genus"].isNotNull(), "genus").when(t["taxon_group"].isNotNull(), "group").otherwise("unresolved")
    return F.array_compact(
        F.array(
            F.when(t["genus"].isNotNull() & t["taxon_group"].isNull(), F.lit("genus_without_group")),
            F.when(t["species"].isNotNull() & (t["genus"].isNull() | ~F.coalesce(t["species"].startswith(F.concat(t["genus"], F.lit(" "))), F.lit(False))), F.lit("species_without_genus")),
            F.when(F.coalesce(t["rank"] != deepest, F.lit(True)), F.lit("rank_is_not_the_deepest")),
        )
    )
