import random

import pytest
from pyspark.sql import functions as F

from lamella.llm import names

REFERENCE = [(1, "genus", "fungi", "Bramertarenium", None), (2, "species", "fungi", "Bramertarenium", "Bramertarenium vabezaosa"), (3, "species", "fungi", "Bramertarenium", "Bramertarenium garifeboa"), (4, "genus", "fungi", "Stasorluia", None), (5, "species", "fungi", "Stasorluia", "Stasorluia noumbaei"), (6, "species", "oomycetes", "Clovaria", "Clovaria olmerstaclaix")]
REF_DDL = "taxon_id bigint, taxon_rank string, taxon_group string, genus string, species string"
DDL = "label_id bigint, source_label string, genus string, species string, t string, key string, taxon_id bigint"


def mapped(spark, rows, reference=REFERENCE):
    df = spark.createDataFrame([(i, *r, "clash", "clash", 7) for i, r in enumerate(rows)], DDL)
    return {r["label_id"]: r["taxon_id"] for r in names.mapped_labels(df, spark.createDataFrame(reference, REF_DDL)).collect()}


CASES = [
    (("BRAMERTARENIUM VABEZAOSA", None, None), 2), (("Brametarenium vabezaosa", None, None), 2), (("Bramertarnium garifeboa", None, None), 3), (("Bramertarenium_vabezaosa", None, None), 2), (("BramertareniumVabezaosa", None, None), 2), (("bramertareniumgarifeboa", None, None), 3),
    (("B. vabezaosa (in progress)", None, None), 2), (("vabezaosa, Bramertarenium", None, None), 2), (("<i>Brаmertarеnium vabézaosa</i>", None, None), 2), (("Bramertarenium &quot;vabezaosa&quot;", None, None), 2), (("Stasorluia n0umbaei", None, None), 5), (("Clovaria olmerstadaix", None, None), 6),
    (("Bramertarenium vabezaosa Zold & Harin, 1991", None, None), 2), (("Bramertarenium vabezaosa var. minor", None, None), 2), (("Bramertarenium sp. 4", None, None), 1), (("Bramertarenium cf. vabezaosa", None, None), 1), (("Bramertarenium aff vabezaosa", None, None), 1), (("genus Stasorluia", None, None), 4), (("stasorluia", None, None), 4),
    (("Noumbaei", "Stasorlia", None), 5), (("see species", "STASORLUIA", "S. noumbaei"), 5), ((None, None, "noumbaei"), 5), (("?", "Stasorluia", None), 4), (("Clovaria sp.", None, None), -1),
    (("Hahorselsaora noumbaei", None, None), -1), (("Hahorselsaora rentahelpaei", None, None), -1), (("control", None, None), -1), (("??", None, None), -1), (("x" * 50_000, None, None), -1), (("word " * 20_000, None, None), -1),
]


def test_cases(spark):
    got = mapped(spark, [c for c, _ in CASES])
    assert {CASES[i][0]: t for i, t in got.items()} == dict(CASES)


def test_left_out(spark):
    rows = [("Bramertarenium vabezaosa", None, None), ("Stasorluia", "x", "y"), (None, None, None), ("", " ", "\t"), ("Stasorluia ", None, None), ("Clovaria", None, None)]
    assert mapped(spark, rows) == {4: 4, 5: -1}


def test_empty_tables(spark):
    assert mapped(spark, []) == {}
    assert mapped(spark, [("Stasorluia", None, None)], []) == {0: -1}


def test_repeats_and_report(spark):
    df = spark.createDataFrame([(1, "odd", None, None, "x", "x", 1)] * 3 + [(2, "odd", None, None, "x", "x", 1)], DDL)
    ref = spark.createDataFrame(REFERENCE, REF_DDL)
    assert sorted(map(tuple, names.mapped_labels(df, ref).collect())) == [(1, -1), (2, -1)]
    assert [tuple(r) for r in names.unmatched_labels(df, ref).collect()] == [("odd", None, None, 4)]


def test_deletions_meet_within_two_edits(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(8, 13))) for _ in range(30)]

    def edit(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1 :]])

    typed = {edit(edit(w)): w for w in words}
    vocabulary = spark.createDataFrame([(w, "genus", 1.0) for w in words], "v string, kind string, idf double")
    got = {r["t"]: r["v"] for r in names.repaired(spark.createDataFrame([(t,) for t in typed], "t string"), vocabulary).collect()}
    assert got == typed
    assert spark.range(1).select(F.size(names.deletions(F.lit("abcd")))).first()[0] == 1


@pytest.mark.parametrize(("text", "want"), [("A.b c", ["a", "b", "c"]), (None, []), ("12 x1y", ["xly"])])
def test_tokens(text, want):
    assert [x["t"] for x in names.fold_tokens(text)] == want


def test_the_genus_decides_between_near_epithets(spark):
    """A dense reference: the typed epithet is another genus' one letter for letter, and one letter off its own genus'."""
    near = [(1, "species", "fungi", "Alphagenus", "Alphagenus lutescens"), (2, "species", "fungi", "Betagenus", "Betagenus lutescans"), (3, "species", "fungi", "Gammagenus", "Gammagenus lutescons")]
    rows = [("Betagenus lutescens", None, None), ("Gammagenus lutescins", None, None), ("lutescens x", None, None), ("lutescins", None, "Betagenus"), ("Alphagenus lutescens!", None, None)]
    assert mapped(spark, rows, near) == {0: 2, 1: 3, 2: 1, 3: 2, 4: 1}
