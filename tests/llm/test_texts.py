import os
import random

import pytest

from lamella.llm import leaks, spam, tokenize

DOCS = "doc_id bigint, text string, lang string, ids string, token string, share string"
ITEMS = "item_id bigint, task_name string, text string"


def docs(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or ["en"] * len(texts))[i], "x", "x", "x") for i, t in enumerate(texts)], DOCS)


needs_vocabulary = pytest.mark.skipif(not os.path.exists(tokenize.VOCABULARY), reason="no vocabulary")


@needs_vocabulary
def test_same_ids_as_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(tokenize.VOCABULARY.replace(".tiktoken", ".json"))
    reference.encode_special_tokens = True
    encoder = tokenize.Encoder(tokenize.load_ranks())
    rng = random.Random(2)
    texts = ["", " ", "a", "it's we'll DON'T", "<|endoftext|>", "a" * 5000, "ab" * 3000, " \n\t x", "日本語のテキスト", "é́ ß 🔬🍄 👩‍🔬", "x" + " " * 300 + "y", "".join(rng.choice("abc") for _ in range(20000))]
    texts += ["".join(chr(rng.choice([32, 65, 97, 39, 115, 0x3042, 0x1F600, 0x300, 10, 48, 0x660, 0x2028])) for _ in range(rng.randrange(60))) for _ in range(500)]
    for t in texts:
        assert encoder.encode(t) == reference.encode(t, add_special_tokens=False).ids


@needs_vocabulary
def test_null_and_empty_texts(spark):
    got = {r["doc_id"]: r["ids"] for r in tokenize.token_ids(docs(spark, [None, "", "hello world", "hello world"])).collect()}
    assert got[0] == got[1] == [] and got[2] == got[3] == tokenize.Encoder(tokenize.load_ranks()).encode("hello world")
    assert tokenize.token_ids(docs(spark, [])).count() == 0


ITEM = "Three isolates labelled Alphara, Betaria and Gammaria were mixed by mistake on 12 plates; the first forms teal papillae, the second stunted oospores, the third neither."
QUOTE = ITEM[15:110]


CHANGES = [
    lambda t: t, str.upper, str.lower, lambda t: t.replace(" ", "\n> "), lambda t: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t), lambda t: t.replace("e", "е").replace("a", "а").replace("o", "ó"),
    lambda t: t.replace("plates", "pla­tes").replace("mistake", "mis​take"), lambda t: t.replace("plates", "pla-\ntes"), lambda t: " ".join(f"<b>{w}</b>&nbsp;" for w in t.split()), lambda t: t.replace("i", "<i>i</i>"), lambda t: t.replace(",", "").replace(";", "—"),
    lambda t: t.replace(" ", "%20"), lambda t: t.replace("e", "\\u0065"), lambda t: t.replace("fi", "ﬁ"),
]


def quoting(spark, texts, item=None):
    """The numbers of the texts that quote the item."""
    items = spark.createDataFrame([(1, "a", item or ITEM)], ITEMS)
    return [r[0] for r in leaks.leaked(docs(spark, texts), items).orderBy("doc_id").collect()]


def renaming(spark, texts, item):
    items = spark.createDataFrame([(1, "a", item)], ITEMS)
    return [r[0] for r in leaks.reparameterised(docs(spark, texts), items).orderBy("doc_id").collect()]


def test_quotations_however_set(spark):
    assert quoting(spark, ["Before. " + change(QUOTE) + " after" for change in CHANGES]) == list(range(len(CHANGES)))


def test_no_quotation(spark):
    w = ITEM.split()
    none = [" ".join(w[:12]), ITEM.replace("first", "1st").replace("mixed", "lost"), "", "x " * 100_000, "a-" + "\n" * 200_000 + "1", "<a href=" * 50_000, '<a x="' + "y " * 300_000, "<a " + "x=1 " * 200_000]
    assert quoting(spark, [*none, " ".join(w[:13])]) == [len(none)]


def test_other_slots(spark):
    other = ITEM[:100].replace("Alphara", "Deltaria").replace("Betaria", "Epsilonia").replace("12", "40")
    one = ITEM[:100].replace("Alphara", "Gammaria").replace("12", "9")  # two names would become one
    assert renaming(spark, [other, one, ITEM[:100], other + " " + ITEM[:100]], ITEM[:100]) == [0]


def test_units_spelt_with_lookalikes(spark):
    item = "the spores were kept for twelve hours in the cold before the first count was made"
    texts = [item.replace("hours", unit) for unit in ("days", "dаys", "wеeks")]  # the last two hold a Cyrillic letter
    assert renaming(spark, texts, item) == [0, 1, 2]


def test_windows_against_brute_force(spark):
    """Every pair by comparing all windows of words one by one."""
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(6)] + ["12", "40", "hours", "days"]
    items = [(i, "t", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 40)))) for i in range(12)]
    texts = []
    for _ in range(60):
        own = rng.choice(items)[2].split()
        start = rng.randrange(len(own))
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(rng.randrange(6))] + own[start : start + rng.randrange(5, 20)] + [rng.choice(vocabulary) for _ in range(rng.randrange(6))]))
    cut = lambda t: {tuple(t.split()[i : i + 13]) for i in range(len(t.split()) - 12)}
    want = {(d, i) for d, t in enumerate(texts) for i, _, x in items if cut(t) & cut(x)}
    assert {tuple(r) for r in leaks.leaked(docs(spark, texts), spark.createDataFrame(items, ITEMS)).collect()} == want and want


def test_leaks(spark):
    items = spark.createDataFrame([(1, "a", ITEM), (2, "a", "too short"), (3, "a", None), (None, "a", ITEM), (4, "b", ITEM)], ITEMS)
    d = docs(spark, [ITEM + " x " + ITEM, None, "", "nothing", QUOTE]).unionByName(docs(spark, [ITEM]))
    d = d.unionByName(spark.createDataFrame([(None, ITEM, "en", "x", "x", "x")], DOCS))
    assert sorted(map(tuple, leaks.leaked(d, items).collect())) == [(0, 1), (0, 4), (4, 1), (4, 4)]
    assert leaks.leaked(docs(spark, []), items).count() == leaks.leaked(d, items.limit(0)).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK", 10)
    items = spark.createDataFrame([(i, "a", ITEM) for i in range(4)], ITEMS)
    assert leaks.leaked(docs(spark, [ITEM]), items).count() == 4


PROSE = "The slide was prepared from a leaf collected near the river and kept cold overnight. It is not clear whether the hyphae belong to the same isolate, so the reviewer left the species open. "
SPAM = [
    " ".join(f"#tag{i % 7}shop" for i in range(40)),
    "\n".join(f"http://www.shop{i}.example/?p={i}" for i in range(20)),
    "".join(f'<li><a href="http://a{i}.test">cheap slides</a></li>' for i in range(20)),
    "\n".join(f"* [buy tubes](b{i}.test/x.html)" for i in range(20)),
    " | ".join(random.Random(1).choice(["Glass Beads", "Glass Beads Sale", "Cheap Lens Cleaner", "Lens Cleaner", "Best Glass Beads"]) for _ in range(40)),
    "glass beads order. " * 30,
    "\n".join(f"{x} SKU {4000 + i} {i}.95" for i, x in enumerate(["glass beads", "lens cleaner", "best glass beads", "glass beads sale"] * 6)),
]


@pytest.mark.parametrize("text", SPAM + [PROSE + SPAM[4], SPAM[0] + " " + PROSE])
def test_spam(spark, text):
    others = [PROSE * (1 + i % 3) for i in range(20)]
    assert [r[0] for r in spam.spam_pages(docs(spark, [text, *others])).collect()] == [0]


def test_no_spam(spark):
    key = "Key to the cultures\n" + "\n".join(f"{i}a. Conidia {c}, wall {w} … {i + 1}\n{i}b. Basidia not {c}, usually {w} … Genus species{i}" for i, (c, w) in enumerate(zip("teal rust rose buff lemon".split(), "smooth waxy glossy slimy crusted".split())))
    refs = "References\n" + "\n".join(f"Author{i} B. (19{60 + i}). A revision of conidia in Genus{i} from Town{i}. Mould Letters {i}: 1–9." for i in range(12))
    texts = [None, "", "  \n", "?!", PROSE, PROSE * 4 + "see https://a.example/x and #leaf", key, refs, "x" * 300_000, "a." * 100_000, "a-" * 100_000, "<" * 50_000]
    assert spam.spam_pages(docs(spark, texts, ["en", None, "", "EN", "en", "und", "en", "en", "de", "en", "en", "en"])).count() == 0
    assert spam.spam_pages(docs(spark, [])).count() == 0


def test_spam_odd_rows(spark):
    d = docs(spark, ["http://a.example/x"] + [PROSE] * 5)
    assert [r[0] for r in spam.spam_pages(d.unionByName(d)).collect()] == [0]


def test_curve(spark):
    import numpy as np

    r = spam.page_curves(docs(spark, ["a a a a b b c d", PROSE])).filter("doc_id = 0").first()
    x, y = np.log([1, 2, 3, 4]), np.log([4, 2, 1, 1])
    slope, intercept = np.polyfit(x, y, 1)
    assert r["slope"] == pytest.approx(slope) and r["residual"] == pytest.approx(np.sqrt(np.mean((y - slope * x - intercept) ** 2))) and (r["tokens"], r["types"]) == (8, 4)


SHAPE = "doc_id bigint, lang string, letters bigint, marked bigint, tokens array<string>, counts array<int>, page_tokens bigint"


@pytest.mark.parametrize("broadcast, frequent", [(1 << 26, 1e-3), (100, 1e-3), (0, 1e-3), (200, 1e-4)])
def test_statistics_of_rare_tokens(spark, monkeypatch, broadcast, frequent):
    monkeypatch.setattr(spam, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(spam, "FREQUENT", frequent)
    campaign = {1: 1, 2: 8, 3: 8}  # 17 on 3 pages: bursty wherever it stands
    once = {1: 3, 2: 1, 3: 1}  # 5 on 3 pages: bursty nowhere
    pages = [(d, "en", 9, 0, ["fill", "campaign", "once"], [1, campaign[d], once[d]], 1 + campaign[d] + once[d]) for d in campaign]
    fill = spark.range(10, 40_010).selectExpr("id as doc_id", "'en' as lang", "4L as letters", "0L as marked", "array('fill') as tokens", "array(1) as counts", "1L as page_tokens")
    got = spam.curves(spark.createDataFrame(pages, SHAPE).unionByName(fill))
    assert {r["doc_id"]: r["excess"] for r in got.filter("doc_id < 10").collect()} == {d: pytest.approx(campaign[d] / (1 + campaign[d] + once[d])) for d in campaign}
    assert got.count() == 40_003


def test_common_words_come_from_the_corpus(spark):
    """A language no list holds: its common words are those on many of its pages; a small language takes those of the corpus."""
    pages = [(i, "qq", 9, 0, ["ka", "lo", f"w{i}"], [3, 2, 1], 6) for i in range(400)] + [(i, "zz", 9, 0, ["ka", f"w{i}"], [5, 5], 10) for i in range(400, 403)]
    known = {(r["lang"], r["token"]): r["common"] for r in spam.vocabulary(spark.createDataFrame(pages, SHAPE)).collect()}
    assert known == {("qq", "ka"): True, ("qq", "lo"): True, ("zz", "ka"): True}
    got = {r["doc_id"]: r["excess"] for r in spam.curves(spark.createDataFrame(pages, SHAPE)).collect()}
    assert got[0] == 0 and got[400] == 0.5


def test_many_languages(spark):
    """As many spellings of lang as pages."""
    d = docs(spark, [PROSE] * 30 + [SPAM[1]], [f"l{i}" for i in range(31)])
    assert [r[0] for r in spam.spam_pages(d).collect()] == [30]


def test_letters_of_links(spark):
    long = "\n".join(f"https://www.example.test/{i}{'x' * 80}" for i in range(10))
    few = "see https://a.test/1"
    assert [r[0] for r in spam.spam_pages(docs(spark, [PROSE + long, PROSE + few] + [PROSE] * 20)).collect()] == [0]


@pytest.mark.parametrize("text", ["<a href=x>" * 50_000, "[" * 100_000, "![a](" * 50_000, "a.b-" * 50_000, "www." * 50_000, "<a " * 100_000 + ">", "&amp" * 50_000, "a.com." * 50_000, "<a>x" * 50_000 + "</a>"])
def test_marks_without_end_take_linear_time(text):
    import time

    began = time.perf_counter()
    spam.token_counts(text)
    assert time.perf_counter() - began < 5


def test_links_however_long():
    for link in ("<A HREF='X.html'>Buy</A>", "HTTP://SHOP.EXAMPLE/A", "<a href='" + "x" * 3000 + "'><b>buy</b> now</a>", "[" + "w " * 600 + "](u)", "[a](" + "u" * 3000 + ")", "a" * 100 + ".b.c.d.e.f.g.h.i.j.k.com/x"):
        counts, letters, marked = spam.token_counts(link)
        assert counts == {spam.LINK: 1} and letters == marked > 0


def test_quotations_around_long_tags(spark):
    tags = ['<img alt="x y" src="data:image/png;base64,' + "Qk0 a/" * 2000 + '=="/>', "<p style='" + "color: red; " * 400 + "'>", "<!-- " + "word " * 900 + "-->", '<b class="' + "x " * 3000 + '">', "<div " + "word " * 420 + ">", '<img alt="5 > 4" title="' + "t " * 1100 + '">']
    first, last = QUOTE[: len(QUOTE) // 2], QUOTE[len(QUOTE) // 2 :]
    cut = first.rfind(" ")
    texts = ["Before. " + first[:cut] + " " + tag + first[cut:] + last + " after" for tag in tags]
    texts.append("where n <b and then " + "some words " * 300 + QUOTE + " so that x > 1")  # prose after a less-than sign
    assert quoting(spark, texts) == list(range(len(texts)))


def test_an_item_with_several_texts(spark):
    other = " ".join(f"token{i}" for i in range(20))
    items = spark.createDataFrame([(1, "a", ITEM), (1, "b", other), (1, "a", ITEM)], ITEMS)
    assert sorted(map(tuple, leaks.leaked(docs(spark, [ITEM, other, "x"]), items).collect())) == [(0, 1), (1, 1)]
