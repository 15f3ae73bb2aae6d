"""Problem 8: pages made of keywords, links or product tags.

Method: a rank-frequency curve for every page, in SQL windows. Tokens are words, numbers, and one token each for links
and hashtags, so a list of links is a page of one very frequent token. Four figures describe a curve: slope and residual of
log frequency against log rank; the divergence of its frequencies from the document frequencies of the page's language;
and the part of it that the language's prose does not have, its excess: links, hashtags and bursty words. A page is
extreme if slope, residual or divergence lie outside the band of pages in the same language and of comparable length
(octaves), and it is found if it is extreme and its excess is EXCESS above theirs; where hardly any pages are comparable,
if the excess is more than half of it. Links and hashtags that hold more than
half of a page's letters make it found however few tokens they are.

Which words are bursty comes from the corpus. A word on a quarter of the pages of any language is one of its common words;
small languages are smoothed by the whole corpus. Any other word is bursty on a page if it occurs three times there and,
over all pages, twice on a page that has it; or twice there and three times over all pages; or four times over all pages;
or six times there and in two of a hundred tokens. A common word is if it occurs six times there and eight times as often
as usual. Numbers say nothing.

Defined results: NULL, empty and blank texts, and texts without words or links are not found; a page of one link is; a page
of one or two different tokens has no curve and is extreme; lang without case, missing ones are one language of their own;
rows without doc_id are left out; repeated rows of one doc_id give one row; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.digests import stripped
from lamella.llm.tokenize import spread
from lamella.session import materialize

#: Endings by which an address without scheme is known.
ENDINGS = "test|invalid|example|com|org|net|info|io|eu|de|fr|es|jp|co|shop|biz"
# Every class stops before what may open the next link, so that all of them stay linear without a limit.
_ADDRESS = r"(?:https?://|www\.)[^\s<>()\"']+|(?<![\w.-])[\w-]++(?:\.(?!(?:" + ENDINGS + r")\b(?![.\w-]))[\w-]++)*+\.(?:" + ENDINGS + r")\b(?:/[^\s<>()\"']*+)?"
_LINK = r"<a\b[^<>]*+>(?:[^<]|<(?!/?a\b))*+</a\s*+>|!?\[[^\[\]\n]*+\]\([^()\s]*+\)|" + _ADDRESS
_HASHTAG = r"#[^\W\d_][\w-]*"
_MARKUP = r"</?[a-zA-Z][^<>]*+>|&[a-z]++;"
_NUMBER = r"(?:\bn[or]\.\s?)?\d+(?:[.,]\d+)*"
_WORD = r"[^\W\d_]+"

LINK, TAG, NUMBER = "<link>", "<tag>", "<num>"
#: The part of a language's pages that makes a word one of its common ones, and the pages of the whole corpus that are added
#: to those of a language.
COMMON, SMOOTHED = 0.25, 10
#: Pages that make a band; fewer say nothing of what is usual. The band is the middle half of them and this part of its width
#: to either side, so that it stays where a quarter of the pages are spam.
LEAST_PAGES, MARGIN = 50, 0.5
#: How much of a page must be beyond what is usual for it to be found.
EXCESS = 0.3
#: The part of a language's pages from which a token is frequent. At most a page's mean number of different tokens, divided by
#: this, are, however large the corpus. It decides how statistics travel, not which there are.
FREQUENT = 1e-3
#: Bytes of statistics that are sent to all workers.
BROADCAST_BYTES = 64 << 20


_CUT = regex.compile(rf"(?P<link>{_LINK})|(?P<tag>{_HASHTAG})|(?P<markup>{_MARKUP})|(?P<number>{_NUMBER})|(?P<word>{_WORD})", regex.S)
_MARKS = {"link": LINK, "tag": TAG, "number": NUMBER}
# A word that no address or number can begin with goes first: most tokens are such.
_TOKENS = regex.compile("|".join((rf"{_WORD}+(?![\w.:-])", _LINK, _HASHTAG, _MARKUP, _NUMBER, _WORD)), regex.S)
_BARE = regex.compile(r"<[^<>]*+>|\s")


def token_counts(text: str) -> tuple[dict[str, int], int, int]:
    """How often each token (without case) stands in a text, its letters, and those of links and tags. Only different tokens
    are looked at one by one."""
    counts: dict[str, int] = {}
    letters = marked = 0
    for found, n in Counter(_TOKENS.findall(text.lower())).items():
        size = len(found)
        if not found.isalpha():
            kind = _CUT.match(found).lastgroup
            if kind == "markup":
                continue
            if kind in ("link", "tag"):
                size = len(_BARE.sub("", found))
                marked += n * size
            found = _MARKS.get(kind, found)
        letters += n * size
        counts[found] = counts.get(found, 0) + n
    return counts, letters, marked


PAGE = "doc_id bigint, lang string, letters bigint, marked bigint, tokens array<string>, counts array<int>"


def page_counts(documents: DataFrame) -> DataFrame:
    """doc_id, lang, letters, marked, tokens, counts, page_tokens: one row for each page with words or links, the counts beside
    the tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [token_counts(t) for t in batch.column("text").to_pylist()]
            found = [c for c, _, _ in pages]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in found])]), pa.int32())
            tokens = pa.ListArray.from_arrays(offsets, pa.array([t for c in found for t in c], pa.string()))
            counts = pa.ListArray.from_arrays(offsets, pa.array([n for c in found for n in c.values()], pa.int32()))
            sizes = [pa.array([p[i] for p in pages], pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), *sizes, tokens, counts], ["doc_id", "lang", "letters", "marked", "tokens", "counts"])

    lang = F.coalesce(F.nullif(stripped(F.col("lang")), F.lit("")), F.lit("und"))
    pages = spread(documents.select("doc_id", "text", "lang")).filter("doc_id is not null and text is not null")
    return (
        pages.select("doc_id", lang.alias("lang"), "text").mapInArrow(count, PAGE).filter(F.size("tokens") > 0)
        .withColumn("page_tokens", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c))
    )


def _rows(counts: DataFrame) -> DataFrame:
    return counts.select("doc_id", "lang", "page_tokens", "letters", "marked", F.inline(F.arrays_zip(F.col("tokens").alias("token"), F.col("counts").alias("c"))))


def language_sizes(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang").agg(F.count("*").alias("lang_pages"))


def vocabulary(counts: DataFrame) -> DataFrame:
    """lang, token, pages, total, common, frequent: every common token, and every other on two pages of its language or more."""
    sizes = language_sizes(counts)
    every = counts.count()
    seen = _rows(counts).groupBy("lang", "token").agg(F.count("*").alias("pages"), F.sum("c").alias("total")).join(sizes, "lang")
    # A token has a row for each language; which of them it is common in needs all of them.
    of_token = Window.partitionBy("token")
    part = (F.col("pages") + SMOOTHED * F.sum("pages").over(of_token) / F.lit(max(every, 1))) / (F.col("lang_pages") + SMOOTHED)
    judged = seen.withColumn("part", part).withColumn("common", F.max("part").over(of_token) >= COMMON)
    return judged.filter("pages > 1 or common").select("lang", "token", "pages", "total", "common", (F.col("pages") >= FREQUENT * F.col("lang_pages")).alias("frequent"))


def with_statistics(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows with pages, total and common of their lang and token, NULL where the vocabulary lacks it."""
    keys = ["lang", "token"]
    size = F.octet_length("token") + F.octet_length("lang") + 48
    whole, often = known.agg(F.sum(size), F.sum(F.when(F.col("frequent"), size))).first()
    known, head = known.drop("frequent"), known.filter("frequent").drop("frequent")
    if (whole or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(known), keys, "left")
    if (often or 0) > BROADCAST_BYTES:
        return rows.join(known, keys, "left")
    # The frequent tokens, most of all rows, meet theirs where they are; only rows of the others move to their statistics.
    return rows.join(F.broadcast(head), keys).unionByName(rows.join(F.broadcast(head), keys, "left_anti").join(known, keys, "left"))


def curves(counts: DataFrame) -> DataFrame:
    """doc_id, lang, tokens, types, slope, residual, divergence, excess, marked_letters: the curve of every page. A token that
    is not in the vocabulary stands on this page only."""
    known = materialize(vocabulary(counts))
    # One of the rows of a doc_id, without an aggregate over their lists.
    once = counts.withColumn("copy", F.monotonically_increasing_id()).withColumn("kept", F.min("copy").over(Window.partitionBy("doc_id"))).filter("copy = kept")
    # Which of two equal frequencies comes first changes none of the sums.
    ranked = _rows(once).withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("c"))))
    c = F.col("c").cast("double")
    joined = with_statistics(ranked, known)
    burst = F.coalesce(F.col("total") / F.col("pages"), c)
    often = (F.col("c") >= 6) & (F.col("c") >= 0.02 * F.col("page_tokens"))
    beyond = F.when(F.coalesce("common", F.lit(False)), (F.col("c") >= 6) & (F.col("c") >= 8 * burst)).otherwise(
        ((F.col("c") >= 3) & (burst >= 2)) | ((F.col("c") >= 2) & (burst >= 3)) | (burst >= 4) | often
    )
    unlike = F.col("token").isin(LINK, TAG) | ((F.col("token") != NUMBER) & beyond)
    x, y = F.log("rank"), F.log(c)
    sums = joined.groupBy("doc_id", "lang").agg(
        F.sum(c).alias("tokens"),
        F.count("*").alias("types"),
        *(F.sum(v).alias(n) for n, v in (("sx", x), ("sy", y), ("sxx", x * x), ("sxy", x * y), ("syy", y * y))),
        F.sum(c * (y - F.log(F.coalesce("pages", F.lit(1))))).alias("weighted"),
        F.sum(F.when(unlike, c).otherwise(0.0)).alias("unlike"),
        F.max(F.col("marked") / F.col("letters")).alias("marked_letters"),
    )
    # Least squares of log frequency on log rank.
    n = F.col("types")
    sxx, sxy, syy = (F.col(ab) - F.col(f"s{ab[1]}") * F.col(f"s{ab[2]}") / n for ab in ("sxx", "sxy", "syy"))
    slope = F.when(n > 1, sxy / F.nullif(sxx, F.lit(0.0)))
    return sums.join(language_sizes(counts), "lang").select(
        "doc_id", "lang", "tokens", "types", slope.alias("slope"),
        F.sqrt(F.greatest(syy - slope * sxy, F.lit(0.0)) / n).alias("residual"),
        (F.col("weighted") / F.col("tokens") + F.log("lang_pages") - F.log("tokens")).alias("divergence"),
        (F.col("unlike") / F.col("tokens")).alias("excess"),
        "marked_letters",
    )


def judged_pages(pages: DataFrame) -> DataFrame:
    """pages with `extreme` (the curve lies outside the band of same-language pages of comparable length) and `usual`, the
    excess of the lower quarter of those, or of all pages of comparable length where that is less. Where fewer than LEAST_PAGES
    are comparable, `extreme` is NULL and no excess usual."""
    binned = pages.withColumn("octave", F.floor(F.log2("tokens")))
    measures = ("slope", "residual", "divergence")
    quarter = F.when(F.count("*") >= LEAST_PAGES, F.percentile_approx("excess", 0.25, F.lit(1000))).otherwise(0.0)
    band = binned.groupBy("lang", "octave").agg(
        *(F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.75)), F.lit(1000)).alias(f"q_{m}") for m in measures),
        F.count("*").alias("comparable"),
        quarter.alias("own"),
    )
    anywhere = binned.groupBy("octave").agg(quarter.alias("all_languages"))

    def outside(m: str) -> Column:
        low, high = F.col(f"q_{m}")[0], F.col(f"q_{m}")[1]
        above = F.col(m) > high + MARGIN * (high - low)
        return F.coalesce((F.col(m) < low - MARGIN * (high - low)) | above if m == "slope" else above, F.lit(False))

    extreme = outside("slope") | outside("residual") | outside("divergence") | (F.col("types") < 3)
    extreme = F.when(F.col("comparable") >= LEAST_PAGES, extreme)
    return binned.join(band, ["lang", "octave"]).join(anywhere, "octave").select(*pages.columns, extreme.alias("extreme"), F.least("own", "all_languages").alias("usual"))


def spam_pages(documents: DataFrame, excess: float = EXCESS) -> DataFrame:
    """doc_id of every page whose curve is extreme and excess above what is usual, or whose tokens where nothing is comparable,
    or letters, are mostly excess."""
    judged = judged_pages(materialize(curves(materialize(page_counts(documents)))))
    beyond = F.when(F.col("extreme").isNull(), F.col("excess") > 0.5).otherwise(F.col("extreme") & (F.col("excess") >= F.col("usual") + excess))
    return judged.filter(beyond | (F.col("marked_letters") > 0.5)).select("doc_id")


def page_curves(documents: DataFrame) -> DataFrame:
    """doc_id, tokens, types, slope, residual, divergence, excess of every page with words or links."""
    return curves(materialize(page_counts(documents))).drop("lang", "marked_letters")
