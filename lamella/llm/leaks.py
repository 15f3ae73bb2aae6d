"""Problem 7: passages of evaluation items in the corpus.

Method: template canonicalisation. A text is folded to its words whatever its setting, markup or encoding; numbers,
names and units become typed placeholders. All windows of 13 template words of the items are hashed, the windows of the
documents are hash-joined to them, and the slots of a hit (what the placeholders stand for) are compared. If they are the
item's own, the document quotes the item; if they differ by a consistent renaming (one value always becomes the same
other one, and no two become one), the document holds a re-parameterised copy of the question.

The corpus is read once and its windows are not shuffled: the workers get the hashes of the items' windows and the items'
words, and only windows whose hash is among them leave a worker for the join, which compares templates in full. The items
are a stated, bounded set; more than BLOCK windows of them go in several blocks, each held against all documents.

Where a `<` opens what may be a tag of any length or may be prose up to some far `>`, the text is read both ways.

Defined results: NULL and empty texts contain nothing, documents without doc_id are left out; items of fewer than 13 words cannot be found; a pair comes out
once, however often its passage stands there; repeated rows make no difference; copies of items all come out; extra
columns are ignored.
"""

from __future__ import annotations

import html
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.tokenize import spread
from lamella.session import materialize

#: Consecutive words that make a quotation.
WINDOW = 13
#: Item windows whose hashes and words are sent to the workers at a time (8 bytes, and up to 13 words, each).
BLOCK = 2_000_000

#: Letters that look like a Latin one, lower case, each under the letter it stands for.
LOOKALIKES = {
    "a": "аαɑ", "b": "вЬь", "c": "сϲ", "d": "ԁ", "e": "еεҽ", "f": "ғ", "g": "ɡ", "h": "һн", "i": "іιıɩ", "j": "ј", "k": "кκ", "l": "ӏ",
    "m": "м", "n": "пη", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "гɾ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ѡԝω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
_FOLD = str.maketrans({x: latin for latin, xs in LOOKALIKES.items() for x in xs} | {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l"})
#: Words for units, any of which fills a unit slot.
UNITS = frozenset("second seconds minute minutes hour hours day days week weeks month months year years degree degrees fold micrometre micrometres micrometer micrometers millimetre millimetres millimeter millimeters centimetre centimetres gram grams milligram milligrams litre litres millilitre millilitres percent times um mm cm ml mg".split())

# All stop at the next `<`, so they stay linear. Quoted values may hold a `>`.
_ATTRIBUTES = r"""(?:\s++[\w:.@-]++(?:\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'|[^\s<>"'=]++[^\s<>"']*+)))++\s*+"""
_INLINE_NAMES = "b|i|u|s|em|strong|span|font|mark|small|big|sub|sup|a|code|tt|wbr"
_INLINE = regex.compile(rf"</?(?:{_INLINE_NAMES})(?:{_ATTRIBUTES}/?>|(?:\s[^<>]*+)?/?>)", regex.I)
_BLOCK = regex.compile(rf"<[a-zA-Z][\w:-]*+{_ATTRIBUTES}/?>|<[!/?a-zA-Z][^<>]*+>")
#: What is surely markup however long it is, and what is markup or prose.
_SURE = regex.compile(rf"<[a-zA-Z][\w:-]*+{_ATTRIBUTES}/?>|<!--[^<>]*+(?<=--)>")
_OPEN = regex.compile(r"<[!/?a-zA-Z][^<>]*+>")
#: Beyond this a `<` that is no sure tag may as well be prose.
DOUBTFUL = 300
_HYPHEN = regex.compile(r"(?<=\p{L})[-‐‑][^\S\n]*+\n[\s>|*#]*+(?=\p{L})")
_ESCAPE = regex.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\([nrt])")
_PERCENT = regex.compile(r"(?:%[0-9a-fA-F]{2})+")
_WORDS = regex.compile(r"[\p{L}\p{N}]+")
_SENTENCE_END = ".!?:;…\n"


def _unescape(m) -> str:
    return chr(int(m[1] or m[2], 16)) if m[1] or m[2] else " "


def _unpercent(m) -> str:
    return bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace")


def _decoded(text: str) -> str:
    if "\\" in text:
        text = _ESCAPE.sub(_unescape, text)
    if "%" in text:
        text = _PERCENT.sub(_unpercent, text)
    return html.unescape(html.unescape(text)) if "&" in text else text


def _unmarked(text: str) -> str:
    return _BLOCK.sub(" ", _INLINE.sub("", text)) if "<" in text else text


def _levelled(text: str) -> str:
    if not text.isascii():
        decomposed = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in decomposed if c.isascii() or unicodedata.category(c) not in ("Mn", "Me", "Cf"))
    if "-" in text or "‐" in text or "‑" in text:
        text = _HYPHEN.sub("", text)
    return text


def plain(text: str) -> str:
    """The text without markup, entities, escapes, invisible characters and look-alike letters; hyphenated line ends joined."""
    return _levelled(_unmarked(_decoded(text)))


def readings(text: str) -> list[str]:
    """plain(text), and where a long `<…>` may be prose, the text with it too."""
    text = _decoded(text)
    first = _levelled(_unmarked(text))
    if len(text) <= DOUBTFUL or "<" not in text:
        return [first]
    sure = _SURE.sub(lambda m: m[0] if len(m[0]) <= DOUBTFUL else " ", text)
    # The signs of the doubtful ones become blanks, so that what they hold is read.
    opened = _OPEN.sub(lambda m: m[0] if len(m[0]) <= DOUBTFUL else f" {m[0][1:-1]} ", sure)
    return [first] if opened == sure else [first, _levelled(_unmarked(opened))]


def _fold_word(token: str) -> str:
    word = token.lower()
    return word if word.isascii() else unicodedata.normalize("NFKC", word).translate(_FOLD)


def words(text: str) -> list[tuple[str, bool]]:
    """(folded word, whether it is written like a name: a capital not at the start of a sentence) of a text."""
    return _plain_words(plain(text))


def _plain_words(text: str) -> list[tuple[str, bool]]:
    out, end = [], 0
    for m in _WORDS.finditer(text):
        token = m.group()
        between = text[end : m.start()]
        named = token[0].isupper() and not token.isupper() and bool(out) and not any(c in between for c in _SENTENCE_END)
        out.append((_fold_word(token), named))
        end = m.end()
    return out


SLOTS = ("<num>", "<unit>", "<name>")


def kind(word: str, named: bool) -> str:
    """The placeholder of a number, unit or name; any other word itself."""
    return "<num>" if word[0].isdigit() else "<unit>" if word in UNITS else "<name>" if named else word


_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def window_hashes(template: list[str]) -> np.ndarray:
    """A 64-bit hash of every window of a template, as signed integers."""
    n = len(template) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64)
    codes = np.fromiter((xxhash.xxh64_intdigest(w) for w in template), np.uint64, len(template))
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = h * _STEP + codes[k : k + n]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return (h ^ (h >> np.uint64(32))).view(np.int64)


class Templates:
    """What the workers know of a block of items: the kind of each of their words, and the sorted hashes of their windows."""

    def __init__(self, kinds: dict[str, str], hashes: np.ndarray | None = None):
        self.kinds, self.hashes = kinds, hashes

    def template(self, text: list[tuple[str, bool]]) -> list[str]:
        """Words of the items are what they are there, however a document writes them."""
        return [self.kinds.get(w) or kind(w, named) for w, named in text]

    def may_hold(self, text: str) -> bool:
        """Whether a plain text has a window's length of words that can stand in some template: words of the items, numbers,
        units and what is written with a capital. Most texts end here, and none that holds a window does."""
        known, run = self.kinds, 0
        for token in _WORDS.findall(text):
            word = token.lower()
            if word in known or not token[0].islower() or word in UNITS:
                run += 1
            elif not word.isascii() and ((folded := _fold_word(token)) in known or folded in UNITS or folded[0].isdigit()):
                run += 1
            else:
                run = 0
                continue
            if run == WINDOW:
                return True
        return False

    def candidates(self, text: str) -> Iterator[tuple[int, int, int, list[str], list[str]]]:
        """(reading, place, hash, template, words) of every window whose hash is among those of the items."""
        for number, text in enumerate(readings(text)):
            if not len(self.hashes) or not self.may_hold(text):
                continue
            doc = _plain_words(text)
            template = self.template(doc)
            found = window_hashes(template)
            near = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            for at in np.flatnonzero(self.hashes[near] == found).tolist():
                yield number, at, int(found[at]), template[at : at + WINDOW], [w for w, _ in doc[at : at + WINDOW]]


def folded_items(eval_items: DataFrame) -> DataFrame:
    """item_id, variant, words, named of every item of 13 words or more; an item with several texts has a variant for each."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [words(t) for t in b["text"]]
            out = pd.DataFrame({"item_id": b["item_id"], "variant": b["variant"], "words": [[w for w, _ in t] for t in texts], "named": [[n for _, n in t] for t in texts]})
            yield out[[len(t) >= WINDOW for t in texts]]

    rows = eval_items.select("item_id", "text").filter("item_id is not null and text is not null").distinct().withColumn("variant", F.xxhash64("text"))
    return rows.mapInPandas(fold, "item_id bigint, variant bigint, words array<string>, named array<boolean>")


def item_kinds(items: DataFrame) -> dict[str, str]:
    """The kind of every word of a block of items: a name if any of them writes it like one."""
    seen = items.select(F.explode(F.arrays_zip("words", "named")).alias("w")).groupBy(F.col("w.words").alias("word")).agg(F.max("w.named").alias("named"))
    return {r["word"]: kind(r["word"], r["named"]) for r in seen.toLocalIterator()}


def item_windows(items: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """hash, item_id, variant, start, item_template, item_words of every window of a block of items."""
    sent = items.sparkSession.sparkContext.broadcast(kinds)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates(sent.value)
        for b in batches:
            rows = []
            for item, variant, ws, named in zip(b["item_id"], b["variant"], b["words"], b["named"]):
                template = templates.template(list(zip(ws, named)))
                rows += [(h, item, variant, at, template[at : at + WINDOW], list(ws[at : at + WINDOW])) for at, h in enumerate(window_hashes(template).tolist())]
            yield pd.DataFrame(rows, columns=["hash", "item_id", "variant", "start", "item_template", "item_words"])

    return items.mapInPandas(cut, "hash bigint, item_id bigint, variant bigint, start int, item_template array<string>, item_words array<string>")


def hits(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """doc_id, reading, at, words, item_id, variant, start, item_template, item_words: every window of a document that has
    the template of an item's window."""
    spark = documents.sparkSession
    texts = spread(documents.select("doc_id", "text").filter("doc_id is not null and text is not null"))
    items = materialize(folded_items(eval_items))
    windows = items.agg(F.sum(F.size("words") - (WINDOW - 1))).first()[0] or 0
    blocks = math.ceil(windows / BLOCK)
    parts = []
    for number in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "variant"), F.lit(blocks)) == number)
        kinds = item_kinds(block)
        own = materialize(item_windows(block, kinds))
        hashes = np.sort(own.select("hash").distinct().toPandas()["hash"].to_numpy(np.int64))
        sent = spark.sparkContext.broadcast((kinds, hashes))

        def look(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            templates = Templates(*sent.value)
            for batch in batches:
                rows = [(doc, *hit) for doc, text in zip(batch["doc_id"], batch["text"]) for hit in templates.candidates(text)]
                yield pd.DataFrame(rows, columns=["doc_id", "reading", "at", "hash", "template", "words"])

        found = texts.mapInPandas(look, "doc_id bigint, reading int, at int, hash bigint, template array<string>, words array<string>")
        parts.append(found.join(own, "hash").filter("template = item_template").drop("hash", "template"))
    if not parts:
        return spark.createDataFrame([], "doc_id bigint, reading int, at int, words array<string>, item_id bigint, variant bigint, start int, item_template array<string>, item_words array<string>")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def leaked(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """doc_id, item_id: the document contains 13 or more consecutive words of the item (every slot holds the item's own)."""
    return hits(documents, eval_items).filter("words = item_words").select("doc_id", "item_id").distinct()


def reparameterised(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """doc_id, item_id, windows: no quotation, but windows of the item with consistently other numbers, names or units. A run
    (windows at one shift against the item) counts if its slots are renamed one to one; no list is longer than an item."""
    found = materialize(hits(documents, eval_items))
    run = ["doc_id", "item_id", "reading", "variant", F.expr("at - start").alias("shift")]
    slots = found.filter("words <> item_words").select(*run, "start", F.explode(F.arrays_zip(F.col("item_template").alias("kind"), F.col("item_words").alias("own"), F.col("words").alias("here"))).alias("s"))
    keys = ["doc_id", "item_id", "reading", "variant"]
    runs = slots.filter(F.col("s.kind").isin(*SLOTS)).groupBy(*keys, "shift").agg(
        F.size(F.collect_set("s")).alias("pairs"),
        F.size(F.collect_set(F.struct("s.kind", "s.own"))).alias("theirs"),
        F.size(F.collect_set(F.struct("s.kind", "s.here"))).alias("mine"),
        F.size(F.collect_set("start")).alias("windows"),
    )
    renamed = runs.filter("pairs = theirs and pairs = mine").groupBy(*keys).agg(F.sum("windows").alias("windows"))
    quoted = found.filter("words = item_words").select("doc_id", "item_id").distinct()
    return renamed.join(quoted, ["doc_id", "item_id"], "left_anti").groupBy("doc_id", "item_id").agg(F.max("windows").cast("int").alias("windows"))
