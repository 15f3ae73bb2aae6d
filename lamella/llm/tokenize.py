"""Problem 6: the corpus as token ids of a public byte-level BPE vocabulary.

Method: the pieces of a text are merged with a segment tree over the ranks of adjacent pairs. A leaf holds the rank and
place of the pair that starts there; the root yields the leftmost pair of lowest rank. A merge changes three leaves, each
updated in logarithmic time, until the root holds no mergeable pair. A piece of a million bytes without a blank thus
costs n log n. Pieces recur, so every worker keeps those it has seen, within a bound.

Defined results: NULL and empty texts give an empty list; strings of special tokens are ordinary text; whole texts are
encoded; every row comes out once, repeated rows as often as they stand there; lone surrogates cannot occur in Parquet.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the vocabulary lies and how texts are cut into pieces; both may be passed instead.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces a worker remembers.
REMEMBERED = 500_000
NONE = 1 << 62


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token bytes -> id; a lower id is merged earlier."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Merger:
    """Token ids of single pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_ids = [ranks[bytes([b])] for b in range(256)]
        self.token = {rank: token for token, rank in ranks.items()}
        self.ranks = ranks
        self.pairs: dict[tuple[int, int], int] = {}

    def pair_rank(self, left: int, right: int) -> int:
        """The id the pair merges into, NONE if it doesn't; ids are ranks."""
        key = left, right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > 2 * REMEMBERED:
                self.pairs.clear()
            got = self.pairs[key] = self.ranks.get(self.token[left] + self.token[right], NONE)
        return got

    def merge(self, piece: bytes) -> list[int]:
        ids = [self.bytes_ids[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NONE] * (2 * size)
        rank = self.pair_rank
        for i in range(n - 1):
            if (r := rank(ids[i], ids[i + 1])) != NONE:
                tree[size + i] = r * n + i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            while i > 1:
                a, b = tree[i], tree[i ^ 1]
                i >>= 1
                low = a if a < b else b
                if tree[i] == low:
                    return
                tree[i] = low

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := tree[1]) != NONE:
            merged, i = divmod(best, n)
            j = after[i]
            ids[i] = merged
            k = after[i] = after[j]
            ids[j] = -1
            if j < n - 1:
                put(j, NONE)
            if k < n:
                before[k] = i
                put(i, r * n + i if (r := rank(merged, ids[k])) != NONE else NONE)
            else:
                put(i, NONE)
            if (h := before[i]) >= 0:
                put(h, r * n + h if (r := rank(ids[h], merged)) != NONE else NONE)
        return [x for x in ids if x >= 0]


class Encoder:
    """Token ids of whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.merger, self.cut, self.seen = Merger(ranks), regex.compile(pattern), {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        seen = self.seen
        for m in self.cut.finditer(text):
            piece = m.group()
            got = seen.get(piece)
            if got is None:
                got = self.merger.merge(piece.encode())
                if len(piece) <= 64:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[piece] = got
            ids += got
        return ids


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores; only input in too few files is moved."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def token_ids(documents: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids."""
    # A vocabulary file is of a fixed size (1 MB here), whatever the corpus.
    ranks = documents.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(ranks.value, pattern)
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts], dtype=object)

    return spread(documents.select("doc_id", "text")).select("doc_id", encode("text").alias("ids"))
