"""Problem 1: duplicates of a new batch among everything accepted before.

Method: a stored pivot-distance table. When a batch is accepted, every distinct hash of it gets its distances from fixed
pivots once, and they are appended: a base pivot, and 32 pivots that differ from it in one block of two bits. The
difference of the distances to the base and to such a pivot is the distance within that block, a metric of its own, so the
triangle inequality holds block by block: two hashes at distance r differ in all their block distances together by r at
most. The blocks fall into four segments; as r is at most 2, at least two segments of any such pair have equal pivot
distances. A stored hash has a row for each of the six pairs of segments with the distances of the pair as its code.

The table lies in folders by pair of segments and range (RING) of the distance from the base pivot within that pair, which
is the same for both of any two hashes the pair finds, and in buckets by code. A batch reads the ranges its own hashes lie
in, meets them in their buckets (stored rows are not shuffled; a small batch goes to them), and what ranges and codes leave
is cut by the distance from the base pivot over all segments and verified by the true distance. History.reached() gives the
rows of every range and whether a batch reads them: a few records read a small part, a batch of thousands all of it, since
distances of 64-bit hashes lie close together.

Equal digests and equal hashes are matched by an equi-join on the value with the stored values. Near matches are searched
among distinct hashes, so a hash held by a third of all records is compared once, and joined back to its records afterwards
(a small batch is sent to the stored rows wherever they lie, else skewed keys are split by AQE).

Defined results: rows without record_no or batch_no take no part; a digest or hash that is NULL, blank, cut off or no
digest equals nothing; hashes with fewer than 4 or more than 60 bits set equal nothing; repeated rows count once; an
empty table gives no pairs; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.digests import hash64, let, sha256_hex
from lamella.session import materialize, release, remove_at_end, shared_path

#: The base pivot; every other pivot is it with the two bits of one block flipped.
BASE_PIVOT = 0x5A3C96E10F78D2B4
#: One 16-bit segment holds eight blocks.
SEGMENTS = [0xFFFF << (16 * s) for s in range(4)]
PAIRS = list(combinations(range(4), 2))
EVEN_BITS = 0x5555555555555555
#: The greatest distance of a near-duplicate; two of four segments agree only up to 2.
RADIUS = 2
#: Distances from the base pivot within a pair (0 to 32) that share a folder.
RING = 2
VALUES = "kind string, value binary, record_no bigint, batch_no int"
#: Matches that run beside the appends that follow them.
BESIDE = 4
#: Stored rows a bucket is meant to hold when the store is made, and the least and most buckets there are.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 4_000_000, 2, 20_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivots() -> list[int]:
    """All 33 pivots as unsigned integers, the base first."""
    return [BASE_PIVOT] + [BASE_PIVOT ^ (3 << (2 * b)) for b in range(32)]


def block_distances(h: Column) -> Column:
    """The distance within each block, two bits a block: (d(h, base) + 2 - d(h, pivot of the block)) / 2 for all 32
    pivots at once."""
    t = h.bitwiseXOR(F.lit(_signed(BASE_PIVOT)))
    odd = F.shiftrightunsigned(t, 1)
    one = t.bitwiseXOR(odd).bitwiseAND(F.lit(EVEN_BITS))
    two = t.bitwiseAND(odd).bitwiseAND(F.lit(EVEN_BITS))
    return one.bitwiseOR(F.shiftleft(two, 1))


def informative(h: Column) -> Column:
    return let(h, lambda x: F.when(F.bit_count(x).between(4, 60), x))


def signatures(images: DataFrame) -> DataFrame:
    """record_no, batch_no, sha, pixel (bytes), hash: what a record is matched by, written alike."""
    return images.select(
        "record_no",
        "batch_no",
        F.unhex(sha256_hex(F.col("sha256"))).alias("sha"),
        F.when(F.col("frame_count") == 1, F.unhex(sha256_hex(F.col("pixel_sha256")))).alias("pixel"),
        informative(hash64(F.col("perceptual_dhash64"))).alias("hash"),
    ).filter("record_no is not null and batch_no is not null")


def values(signed: DataFrame) -> DataFrame:
    """One row for each value of a record: kind (s, p, h), value, record_no, batch_no."""
    kinds = F.array(
        F.struct(F.lit("s").alias("kind"), F.col("sha").alias("value")),
        F.struct(F.lit("p").alias("kind"), F.col("pixel").alias("value")),
        F.struct(F.lit("h").alias("kind"), F.unhex(F.lpad(F.hex("hash"), 16, "0")).alias("value")),
    )
    return (
        signed.select("record_no", "batch_no", F.explode(kinds).alias("v"))
        .select("v.kind", "v.value", "record_no", "batch_no")
        .filter("value is not null")
    )


def base_distance(h: Column) -> Column:
    return F.bit_count(h.bitwiseXOR(F.lit(_signed(BASE_PIVOT))))


def _masked(blocks: Column, mask: int) -> Column:
    return blocks.bitwiseAND(F.lit(_signed(mask)))


def pivot_rows(signed: DataFrame) -> DataFrame:
    """n, code, hash, blocks, base, ring: six rows for each distinct hash, what the store keeps of it."""
    keys = F.array(
        *(
            F.struct(F.lit(n).cast("tinyint").alias("n"), _masked(F.col("blocks"), SEGMENTS[i] | SEGMENTS[j]).alias("code"))
            for n, (i, j) in enumerate(PAIRS)
        )
    )
    distances = signed.filter("hash is not null").select("hash").distinct().select("hash", block_distances(F.col("hash")).alias("blocks"), base_distance(F.col("hash")).alias("base"))
    # A block distance of two is written 10, one 01.
    odd, even = F.lit(_signed(EVEN_BITS << 1)), F.lit(EVEN_BITS)
    within = 2 * F.bit_count(F.col("k.code").bitwiseAND(odd)) + F.bit_count(F.col("k.code").bitwiseAND(even))
    ring = F.col("k.n").cast("int") * 100 + F.floor(within / RING).cast("int")
    return distances.select(F.explode(keys).alias("k"), "hash", "blocks", "base").select("k.n", "k.code", "hash", "blocks", "base", ring.alias("ring"))


class History:
    """Everything accepted so far: an append-only pivot-distance table and the values of the records, in one folder.

    append() forms the distances of a batch's hashes and adds rows; nothing stored is read or written again. match() holds a
    batch against the store. The pivot table is a bucketed external table, so the number of its buckets is fixed by the first
    append (or `buckets`) and kept beside it; a store that exists is opened with its path alone.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self._name = f"lamella_history_{uuid.uuid4().hex}"
        self.is_open = False
        if self._exists("layout"):
            self.buckets = self.spark.read.parquet(f"{path}/layout").first()["buckets"]
            self.spark.sql(
                f"CREATE TABLE {self._name} (n TINYINT, code BIGINT, hash BIGINT, blocks BIGINT, base INT, ring INT) USING parquet "
                f"PARTITIONED BY (ring) CLUSTERED BY (n, code) SORTED BY (n, code) INTO {self.buckets} BUCKETS LOCATION '{path}/pivots'"
            )
            self.spark.catalog.recoverPartitions(self._name)
            self.is_open = True

    def _exists(self, part: str) -> bool:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there)

    def append(self, images: DataFrame) -> None:
        """Accept the records of a batch."""
        self.append_signed(signatures(images))

    def append_signed(self, signed: DataFrame) -> None:
        rows = pivot_rows(signed)
        if not self.is_open:
            if self.buckets is None:
                stored = 6 * signed.filter("hash is not null").count()
                self.buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, math.ceil(stored / BUCKET_ROWS)))
            self.spark.range(1).select(F.lit(self.buckets).alias("buckets")).coalesce(1).write.parquet(f"{self.path}/layout")
        values(signed).write.mode("append").option("compression", "zstd").parquet(f"{self.path}/values")
        # The partitioning of the shuffle is that of the buckets: every task writes one.
        (
            rows.repartition(self.buckets, "n", "code").write.mode("append").option("compression", "zstd").option("path", f"{self.path}/pivots")
            .partitionBy("ring").bucketBy(self.buckets, "n", "code").sortBy("n", "code").format("parquet").saveAsTable(self._name)
        )
        self.is_open = True

    def pivots(self) -> DataFrame:
        """The stored pivot-distance table."""
        return self.spark.table(self._name)

    def _rings(self, signed: DataFrame) -> list[int]:
        """The ranges the batch's hashes lie in: 102 at most, whatever the batch."""
        return sorted(r["ring"] for r in pivot_rows(signed).select("ring").distinct().collect())

    def reached(self, batch: DataFrame) -> DataFrame:
        """ring (100 times the pair, plus the range), rows, read: the stored rows of every range, and whether the batch reads them."""
        rings = self._rings(signatures(batch))
        return self.pivots().groupBy("ring").agg(F.count("*").alias("rows")).withColumn("read", F.col("ring").isin(rings))

    def near(self, signed: DataFrame, radius: int = RADIUS) -> DataFrame:
        """hash_new, hash_old: different hashes of the batch and of the store at distance radius at most."""
        if radius > RADIUS:
            raise ValueError("two of four segments agree only up to distance 2")
        new = pivot_rows(signed).select(*(F.col(c).alias(f"new_{c}") for c in ("n", "code", "hash", "blocks", "base")))
        old = self.pivots().filter(F.col("ring").isin(self._rings(signed)))
        differing = F.col("new_blocks").bitwiseXOR(F.col("blocks"))
        first = F.lit(None).cast("tinyint")
        for n, (i, j) in reversed(list(enumerate(PAIRS))):
            first = F.when(_masked(differing, SEGMENTS[i] | SEGMENTS[j]) == 0, F.lit(n).cast("tinyint")).otherwise(first)
        return new.join(
            old,
            (F.col("new_n") == F.col("n"))
            & (F.col("new_code") == F.col("code"))
            & (F.col("new_hash") != F.col("hash"))
            & (F.abs(F.col("new_base") - F.col("base")) <= radius)
            & (F.bit_count(F.col("new_hash").bitwiseXOR(F.col("hash"))) <= radius)
            & (first == F.col("n")),
        ).select(F.col("new_hash").alias("hash_new"), F.col("hash").alias("hash_old"))

    def match(self, batch: DataFrame) -> DataFrame:
        """record_new, record_old, each pair once: every record of the batch with every stored record of an earlier batch
        it duplicates. A store without rows matches nothing."""
        return self.match_signed(signatures(batch)).distinct()

    def match_signed(self, signed: DataFrame) -> DataFrame:
        """record_new, record_old; a pair may come out more than once (by different fields)."""
        if not self.is_open:
            return self.spark.createDataFrame([], "record_new bigint, record_old bigint")
        mine, stored = values(signed), self.spark.read.schema(VALUES).parquet(f"{self.path}/values")
        same = mine.alias("n").join(stored.alias("o"), F.expr("n.kind = o.kind and n.value = o.value and n.batch_no > o.batch_no"))
        holders = signed.filter("hash is not null").select(F.col("hash").alias("hash_new"), F.col("record_no").alias("record_new"), F.col("batch_no").alias("batch_new"))
        sought = self.near(signed).distinct().join(holders, "hash_new").select("record_new", "batch_new", F.unhex(F.lpad(F.hex("hash_old"), 16, "0")).alias("value"))
        near = sought.join(stored.filter("kind = 'h'"), "value").filter("batch_new > batch_no").select("record_new", F.col("record_no").alias("record_old"))
        return same.select(F.col("n.record_no").alias("record_new"), F.col("o.record_no").alias("record_old")).unionByName(near)

    def close(self) -> None:
        """Forget the table's name; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        self.is_open = False


def _passing(spark: SparkSession) -> History:
    """A store for one query, removed when the driver ends."""
    history = History(spark, shared_path(spark, "history"))
    remove_at_end(spark, history.path)
    return history


def duplicate_pairs(images: DataFrame) -> DataFrame:
    """record_no_a < record_no_b: all duplicates and near-duplicates between different batches, each once.

    The batches go one after the other: each is matched against the store of the earlier ones, then appended. A match may
    still run while later batches are appended, as only earlier ones count for it. Records are read once; the batch numbers
    are all that reaches the driver.
    """
    spark = images.sparkSession
    signed = materialize(signatures(images), partition_by=["batch_no"])
    history, running = _passing(spark), []
    with ThreadPoolExecutor(BESIDE) as pool:
        for number in sorted(r[0] for r in signed.select("batch_no").distinct().collect()):
            batch = signed.filter(F.col("batch_no") == number)
            if history.is_open:
                running.append(pool.submit(inheritable_thread_target(spark)(materialize), history.match_signed(batch)))
            history.append_signed(batch)
        found = [r.result() for r in running]
    history.close()
    release(signed)
    if not found:
        return spark.createDataFrame([], "record_no_a bigint, record_no_b bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return (
        every.select(F.least("record_new", "record_old").alias("record_no_a"), F.greatest("record_new", "record_old").alias("record_no_b"))
        .filter("record_no_a < record_no_b")
        .distinct()
    )


def latest_batch(images: DataFrame) -> DataFrame:
    """record_no, earlier_records, first_record: the newest batch checked against the store of all earlier ones; one row for
    each of its records that has a duplicate."""
    newest = images.agg(F.max("batch_no")).first()[0]
    history = _passing(images.sparkSession)
    history.append(images.filter(F.col("batch_no") < F.lit(newest)))
    matched = materialize(history.match(images.filter(F.col("batch_no") == F.lit(newest))))
    history.close()
    return matched.groupBy(F.col("record_new").alias("record_no")).agg(F.count("*").alias("earlier_records"), F.min("record_old").alias("first_record"))
