import itertools
import random

from lamella.llm import history

DDL = "record_no bigint, batch_no int, sha256 string, pixel_sha256 string, perceptual_dhash64 string, frame_count int, hash string, value string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], DDL)


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_pivots_give_block_distances(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    hs = [rng.getrandbits(64) for _ in range(20)]
    signed = [h - (1 << 64) if h >> 63 else h for h in hs]
    got = [r[0] for r in spark.createDataFrame([(h,) for h in signed], "h bigint").select(history.block_distances(F.col("h"))).collect()]
    p = history.pivots()
    for h, packed in zip(hs, got):
        base = (h ^ p[0]).bit_count()
        for b in range(32):
            assert (packed >> (2 * b)) & 3 == (base + 2 - (h ^ p[b + 1]).bit_count()) // 2


def test_equals_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    rows = []
    for i in range(400):
        h = rng.choice(base)
        for bit in rng.sample(range(64), rng.choice((0, 1, 2, 3, 4))):
            h ^= 1 << bit
        digest = rng.choice([None, f"{rng.randrange(30):064x}"])
        rows.append((i, rng.randrange(4), digest, f"{rng.randrange(60):064x}", f"{h:016x}", rng.choice((1, 1, 2, None))))
    want = set()
    for a, b in itertools.combinations(rows, 2):
        if a[1] != b[1] and (
            (a[2] and a[2] == b[2]) or (a[5] == b[5] == 1 and a[3] == b[3]) or (int(a[4], 16) ^ int(b[4], 16)).bit_count() <= 2 and all(4 <= int(x[4], 16).bit_count() <= 60 for x in (a, b))
        ):
            want.add((a[0], b[0]))
    assert pairs(history.duplicate_pairs(frame(spark, rows))) == want


def test_batches_against_stored_history(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, i % 3, f"{rng.randrange(20):064x}", None, f"{rng.getrandbits(64):016x}", 1) for i in range(90)]
    df = frame(spark, rows)
    store = history.History(spark, str(tmp_path / "h"))
    found = set()
    for batch in range(3):
        part = df.filter(f"batch_no = {batch}")
        if batch:
            found |= {(min(r), max(r)) for r in map(tuple, store.match(part).collect())}
        store.append(part)
    assert found == pairs(history.duplicate_pairs(df)) and found
    last = {r["record_no"]: r["earlier_records"] for r in history.latest_batch(df).collect()}
    assert sum(last.values()) == sum(1 for p in found if any(x % 3 == 2 for x in p))


def test_spellings_nulls_and_repeats(spark):
    d, h = "ab" * 32, "f0f0f0f0f0f0f0f0"
    rows = [
        (1, 0, d, None, None, None), (2, 1, f"SHA-256={d.upper()}", None, "0x" + h, 1), (3, 2, None, None, h[:8] + "-" + h[8:], 1), (4, 0, d[:-1], None, h[:-1], 1), (5, 1, d[:-1], None, h[:-1], 1),
        (6, 0, None, None, "0" * 16, 1), (7, 1, None, None, "0" * 16, 1), (None, 1, d, None, h, 1), (8, None, d, None, h, 1), (2, 1, d, None, h, 1), (9, 3, "", "n/a", "-", 1), (10, 4, "", "n/a", "-", 1),
    ]
    assert pairs(history.duplicate_pairs(frame(spark, rows))) == {(1, 2), (2, 3)}


def test_empty(spark):
    assert history.duplicate_pairs(frame(spark, [])).count() == 0


def test_hot_value(spark):
    rows = [(i, 0, "a" * 64, None, "f0f0f0f0f0f0f0f0", 1) for i in range(1000)] + [(1000, 1, "a" * 64, None, "f0f0f0f0f0f0f0f1", 1)]
    assert history.duplicate_pairs(frame(spark, rows)).count() == 1000


def test_stored_distances_and_ranges(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, i % 2, None, None, f"{rng.getrandbits(64):016x}", 1) for i in range(400)]
    path = str(tmp_path / "h")
    store = history.History(spark, path, buckets=3)
    store.append(frame(spark, rows).filter("batch_no = 0"))
    table = store.pivots()
    assert table.count() == 6 * 200 and set(table.columns) == {"n", "code", "hash", "blocks", "base", "ring"}
    # One new hash near the base pivot reads the ranges around it only; every other range stays unread.
    close = history.BASE_PIVOT ^ 0b111
    new = frame(spark, [(1000, 5, None, None, f"{close:016x}", 1), (1001, 5, None, None, f"{close ^ 1:016x}", 1)])
    store.append(frame(spark, [(999, 1, None, None, f"{close ^ (1 << 63):016x}", 1)]))
    reached = {r["ring"]: (r["rows"], r["read"]) for r in store.reached(new).collect()}
    assert sum(n for n, read in reached.values() if read) < sum(n for n, _ in reached.values()) / 10
    assert pairs(store.match(new)) == {(1000, 999), (1001, 999)}
    store.close()
    again = history.History(spark, path)
    assert again.buckets == 3 and pairs(again.match(new)) == {(1000, 999), (1001, 999)}
    plan = again.near(history.signatures(new))._jdf.queryExecution().executedPlan().toString()
    assert "ring" in plan and "PartitionFilters" in plan
    again.append(frame(spark, rows).filter("batch_no = 1"))
    assert again.pivots().count() == 6 * 401
    again.close()


def test_large_batches_do_not_shuffle_the_store(spark, tmp_path):
    store = history.History(spark, str(tmp_path / "h"), buckets=4)
    rng = random.Random(6)
    rows = [(i, i % 2, None, None, f"{rng.getrandbits(64):016x}", 1) for i in range(50)]
    store.append(frame(spark, rows).filter("batch_no = 0"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = store.near(history.signatures(frame(spark, rows).filter("batch_no = 1")))
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    old = plan[plan.rindex("Sort ") :]
    assert "Bucketed: true" in old and "Exchange" not in old
    store.close()


def test_base64_digests_match_hex(spark):
    import base64

    raw = bytes(range(32))
    rows = [(1, 0, base64.b64encode(raw).decode(), None, None, 1), (2, 1, raw.hex(), None, None, 1), (3, 2, None, base64.urlsafe_b64encode(raw).decode(), None, 1), (4, 3, None, raw.hex().upper(), None, 1)]
    assert pairs(history.duplicate_pairs(frame(spark, rows))) == {(1, 2), (3, 4)}


def test_empty_latest(spark):
    assert history.latest_batch(frame(spark, [])).count() == 0
