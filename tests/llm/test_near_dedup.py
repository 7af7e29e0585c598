import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from tidemark.llm import near_dedup

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.IntegerType())])


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    root = {f: f for _, f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in list(root):
        for b in list(root):
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    low = {}
    for i, f in fps:
        low[find(f)] = min(i, low.get(find(f), i))
    return sorted((i, f"{f:016x}", low[find(f)]) for i, f in fps)


def result(spark, rows):
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], DOCS)
    return sorted(tuple(r) for r in near_dedup.near_duplicates(df).collect())


def test_matches_brute_force(spark):
    base = [f"w{k % 37}x{k}" for k in range(400)]
    rows = [(k, " ".join(base[:k] + [f"Edit{k}É"] + base[k + 1 :])) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "one two"), (105, "ONE two x\x0by"), (106, "a b c"), (107, "A B\nC"), (107, "A B\nC"), (108, "z " * 50_000)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("crowded", [near_dedup.CROWDED, 1])
def test_chains_reach_the_smallest_id(spark, crowded):
    df = spark.createDataFrame([(0b0,), (0b11,), (0b1111,), (0b11111100,), (-1,)], "fp long")
    assert {(r.a, r.b) for r in near_dedup.links(df, crowded=crowded).collect()} == {(3, 0), (15, 3)}
    assert near_dedup.links(df, 0, crowded).count() == 0
    one = spark.createDataFrame([(0,), (1,), (3,), (-(1 << 63),)], "fp long")
    assert {(r.a, r.b) for r in near_dedup.links(one, 1, crowded).collect()} == {(1, 0), (3, 1), (0, -(1 << 63))}


@pytest.mark.parametrize("crowded", [near_dedup.CROWDED, 2])
def test_links_connect_what_is_within_two_bits(spark, crowded):
    rng = random.Random(12)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps.add(f)
            f ^= sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) % (1 << 64)
    # many that agree in one half and differ in the other
    fps |= {(7 << 32) | rng.getrandbits(32) for _ in range(200)} | {(7 << 32) | 1 << k for k in range(32)}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    got = near_dedup.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), crowded=crowded).collect()
    root = {f: f for f in fps}
    mine = dict(root)

    def find(roots, x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                root[find(root, a)] = find(root, b)
    for r in got:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert 0 < (a ^ b).bit_count() <= 2
        mine[find(mine, a)] = find(mine, b)
    groups = lambda roots: {frozenset(x for x in fps if find(roots, x) == r) for r in {find(roots, x) for x in fps}}
    assert groups(mine) == groups(root) and len(groups(root)) < len(fps) - 50


def test_rows_without_an_id(spark):
    rows = [(None, "same text here"), (5, "same text here"), (None, "other words than these")]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], DOCS)
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {(None, 5), (5, 5), (None, None)}


def test_empty_table(spark):
    assert result(spark, []) == []


def test_wide_fingerprints_are_the_signs_of_summed_votes():
    rng = np.random.default_rng(5)
    sizes = [1, 9, 700, *[40] * near_dedup.BLOCK]
    sets = [rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in sizes]
    got = near_dedup.wide_fingerprints(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
    votes = near_dedup._votes()
    for k in (0, 1, 2, 3, len(sets) - 1):
        sums = sum((-1 if int(h) >> 63 else 1) * votes[(int(h) >> 20) % near_dedup.BUCKETS].astype(np.int64) for h in sets[k])
        assert np.unpackbits(got[k]).tolist() == (sums > 0).astype(int).tolist()


def test_texts_of_the_similarity_meet_by_simhash_and_strangers_do_not(spark):
    rng = np.random.default_rng(6)
    # pairs of 45 shingles, 40 of them shared: similarity 0.8
    drawn = [rng.integers(0, 1 << 64, 50, dtype=np.uint64) for _ in range(150)]
    sets = [s for x in drawn for s in (x[:45], x[5:])] + [rng.integers(0, 1 << 64, 45, dtype=np.uint64) for _ in range(150)]
    prints = near_dedup.wide_fingerprints(np.concatenate(sets), np.repeat(np.arange(len(sets)), 45), len(sets))
    df = spark.createDataFrame([(k, bytearray(p.tobytes())) for k, p in enumerate(prints)], "unit long, fp binary")
    found = {r.unit: set(r.bands) for r in near_dedup.meetings(df, 0.8, []).collect()}
    assert all(found.get(k, set()) & found.get(k + 1, set()) for k in range(0, 300, 2))
    assert sum(k >= 300 for k in found) < 5


def test_entries_that_meet_are_those_of_brute_force_across_batches(spark):
    rng = random.Random(7)
    rows, unit = [], 0
    for key, n in enumerate([1, 2, 3, 9, near_dedup.CROWDED, near_dedup.CROWDED + 1, 1, 300, 2]):
        for _ in range(n):
            rows.append((key, unit, rng.getrandbits(3), rng.getrandbits(60)))
            unit += 1
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = sorted(tuple(r) for r in near_dedup._met(spark.createDataFrame(rows, "key long, unit long, c0 long, c1 long"), 22).collect())
            entry = lambda key: [r for r in rows if r[0] == key]
            near = lambda a, b: a[1] != b[1] and (a[2] ^ b[2]).bit_count() + (a[3] ^ b[3]).bit_count() <= 22
            want = sorted((r[1], r[0]) for r in rows if len(entry(r[0])) > near_dedup.CROWDED or any(near(r, x) for x in entry(r[0])))
            assert got == want and near_dedup.CROWDED + 301 < len(want) < len(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
