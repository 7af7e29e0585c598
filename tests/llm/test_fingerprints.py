import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import fingerprints, hamming

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("h", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)


@pytest.mark.parametrize("bucket_rows,ranges", [(2, 4), (3, 64), (1000, 1)])
def test_next_text_goes_round_in_order_of_id(spark, bucket_rows, ranges):
    rows = [(k * k * 7 % 1009, f"text {k} é " * (k % 5)) for k in range(40)] + [(2000, None), (2001, "")]
    rows = sorted({i: t for i, t in rows}.items())
    got = {r.id: (r.next_id, r.next_text) for r in fingerprints.with_next(frame(spark, rows), bucket_rows=bucket_rows, ranges=ranges).collect()}
    after = rows[1:] + rows[:1]
    assert got == {i: (j, t or "") for (i, _), (j, t) in zip(rows, after)}


def test_report_digests_and_ties(spark):
    rows = [(3, "alpha beta gamma delta é" * 9), (1, None), (2, "one"), (2, "one"), (9, "Éa " * 4001), (5, "")]
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.edited_report(frame(spark, rows)).collect())
    ordered = sorted((i, t or "") for i, t in rows)
    want = []
    for k, (i, t) in enumerate(ordered):
        other, half = ordered[(k + 1) % len(ordered)][1], len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + other[:half]).encode()).hexdigest()))
    assert got == sorted(want)


def plain_fingerprint(text):
    ws = text.lower().split()
    hs = [spark_hash(*ws[k : k + 3]) for k in range(max(1, len(ws) - 2))] if ws else [0]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def spark_hash(*terms):
    """Spark's hash of several columns seeds each with the one before."""
    h = 42
    for t in terms:
        h = xxhash.xxh64_intdigest(t.encode(), h)
    return h


def test_report_matches_brute_force(spark):
    rng = random.Random(13)
    base = [f"word{k}" for k in range(300)]
    rows = [(100 * k if k < 12 else 1000 + 7 * k, " ".join(base[: 250 + k % 3] + [f"x{k}"] * (k % 2))) for k in range(40)]
    rows += [(200, "one"), (3, None), (300, ""), (5001, "One"), (77, "b a " * 40)] + [(6000 + k, " ".join(rng.choice(base) for _ in range(30))) for k in range(20)]
    rows = sorted({i: t for i, t in rows}.items())
    fp = [plain_fingerprint(t or "") for _, t in rows]
    got = {r.doc_id: r for r in fingerprints.edited_report(frame(spark, rows)).collect()}
    for k, (i, t) in enumerate(rows):
        t, other = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = plain_fingerprint(t[: len(t) - len(t) // 2] + other[: len(t) // 2])
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (f"{fp[k]:016x}", f"{edited:016x}")
        assert got[i].near_edited == 1 - (fp[k] ^ edited).bit_count() / 64
        assert got[i].near_next == 1 - (fp[k] ^ fp[(k + 1) % len(rows)]).bit_count() / 64
        near = sum((fp[k] ^ f).bit_count() <= fingerprints.RADIUS for f in fp) - 1
        assert got[i].n_near == (near if i % 100 == 0 else None)
    assert sum(got[i].n_near for i, _ in rows if i % 100 == 0) > 20


def test_equal_texts_have_equal_fingerprints_and_halves_are_nearer(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(200))) for k in range(20)] + [(100, rows_text := "same text here again"), (101, rows_text)]
    got = {r.doc_id: r for r in fingerprints.edited_report(frame(spark, rows)).collect()}
    assert got[100].fingerprint == got[101].fingerprint
    assert sum(got[k].near_edited > got[k].near_next for k in range(20)) >= 18
    assert fingerprints.edited_report(frame(spark, [])).count() == 0


def test_table_search_finds_all_within_radius(spark):
    near = F.expr("xxhash64(id - id % 3) ^ shiftleft(5L, CAST(id % 60 AS INT))")
    fps = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.xxhash64("id")).otherwise(near).alias("fp"))
    rows = [(r.doc_id, r.fp & (2**64 - 1)) for r in fps.collect()]
    got = {(r.query_id, r.id, r.distance) for r in fingerprints.within(fps, fps.where("doc_id % 2 = 0"), radius=4).collect()}
    want = {(a, b, (x ^ y).bit_count()) for a, x in rows if a % 2 == 0 for b, y in rows if (x ^ y).bit_count() <= 4}
    assert got == want
    assert hamming.blocks(5)[-1] == (51, 13)
