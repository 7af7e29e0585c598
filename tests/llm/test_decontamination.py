import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from tidemark.llm import decontamination as D

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("start", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("w", T.StringType())])


def bag(w, size):
    return Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1))


def brute(docs, items):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    best = {}
    for d, text in docs:
        w = split(text)
        for i, item in items:
            v = split(item)
            size = min(5, len(v))
            if not v or d is None:
                continue
            own = bag(v, size)
            for start in range(len(w)):
                seen = bag(w[start : start + len(v)], size)
                score = sum(min(n, seen[x]) for x, n in own.items()) / sum(own.values())
                if score >= 0.8:
                    best[d, i] = max(score, best.get((d, i), 0))
    return {(d, i, round(s, 9)) for (d, i), s in best.items()}


def cases():
    item = lambda k: " ".join(f"i{k}w{j}" for j in range(18 + k))
    items = [(k, item(k).capitalize() + ".") for k in range(6)] + [(50, "Two words"), (51, ""), (52, None), (53, item(2)), (54, "re re re re re re re re")]
    filler = [f"f{j}" for j in range(300)]
    docs = [(k, " ".join(filler[: 7 * k]) + " " + item(k).upper().replace(" ", ",  ") + " " + " ".join(filler[k:])) for k in range(6)]
    docs += [(20, item(1)[:-8]), (21, " ".join(item(3).split()[:10])), (22, None), (23, ""), (24, "two, WORDS!"), (25, item(5).replace("i5w11", "changed")), (26, "word " + "re " * 40), (27, item(4)), (27, item(4)), (None, item(4)), (28, " ".join(filler) * 400 + " " + item(0))]
    halves = lambda k: " ".join(item(k).split()[12:] + item(k).split()[:12])
    long = [f"long{j}" for j in range(70)]
    items.append((60, " ".join(long)))
    docs += [(30, "x y " + halves(5) + " z"), (31, " ".join(long[30:] + long[:30])), (32, " ".join(long[:40] + ["in", "between"] + long[40:])), (33, " ".join(long[:20] + long[25:])), (34, "a b c " + " ".join(long[5:35] + long[:5] + long[35:]))]
    # rows of one id: five words of an item at its place in each of many others
    docs += [(40, " ".join(["q"] * k + long[k : k + 5] + ["q"] * (65 - k))) for k in range(40)] + [(40, " ".join(long)), (41, " ".join(long + long[:40] + long))]
    return docs, items


@pytest.mark.parametrize("bound", [D.BROADCAST_SHINGLES, 3])
def test_matches_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(D, "BROADCAST_SHINGLES", bound)
    docs, items = cases()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS)
    its = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in D.leaks(df, its).collect()}
    assert got == brute(docs, items)


def test_blocks_find_every_item_within_radius(spark):
    windows = spark.range(200).selectExpr("id AS doc_id", "0 AS start", "9 AS length", "xxhash64(id) AS f0", "xxhash64(id, 1) AS f1", "0L AS twin")
    flips = "CAST(conv(substr('1f3f07ff00ff0f0f', CAST(1 + id % 9 AS INT), 8), 16, 10) AS BIGINT)"
    items = spark.range(200).selectExpr("id AS item_id", "id AS item_twin", "9 AS item_length", f"xxhash64(id) ^ ({flips} * 65537) AS f0", f"xxhash64(id, 1) ^ {flips} AS f1")
    u = 2**64 - 1
    ws = [(r.doc_id, r.f0 & u, r.f1 & u) for r in windows.collect()]
    its = [(r.item_id, r.f0 & u, r.f1 & u) for r in items.collect()]
    want = {(a, b) for a, x, y in ws for b, p, q in its if (x ^ p).bit_count() + (y ^ q).bit_count() <= D.RADIUS}
    assert {(r.doc_id, r.item_id) for r in D.near_items(windows, items).collect()} == want and len(want) > 40


def test_empty_tables(spark):
    docs, items = cases()
    none = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    its = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS)
    assert D.leaks(none[0], its).count() == 0
    assert D.leaks(df, none[1]).count() == 0
