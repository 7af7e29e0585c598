import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("length", T.StringType())])


def check(spark, rows, capacity):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
    got = [r.asDict() for r in packing.pack(df, PATH, capacity).collect()]
    tok = tokenizers.Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want.append((i is None, i or 0, k, a, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(w[4] for w in want)


def test_round_trip(spark):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(f"word{j % 7}, it's {j}É" for j in range(n))) for k, n in enumerate(rng.integers(0, 60, 300))]
    rows += [(900, None), (901, ""), (902, "<|endoftext|> a<|startoftext|>b"), (903, "a\x1cb\x85c d é ́x ΟΔΟΣ İ"), (904, "same"), (904, "same"), (None, "no id"), (905, "long word " * 9000), (906, "x" * 5000)]
    n, tokens = check(spark, rows, 256)
    assert n <= 1.03 * tokens / 256 + 1
    assert check(spark, [], 256) == (0, 0)


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 129, 3000) if seed % 2 else np.minimum(128, rng.geometric(0.02, 3000)), minlength=129)
    counts[40] += 1500 * (seed == 3)
    runs, sequences = packing.plan(counts)
    room, ranks = np.zeros(sequences, int), defaultdict(list)
    for n, a, b, first, at in runs:
        assert (room[first : first + b - a] == at).all()
        room[first : first + b - a] += n
        ranks[n].append((a, b))
    assert room.max() <= 128
    for n in range(1, 129):
        at = 0
        for a, b in sorted(ranks[n]):
            assert a == at
            at = b
        assert at == counts[n]
    if seed != 3:
        assert sequences <= 1.02 * (counts * np.arange(129)).sum() / 128 + 1


def test_empty_histogram():
    assert packing.plan(np.zeros(11, int)) == ([], 0)
