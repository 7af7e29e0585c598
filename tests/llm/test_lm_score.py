import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from tidemark.llm import lm_score

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("block", T.StringType())])


def split(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(rows):
    c = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        ws = split(t)
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i is None, i or 0, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [300, 1 << 25])
def test_base_matches_brute_force(spark, block_bytes):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(["the", "of", "Ä", f"w{rng.randrange(90)}"]) for _ in range(rng.randrange(40)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, "THE \x0b Éa b\x85"), (503, "x y " * 40_000), (7, "the"), (7, "the"), (None, "the of")]
    got = lm_score.scores(spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS), block_bytes=block_bytes).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


HELD = next(i for i in range(99) if held(i))


def test_no_training_rows(spark):
    assert held(HELD)
    got = lm_score.scores(spark.createDataFrame([(HELD, "a b", "")], DOCS)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)]
    assert lm_score.scores(spark.createDataFrame([], DOCS)).count() == 0


def model(texts, head):
    c = Counter(w for t in texts for w in split(t))
    top = [(w, n) for w, n in c.most_common() if w is not None][:head]
    index = {w: k for k, (w, _) in enumerate(top)} | {None: len(top)}
    pairs, triples = Counter(), Counter()
    for t in texts:
        ids = [len(top) + 1, *(index.get(w, -1) for w in split(t))]
        pairs.update(p for p in zip(ids, ids[1:]) if -1 not in p)
        triples.update(p for p in zip(ids, ids[1:], ids[2:]) if -1 not in p and p[0] < len(top))
    auto = lm_score.build([(w.encode(), n) for w, n in top], c[None], sum(c.values()), len(c), pairs, triples)
    return auto, c


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 50])
def test_gathered_model_equals_the_model_of_all_texts(spark, vocabulary):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b", *(f"w{k}" for k in range(vocabulary))][:vocabulary]) for _ in range(rng.randrange(9))) for _ in range(300)]
    auto, _ = lm_score.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    want, c = model(texts, None)
    assert (auto.total, auto.distinct) == (sum(c.values()), len(c))
    for t in texts[:40]:
        words = [(w or "").encode() for w in split(t)]
        logs = [want.unigram(c[w]) for w in split(t)]
        assert abs(auto.score(words, logs) - want.score(words, logs)) < 1e-9
        assert auto.score(words, logs) < 0


def test_probabilities_sum_to_one_in_every_state():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("a a a b b c d e f g h".split()) for _ in range(rng.randrange(12))) for _ in range(200)]
    auto, c = model(texts, 5)
    assert len(auto.arcs) > 20
    for s in range(len(auto.arcs)):
        total = sum(10 ** auto.log_probability(s, (w or "").encode(), n) for w, n in c.items()) + 10 ** auto.log_probability(s, b"never", 0)
        assert abs(total - 1) < 1e-9


def test_traversal_follows_the_longest_suffix():
    texts = ["a b c a b c a b d"] * 9 + ["c b a"] * 3
    auto, c = model(texts, 6)
    text = "a b c a b never a b d"
    words = [(w or "").encode() for w in split(text)]
    logs = [auto.unigram(c[w]) for w in split(text)]
    want, state = 0.0, auto.start
    for w, p in zip(words, logs):
        want += auto.log_probability(state, w, 0 if w == b"never" else c[w.decode() or None])
        while (hit := auto.arcs[state].get(w)) is None and state:
            state = auto.fail[state]
        state = hit[1] if hit else 0
    assert abs(auto.score(words, logs) - want) < 1e-9
    assert auto.score(words, logs) > sum(logs)


@pytest.mark.parametrize("block_bytes", [900, 1 << 25])
def test_scores_are_those_of_the_model_of_all_ngrams(spark, block_bytes):
    rng = random.Random(4)
    phrases = [" ".join(f"w{rng.randrange(3000)}" for _ in range(9)) for _ in range(60)]
    rows = [(k, " ".join(rng.choice([*phrases, "a b", f"w{rng.randrange(3000)}"]) for _ in range(rng.randrange(8)))) for k in range(150)]
    rows += [(500, ""), (501, "W1 w2"), (502, "never seen words")]
    auto, c = model([t for i, t in rows if not held(i)], None)
    assert auto.distinct > 400 and sum(held(i) for i, _ in rows) > 9
    want = {}
    for i, t in rows:
        logs = [auto.unigram(c[w]) for w in split(t)]
        want[i] = auto.score([(w or "").encode() for w in split(t)], logs)
    got = {r.doc_id: r.score for r in lm_score.scores(spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS), block_bytes=block_bytes).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)
