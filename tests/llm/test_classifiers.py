import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import language_id, ngrams, quality
from tidemark.llm.common import fold

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("label", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("text", T.StringType())])
SYLLABLES = {"aa": "ba de mi to ku la".split(), "bb": "sch ung ein ver ach öß".split(), "cc": "tion eau oui ère que les".split()}


def word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))


def corpus(n=150):
    rng = random.Random(3)
    return [(k, " ".join(word(rng, lang) for _ in range(rng.randint(4, 80))).capitalize() + ".", lang, "x") for k, lang in enumerate(rng.choices(list(SYLLABLES), k=n))]


def crc(i, of):
    return zlib.crc32(("" if i is None else str(i)).encode()) % of


def test_word_hashes_tell_words_apart_wherever_they_stand():
    a = ngrams.word_hashes(ngrams.codes("one  two\nöne one" + " x" * 5))
    assert a[0] == a[3] and len({int(x) for x in a}) == 4 and len(a) == 9
    assert not len(ngrams.word_hashes(ngrams.codes(" \n ")))


def test_language_of_held_out_texts(spark):
    rows = corpus() + [(1000, None, "aa", ""), (1001, "", "aa", ""), (1002, "12 34 !?", "bb", ""), (1003, "ba de mi " * 60_000, None, ""), (1004, "ba de mi", "aa", ""), (1004, "ba de mi", "aa", ""), (None, "eau oui les", "cc", "")]
    got = language_id.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    true = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == (true[r.doc_id] or "aa")
    assert language_id.identify(spark.createDataFrame([], DOCS)).count() == 0


def test_nothing_learned_and_rejection(spark):
    assert {r.lang_pred for r in language_id.identify(spark.createDataFrame([(1, "some text", None, "")], DOCS)).collect()} == {"und"}
    rows = corpus()
    model = language_id.train([r[1] for r in rows], [r[2] for r in rows])
    far = language_id.counts("жщ ыъ эюя " * 9)
    assert model.predict(np.asarray([far]))[2][0]
    assert len(model.centroids) <= 3 * language_id.CENTROIDS


def junk(rng):
    kind = rng.randrange(3)
    ws = [word(rng, "aa") for _ in range(60)]
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in ws)
    if kind == 1:
        return " ".join(w for x in ws[:8] for w in [x] * 9)
    return " | ".join(ws)


def test_quality_of_held_out_texts(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(400):
        good = k % 4 > 0
        rows.append((k, " ".join(word(rng, "aa") for _ in range(rng.randint(3, 90))) + "." if good else junk(rng), None, ""))
        labels.append((k, int(good), "x"))
    rows += [(900, None, None, ""), (901, "", None, ""), (902, "ba de mi " * 60_000, None, ""), (None, "ba", None, ""), (903, "ba", None, ""), (903, "ba", None, "")]
    labels += [(5000, 1, ""), (None, 1, ""), (3, None, "")]
    got = quality.classify(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    true = {i: y for i, y, _ in labels[:400]}
    held = [(r.predicted, true[r.doc_id]) for r in got if r.doc_id in true and r.held_out]
    assert len(held) > 60 and np.mean([a == b for a, b in held]) >= 0.97
    for r in got:
        assert r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1, "")], 1.0), ([(1, 0, "")], 0.0)])
def test_labels_of_one_class(spark, labels, score):
    docs = spark.createDataFrame([(1, "a text", None, ""), (3, "b", None, "")], DOCS)
    got = quality.classify(docs, spark.createDataFrame(labels, LABELS), folds=99, held=98).collect()
    assert len(got) == 2 and all(abs(r.score - score) < 1e-6 for r in got)
    assert quality.classify(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0


def test_stage_keeps_columns(spark):
    rng = random.Random(4)
    docs = [(k, junk(rng) if k % 2 else "ba de mi to " * 9, "l", "x") for k in range(80)]
    model = quality.train([d[1] for d in docs], [1 - k % 2 for k in range(80)])
    df = spark.createDataFrame(docs, DOCS)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 2))


U64 = (1 << 64) - 1


def plain_bucket(h, bits):
    return (h * int(ngrams._MIX) & U64) >> (64 - bits)


def plain_grams(codes, n, bits):
    out = []
    for k in range(len(codes) - n + 1):
        h = codes[k] * int(ngrams._ODD[n]) & U64
        for c in codes[k + 1 : k + n]:
            h = (h * int(ngrams._ODD[n + 1]) + c) & U64
        out.append(plain_bucket(h, bits))
    return out


def plain_counts(text):
    """n-grams of what letters stand between boundaries, one for all that lies between two words."""
    if not any(c.isalpha() for c in text.lower()):
        return None
    codes = [0]
    for c in text.lower():
        if c.isalpha():
            codes.append(ord(c))
        elif codes[-1] or len(codes) == 1:
            codes.append(0)
    codes.append(0)
    out = {}
    for k, n in enumerate(language_id.ORDERS):
        for b in plain_grams(codes, n, language_id.BITS):
            key = (k << language_id.BITS) + b
            out[key] = out.get(key, 0) + 1
    return out


def test_language_matches_a_plain_nearest_centroid():
    rows = corpus(60)
    texts, langs = [r[1] for r in rows], [r[2] for r in rows]
    model = language_id.train(texts, langs, k=1)
    bags = [plain_counts(t) for t in texts]
    df = {}
    for b in bags:
        for key in b:
            df[key] = df.get(key, 0) + 1
    idf = lambda key: np.log((1 + len(bags)) / (1 + df.get(key, 0))) + 1

    def vector(bag):
        v = {k: np.sqrt(n) * idf(k) for k, n in bag.items()}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {k: x / size for k, x in v.items()}

    centres = {}
    for lang in set(langs):
        total = {}
        for bag, own in zip(bags, langs):
            if own == lang:
                for k, x in vector(bag).items():
                    total[k] = total.get(k, 0) + x
        size = np.sqrt(sum(x * x for x in total.values()))
        centres[lang] = {k: x / size for k, x in total.items()}
    for text in [*texts[:20], "Tion, que! les 12 ung", "ba", "É-è  --  ß1ß", "x" * 500]:
        v = vector(plain_counts(text))
        near = {lang: sum(x * c.get(k, 0) for k, x in v.items()) for lang, c in centres.items()}
        names, score, _ = model.predict(language_id.counts(text)[None, :])
        best = max(near.values())
        assert abs(score[0] - best) < 1e-4 and abs(near[names[0]] - best) < 1e-4
    assert plain_counts("12 !") is None and language_id.counts("12 !") is None


def plain_features(text):
    """Lists of table rows by kind, as the docstring has them."""
    codes, step = [ord(c) for c in text], 1 << quality.BITS
    words = []
    for w in text.split():
        words.append(sum((ord(c) + 1) * int(ngrams._ODD[k & 63]) for k, c in enumerate(w)) * int(ngrams._MIX) & U64)
    pairs = [plain_bucket((a * 3 + b) & U64, quality.BITS) + 3 * step for a, b in zip(words, words[1:])]
    again = [(a == b) + 2 * (k > 0 and words[k - 1] == b) + 4 * step for k, (a, b) in enumerate(zip(words, words[1:]))]
    kinds = [plain_grams(codes, 3, quality.BITS), [b + step for b in plain_grams(codes, 4, quality.BITS)], [plain_bucket(w, quality.BITS) + 2 * step for w in words], pairs, again]
    return [k for k in kinds if k]


def test_quality_matches_a_plain_gradient_descent(monkeypatch):
    monkeypatch.setattr(quality, "UPDATES", 60)
    rng = random.Random(6)
    texts = [" ".join(word(rng, "aa") for _ in range(rng.randint(2, 9))) if k % 3 else "".join(rng.choice("XY! ") for _ in range(20)) for k in range(20)]
    labels = [int(k % 3 > 0) for k in range(20)]
    model = quality.train(texts, labels, (30, 10))
    draw = np.random.default_rng(5)
    table = draw.uniform(-1 / quality.DIM, 1 / quality.DIM, (quality.ROWS, quality.DIM)).astype(np.float32).astype(float)
    out, bias = np.zeros((2, quality.DIM)), np.zeros(2)
    total, done = 6 * len(texts), 0
    for _ in range(6):
        for k in draw.permutation(len(texts)):
            rate = quality.RATE * (1 - done / total)
            done += 1
            kinds = plain_features(texts[k])
            h = sum((np.mean([table[r] for r in kind], axis=0) for kind in kinds), np.zeros(quality.DIM))
            z = out @ h + bias
            p = np.exp(z) / np.exp(z).sum()
            wanted = np.full(2, quality.SMOOTH)
            wanted[labels[k]] = 1 - quality.SMOOTH
            error = p - wanted
            back = error @ out
            out, bias = out - rate * np.outer(error, h), bias - 0.1 * rate * error
            for kind in kinds:
                for r in kind:
                    table[r] -= rate * quality.STEP * back / len(kind)
    shift = np.log((10 / 30) / (sum(labels) / (len(labels) - sum(labels))))
    for text in [*texts, "ba de never seen", "", "a"]:
        mine = sum((np.mean([table[r] @ (out[1] - out[0]) for r in kind]) for kind in plain_features(text)), bias[1] - bias[0] + shift)
        assert abs(model.logit(text) - mine) < 1e-3


def test_samples_are_bounded_whatever_the_table(spark):
    rows = spark.range(30_000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' WHEN id % 10 < 9 THEN 'often' END AS lang")
    n = {r.lang: r["count"] for r in ngrams.sample(rows, "lang", 500, "id").groupBy("lang").count().collect()}
    assert n.keys() == {"rare", "often"} and all(400 < x < 600 for x in n.values())
    assert ngrams.sample(rows.where("id < 100"), "lang", 500, "id").count() == 90
    with pytest.raises(ValueError):
        ngrams.sample(rows, "id", 500, "id")


def test_fold(spark):
    ids = [0, 1, 17, 123456789, -5]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", fold(__import__("pyspark").sql.functions.col("i"), 5).alias("f")).collect()
    assert {r.i: r.f for r in got} == {i: crc(i, 5) for i in ids}
