import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import substring_dedup as S

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("start", T.StringType())])


def prose(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)


def spans(spark, rows):
    return [(r.doc_id, r.start, r.end, r.removed, r.first_doc_id) for r in S.duplicate_spans(frame(spark, rows)).collect()]


def units(text):
    return S.units(S.words_of([text]))[1:]


def hashes(words):
    return S.words_of([" ".join(words)]).h


@pytest.mark.parametrize("seed", range(5))
def test_texts_together_have_the_units_that_each_has_by_itself(seed):
    rng = random.Random(seed)
    white = [" ", "  ", "\n", "\u2003", "\t", "\n\n"]
    texts = ["".join(f"w{rng.randrange(60)}É"[: rng.randrange(1, 5)] + rng.choice(white) for _ in range(rng.randrange(rng.choice([4, 30, 300])))) for _ in range(40)] + ["", " \n", "a"]
    words = S.words_of(texts)
    for k, t in enumerate(texts):
        own = slice(words.cuts[k], words.cuts[k + 1])
        assert [t[a:b] for a, b in zip(words.first[own], words.last[own])] == t.split()
    known = {}
    for w, h in zip(" ".join(texts).split(), words.h.tolist()):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    owner, columns, bands = S.units(words, 12)
    para = columns[-1]
    for k, t in enumerate(texts):
        _, alone, keys = S.units(S.words_of([t]), 12)
        assert all((x[owner == k] == y).all() and (owner == k).sum() == len(y) for x, y in zip(columns, alone))
        assert (bands[owner[para] == k] == keys).all()
    pieces = list(S.parts(pa.array(["ab"] * 5 + ["x" * 50] + ["c"]), 8))
    assert [(a, len(t)) for a, t in pieces] == [(0, 3), (3, 2), (5, 1), (6, 1)] and pieces[2][1] == ["x" * 50] and not list(S.parts(pa.array([], pa.string())))


@pytest.mark.parametrize("seed", range(40))
def test_any_shared_run_of_44_words_has_a_block_in_common(seed):
    rng = random.Random(seed)
    passage = prose(rng, S.WINDOW + S.BLOCK)
    a = units(prose(rng, rng.randrange(90)) + " " + passage + " " + prose(rng, rng.randrange(90)))[0]
    b = units(prose(rng, rng.randrange(90)) + "\n" + passage + "\n" + prose(rng, rng.randrange(90)))[0]
    assert set(a[0][~a[4]]) & set(b[0][~b[4]])


def test_unit_hashes_depend_on_words_alone():
    text = "é one two three four five six seven eight nine ten eleven twelve 13 14 15 16 17 18 19 20 21"
    (u, c, start, length, para), bands = units("x " * 50 + "\n" + text.replace(" ", "  ") + "\nshort line")
    (v, d, *_), other = units(text)
    assert para.sum() == 2 and (u[1], c[1]) == (v[0], d[0]) and (bands[1] == other[0]).all()
    assert ("x " * 50 + "\n" + text.replace(" ", "  "))[start[1] : start[1] + length[1]] == text.replace(" ", "  ")


def test_words_of_unusual_length_and_order_have_other_hashes():
    # sums of characters with weights that repeat every 64 places can't tell such words apart
    rng = random.Random(9)
    a = ["".join(rng.choice("ab") for _ in range(200)) for _ in range(60)]
    b = [w[64:128] + w[:64] + w[128:] for w in a]
    (u, c, *_), _ = units(" ".join(a))
    (v, d, *_), _ = units(" ".join(b))
    assert len(u) > 1 and not set(zip(u, c)) & set(zip(v, d)) and not set(hashes(a)) & set(hashes(b))
    thue = ["a"]
    for _ in range(12):
        thue += ["b" if w == "a" else "a" for w in thue]
    other = ["b" if w == "a" else "a" for w in thue]
    assert units(" ".join(thue))[0][0][0] != units(" ".join(other))[0][0][0]


def test_units_of_one_key_and_different_texts_are_told_apart(spark):
    rows = [(1, 7, 100), (2, 7, 100), (3, 7, 200), (4, 8, 1), (5, 9, 2), (6, 9, 2)]
    df = spark.createDataFrame([(d, d, u, c, 5, 3) for d, u, c in rows], "doc long, key long, unit long, check int, start int, length int")
    unit = {r.doc: r.unit for r in S.told_apart(df).collect()}
    assert unit[1] == unit[2] != unit[3] and unit[4] == 8 and unit[5] == unit[6] == 9
    assert {r.unit for r in S.told_apart(df.where("doc <> 3")).collect()} == {7, 8, 9}
    for hot in (1, 100):
        got = {(r.doc, r.unit, r.first_doc_id, r.end) for r in S.repeated_blocks(df, [], hot).collect()}
        assert got == {(1, 7, 1, 8), (2, 7, 1, 8), (5, 9, 5, 8), (6, 9, 5, 8)}


def jaccard(a, b):
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.mark.parametrize("hot", [7, S.HOT])
def test_links_match_brute_force(spark, hot):
    rng = random.Random(5)
    base = [prose(rng, 120) for _ in range(3)]
    texts = []
    for b in base:
        for k in range(25):
            w = b.split()
            for _ in range(k % 6):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    texts = list(dict.fromkeys(texts))
    df = frame(spark, list(enumerate(texts))).selectExpr("doc_id doc", "xxhash64(doc_id, text) key", "text")
    found = S.written(S._all_units(df), "units").where("para")
    name = {int(units(t)[0][0][0].astype(np.int64)): k for k, t in enumerate(texts)}
    grouped = S.members(found.select("unit", "bands"), [], hot)
    assert hot > 20 or grouped.where("salt > 0").count() > 9
    seen = S.look_up(df, found.selectExpr("unit", "0 kind", "key", "start", "start + length end"))
    sets = {name[r.unit]: len(r.s) for r in seen.collect()}
    assert sets == {k: len({tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)}) for k, t in enumerate(texts)}
    got = {tuple(sorted((name[r.node], name[r.root]))) for r in S.components(S.links(grouped, seen.select("unit", "s"))).collect()}
    root = list(range(len(texts)))
    similar = [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    for _ in texts:
        for a, b in similar:
            root[a] = root[b] = min(root[a], root[b])
    groups = lambda pairs: {frozenset(x for x in range(len(texts)) if pairs[x] == r) for r in set(pairs.values())}
    mine = {k: k for k in range(len(texts))}
    for _ in texts:
        for a, b in got:
            mine[a] = mine[b] = min(mine[a], mine[b])
    assert groups(mine) == groups(dict(enumerate(root)))


def test_passages_and_clean_documents(spark):
    rng = random.Random(6)
    passage, line = prose(rng, 60), prose(rng, 15)
    near = prose(rng, 150).split()
    rows = [(k, prose(rng, 80) + "\n" + line + "\n" + prose(rng, 100)) for k in range(20)]
    rows += [(30, prose(rng, 50) + " " + passage + " " + prose(rng, 50)), (31, prose(rng, 7) + " " + passage), (32, " ".join(near)), (33, " ".join(near[:75] + ["other"] + near[76:]))]
    rows += [(40, None), (41, ""), (42, "a b"), (43, rows[0][1] + " " + passage[:20]), (None, passage), (44, passage + "\n" + passage), (45, "q r s t u " * 9000), (46, prose(rng, 10) + "\n" + passage), (46, prose(rng, 10) + "\n" + passage)]
    got = spans(spark, rows)
    docs = {g[0] for g in got}
    assert docs >= {0, 30, 31, 32, 33, 43, 44, 46} and not docs & {*range(1, 20), 40, 41, 42, 45}
    text = {i: t for i, t in rows if i is not None}
    for i, start, end, removed, first in got:
        assert 0 <= start < end <= len(text[i]) and removed == (i != first) and first <= i
    assert {(g[0], g[4]) for g in got if g[3]} >= {(31, 30), (44, 30), (33, 32), (43, 0), (46, 30)}
    out = {r.doc_id: r.text for r in S.remove_spans(frame(spark, rows), S.duplicate_spans(frame(spark, rows))).collect()}
    assert out[33] == "" and out[5] == text[5] and out[30] == text[30] and len(out[31]) < 0.6 * len(text[31]) and out[40] is None


def test_repeats_in_one_document_only_and_empty_table(spark):
    rng = random.Random(7)
    p = prose(rng, 70)
    assert spans(spark, [(1, p + "\n" + p), (2, prose(rng, 90))]) == []
    assert spans(spark, []) == []


def test_prefix_filter_finds_every_similar_pair_of_different_clusters(spark):
    rng = random.Random(8)
    common = [f"c{k}" for k in range(30)]
    sets = {}
    for k in range(60):
        own = [f"g{k // 6}x{j}" for j in range(rng.randrange(10, 60))]
        base = sets[k - 1] if k % 3 else set(own) | set(common)
        sets[k] = set(rng.sample(sorted(base), int(len(base) * rng.uniform(0.85, 1.0)))) | {f"u{k}x{j}" for j in range(rng.randrange(4))}
    number = {t: n for n, t in enumerate(sorted(set().union(*sets.values())))}
    cluster = {k: k // 2 * 2 if k % 5 else k for k in sets}
    df = spark.createDataFrame([(k, [number[t] for t in s]) for k, s in sets.items()], "unit long, s array<long>")
    units = spark.createDataFrame(list(cluster.items()), "unit long, cluster long")
    pairs = S._across(units, df, 0.8, [])
    got = {tuple(r) for r in S._verified(pairs, df, 0.8).collect()}
    want = {(a, b) for b in sets for a in range(b) if cluster[a] != cluster[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert got == want and len(want) > 10
    assert pairs.count() < 200


def test_spans_reach_as_far_as_the_texts_agree(spark):
    rng = random.Random(10)
    rows, want = [], {}
    for k in range(30):
        passage = prose(rng, rng.randrange(44, 90))
        for j in range(2):
            before, after = prose(rng, rng.randrange(40)), prose(rng, rng.randrange(40))
            text = " ".join(filter(None, (before, passage, after)))
            rows.append((2 * k + j, text))
        want[2 * k + 1] = (len(before) + bool(before), len(before) + bool(before) + len(passage))
    got = {g[0]: g[1:3] for g in spans(spark, rows) if g[3]}
    # a neighbouring word may be equal by chance
    assert got.keys() == want.keys() and all(got[i][0] <= want[i][0] and want[i][1] <= got[i][1] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 28


def test_short_whole_texts_lengths_and_clashing_names(spark):
    rng = random.Random(11)
    short, four, line = prose(rng, 7), "only four words here", prose(rng, 12)
    rows = [(1, short), (2, short + " "), (3, four), (4, four), (5, prose(rng, 30) + "\n" + line), (6, prose(rng, 30) + "\n" + line), (7, ("z" * 70 + " ") * 3000), (8, "\n".join(prose(rng, 25) for _ in range(3000)))]
    got = spans(spark, rows)
    assert got == [(1, 0, len(short), False, 1), (2, 0, len(short), True, 1)] or sorted(got) == [(1, 0, len(short), False, 1), (2, 0, len(short), True, 1)]
    df = frame(spark, rows).selectExpr("doc_id", "text", "start", "1 as _cut", "2 as _id", "3 as cut")
    lines = S.duplicate_spans(df, min_words=5)
    assert {(r.doc_id, r.removed) for r in lines.collect()} >= {(5, False), (6, True), (2, True)}
    out = S.remove_spans(df, lines)
    assert out.columns == df.columns and {r.doc_id: r.text for r in out.collect()}[6] == rows[5][1][: -len(line)]


def test_a_group_in_many_bands_takes_few_comparisons_and_loses_no_link(spark, monkeypatch):
    rng = random.Random(8)
    base, sets = [rng.getrandbits(63) for _ in range(60)], {}
    for unit in range(200):
        gone = rng.randrange(12)
        sets[unit] = set(rng.sample(base, 60 - gone)) | {rng.getrandbits(63) for _ in range(gone)}
    grouped = [(band * 12 + rng.randrange(12), 0, unit) for band in range(60) for unit in sets]
    compared, verified = [], S._verified
    monkeypatch.setattr(S, "_verified", lambda pairs, *rest: compared.extend(pairs.collect()) or verified(pairs, *rest))
    got = S.links(spark.createDataFrame(grouped, "band long, salt int, unit long"), spark.createDataFrame([(u, list(s)) for u, s in sets.items()], "unit long, s array<long>"))
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])

    def groups(pairs):
        root = {u: u for u in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        return {frozenset(u for u in sets if find(u) == r) for r in map(find, sets)}

    mine = [tuple(r) for r in got.collect()]
    assert all(alike(a, b) for a, b in mine)
    assert groups(mine) == groups([(a, b) for a in sets for b in range(a) if alike(a, b)]) and 20 < len(groups(mine)) < 180
    assert len(compared) < 10 * len(sets)


def test_what_is_ruled_out_by_parities_is_not_similar(spark):
    rng = random.Random(13)
    rows, similar = [], 0
    for k in range(400):
        n = rng.choice([1, 2, 5, 30, 300])
        a = {rng.getrandbits(63) for _ in range(n)}
        b = set(rng.sample(sorted(a), n - rng.randrange(n // 4 + 1))) | {rng.getrandbits(63) for _ in range(rng.randrange(n // 5 + 1))}
        similar += len(a & b) >= 0.8 * len(a | b)
        rows.append((list(a), list(b), len(a & b) >= 0.8 * len(a | b)))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, similar boolean")
    side = lambda df, c, end: df.select("*", *[x.alias(f"p{w}{end}") for w, x in enumerate(S._parities(c))], F.size(c).alias("n" + end))
    fit = side(side(df, "a", ""), "b", "0").select("similar", S._fit("", "0", 0.8)[0].alias("fit")).collect()
    assert 50 < similar < 350 and all(r.fit for r in fit if r.similar) and not all(r.fit for r in fit)
