import random

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from tidemark.llm import secrets
from tests.llm.test_classifiers import junk, word

pytest.importorskip("public_tokenizers")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(9)
    at = str(tmp_path_factory.mktemp("sf"))
    clean = lambda: " ".join(word(rng, "aa") for _ in range(rng.randint(60, 120))) + "."
    docs = {k: clean() for k in range(100)} | {k: junk(rng) for k in range(100, 140)}
    item = " ".join(f"bench{k}" for k in range(20))
    docs |= {200: docs[3], 201: docs[4], 202: clean() + " " + item + " " + clean(), 203: clean() + " password=a32fee55ad489a779b " + clean()}
    rows = [(i, t, "aa", "s", len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i in range(140)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_each_stage_decides(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    ids = lambda df: {r.doc_id for r in df.collect()}
    all_ids = ids(docs)
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality_classifier"](spark, docs, sf_dir)
    assert good.columns == columns and ids(good) == all_ids - set(range(100, 140))
    single = steps["simhash_near_dedup"](spark, good, sf_dir)
    assert single.columns == columns and ids(single) == ids(good) - {200, 201}
    held = steps["benchmark_decontamination"](spark, single, sf_dir)
    assert held.columns == columns and ids(held) == ids(single) - {202}
    masked = steps["secret_scans"](spark, held, sf_dir)
    rows = {r.doc_id: r for r in masked.collect()}
    assert masked.columns == columns and set(rows) == ids(held)
    assert secrets.MASK in rows[203].text and "a32fee" not in rows[203].text and all(r.n_chars == len(r.text) for r in rows.values())
    assert {i: r.text for i, r in rows.items() if i != 203} == {r.doc_id: r.text for r in held.collect() if r.doc_id != 203}
    assert ids(steps["best_fit_packing"](spark, masked, sf_dir)) == set(rows)


def test_whole_run_and_empty_table(spark, sf_dir, tmp_path):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in out.collect()} == (set(range(100)) | {203})
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_that_need_care(spark, sf_dir):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "aa", "s", 0), (2, "ba de mi", "aa", "s", 8), (2, "ba de mi", "aa", "s", 8)]
    docs = spark.createDataFrame(rows, DOCS)
    steps = dict(corpus_pipeline.STAGES)
    assert steps["simhash_near_dedup"](spark, docs, sf_dir).count() == 2
    assert steps["benchmark_decontamination"](spark, docs, sf_dir).count() == 5
    assert steps["secret_scans"](spark, docs, sf_dir).count() == 5
    assert steps["best_fit_packing"](spark, docs, sf_dir).count() == 5


def test_near_copies_of_similarity_from_a_threshold_go(spark, sf_dir):
    rng = random.Random(11)
    sets = lambda t: {tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    alike = lambda a, b: len(sets(a) & sets(b)) / len(sets(a) | sets(b))
    rows, gone, near = [], set(), []
    for k in range(80):
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 300)))
        copy = base.split()
        for _ in range(1 + k % 8):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        copy = " ".join(copy).upper()
        rows += [(k, base, "aa", "s", 1), (1000 + k, copy, "aa", "s", 1)]
        if alike(base, copy) >= 0.8:
            gone.add(1000 + k)
            near.append(alike(base, copy))
    assert 20 < len(gone) < 75 and min(near) < 0.83
    stay = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, spark.createDataFrame(rows, DOCS), sf_dir)
    assert {r.doc_id for r in stay.collect()} == {r[0] for r in rows} - gone
