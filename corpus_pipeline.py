"""From raw documents to packed training sequences: quality, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns
of documents. `run` writes each stage's rows to the shared folder and reads them for the next, so a lost executor costs
at most the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_dedup, packing, quality, queries, secrets
from tidemark.llm.common import fold, forget, table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on the labels of these documents, held-out folds aside."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 4) != 2))
    return quality.keep_good(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more) stays, the one of smallest id."""
    return near_dedup.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    return secrets.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its place in a sequence."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed),
]

#: Classifier, SimHash and tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)
        before = docs
    return docs
