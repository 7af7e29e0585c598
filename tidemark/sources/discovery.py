"""Which checkpoint archives there are, and which to take next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import snapshot_kind
from tidemark.sources import paths

_KEY = r"[1-9A-HJ-NP-Za-km-z]+"
_FULL = rf"^snapshot-(\d+)-({_KEY})\.tar\.zst$"
_DELTA = rf"^incremental-snapshot-(\d+)-(\d+)-({_KEY})\.tar\.zst$"


def catalogue(names: DataFrame, path: str = "path") -> DataFrame:
    """(path, kind, base_slot, slot, hash) of the paths whose base name is an archive's; others are left out."""
    base = F.element_at(F.split(path, "/"), -1)
    full, delta = base.rlike(_FULL), base.rlike(_DELTA)
    pick = lambda f, d: F.when(full, F.regexp_extract(base, _FULL, f)).when(delta, F.regexp_extract(base, _DELTA, d))
    rows = names.where(full | delta)
    return rows.select(
        F.col(path).alias("path"), F.when(full, "full").otherwise("incremental").alias("kind"),
        F.when(delta, F.regexp_extract(base, _DELTA, 1)).try_cast("long").alias("base_slot"), pick(1, 2).try_cast("long").alias("slot"), pick(2, 3).alias("hash"),
    ).where("slot IS NOT NULL")


def discover(spark: SparkSession, directory: str) -> DataFrame:
    """The archives of a directory."""
    return catalogue(spark.createDataFrame([(p,) for p in paths.files(spark, directory)], "path string"))


def eligible_incrementals(archives: DataFrame, last: int) -> DataFrame:
    """Incrementals that start at or before `last` and end after it; the furthest first."""
    rows = archives.where((F.col("kind") == "incremental") & (F.col("base_slot") <= last) & (F.col("slot") > last))
    return rows.orderBy(F.desc("slot"), "path")


def eligible_fulls(archives: DataFrame, last: int) -> DataFrame:
    return archives.where((F.col("kind") == "full") & (F.col("slot") > last)).orderBy(F.desc("slot"), "path")


def candidates(archives: DataFrame, last: int) -> DataFrame:
    """Incrementals before fulls, each the furthest first: what can be applied after `last`, best first."""
    rows = archives.where((F.col("slot") > last) & ((F.col("kind") == "full") | (F.col("base_slot") <= last)))
    return rows.withColumn("choice", F.row_number().over(_best())).orderBy("choice")


def _best():
    from pyspark.sql import Window

    return Window.orderBy((F.col("kind") == "full").cast("int"), F.desc("slot"), "path")  # archive lists are short


def newest_full(archives: DataFrame, after: int) -> DataFrame:
    """The full archive of the greatest slot after `after`; the smallest path at a tie."""
    return eligible_fulls(archives, after).limit(1)


def processed(archives: DataFrame, watermark: int) -> DataFrame:
    """Archives that a completed `watermark` makes superfluous."""
    return archives.where(F.col("slot") <= watermark)


def classify(sources: DataFrame, column: str = "source") -> DataFrame:
    return sources.withColumn("kind", snapshot_kind(F.col(column)))
