"""Token lists: CSV imports of the allow-list, and the frozen list that a generation keeps."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_hot_csv(spark: SparkSession, path: str) -> DataFrame:
    """(mint, enable, version) of a CSV with a header and the mint in its second column; an empty one is an error."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if len(raw.columns) < 2:
        raise ValueError("the list needs two columns at least")
    mint = F.trim(raw[raw.columns[1]])
    checked = F.when(F.length(F.coalesce(mint, F.lit(""))) > 0, mint).otherwise(F.raise_error(F.lit("empty mint in the token list")))
    return raw.select(checked.alias("mint"), F.lit(1).cast("byte").alias("enable"), F.lit(1).cast("long").alias("version"))


def append_hot(mints: DataFrame, path: str) -> None:
    """Add the tokens of an import to the list's table; the latest version of each counts (`token_info.enabled`)."""
    mints.select("mint", "enable", "version").write.mode("append").parquet(path)


def read_hot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("mint string, enable byte, version long").parquet(path)


def write_frozen(mints: DataFrame, path: str) -> None:
    """One mint a line, sorted in files; Spark's commit makes the folder appear whole."""
    mints.select("mint").distinct().sortWithinPartitions("mint").write.mode("errorifexists").text(path)


def read_frozen(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.trim("value").alias("mint"))
    n, empty = lines.agg(F.count("*"), F.count(F.when(F.col("mint") == "", 1))).first()
    if not n or empty:
        raise ValueError(f"{path} is empty or has an empty line")
    return lines.distinct()


def unreferenced(directory: str, prefix: str, referenced: set[str]) -> list[str]:
    """Managed lists in `directory` that no working lane refers to."""
    names = (e.path for e in os.scandir(directory) if e.name.startswith(prefix))
    return sorted(p for p in names if p not in referenced)
