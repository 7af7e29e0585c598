"""Counters, part reports and checks of schemas and generations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import SIZE_UNITS, readable_size


def counters(rules: dict[str, Column]) -> list[Column]:
    """Conditional counts for one aggregation, whatever their number."""
    return [F.count_if(rule).alias(name) for name, rule in rules.items()]


def parts_report(parts: DataFrame, largest: str = SIZE_UNITS[-1]) -> DataFrame:
    """(partition, parts_count, rows, size) of (partition, rows, bytes), the most parts first; sizes are in units up to `largest`."""
    sums = parts.groupBy("partition").agg(F.count("*").alias("parts_count"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    return sums.select("partition", "parts_count", "rows", readable_size(F.col("bytes"), largest).alias("size")).orderBy(F.desc("parts_count"), "partition")


def total_parts(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.sum("parts_count"), F.lit(0)).alias("parts_count"))


def catalogue_gaps(table: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(column_name, expected, actual, problem) for each expected column that is missing or of another type."""
    spark = table.sparkSession
    want = spark.createDataFrame(list(expected.items()), "column_name string, expected string")
    have = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in table.schema.fields], "column_name string, actual string")
    both = want.join(have, "column_name", "left").where(~F.col("actual").eqNullSafe(F.col("expected")))
    return both.select("column_name", "expected", "actual", F.when(F.col("actual").isNull(), "missing").otherwise("mismatch").alias("problem"))


def table_gaps(have: DataFrame, want: DataFrame) -> DataFrame:
    """(table_name, column_name, expected, actual, problem) of what `want` lists and `have` lacks or has otherwise; both
    are (table_name, column_name, kind), a kind being a type, `key n` or `sorted n`. A table that is missing altogether is one row."""
    tables = have.select("table_name").distinct().withColumn("there", F.lit(True))
    role = F.regexp_extract("kind", "^(key|sorted) ", 1).alias("role")
    actual = have.select("table_name", "column_name", role, F.col("kind").alias("actual"))
    named = want.select("table_name", "column_name", role, F.col("kind").alias("expected"))
    both = named.join(tables, "table_name", "left").join(actual, ["table_name", "column_name", "role"], "left")
    missing = both.where("there IS NULL").select("table_name").distinct().select("table_name", *[F.lit(None).cast("string").alias(c) for c in ("column_name", "expected", "actual")], F.lit("missing table").alias("problem"))
    wrong = both.where("there IS NOT NULL").where(~F.col("actual").eqNullSafe(F.col("expected")))
    wrong = wrong.select("table_name", "column_name", "expected", "actual", F.when(F.col("actual").isNull(), "missing").otherwise("mismatch").alias("problem"))
    return missing.unionByName(wrong)


def staging_check(info: DataFrame, frozen: DataFrame) -> DataFrame:
    """One row: whether the display table has a row for each frozen token, and any at all."""
    n = info.agg(F.count("*").alias("info_rows")).crossJoin(frozen.agg(F.count("*").alias("frozen_rows")))  # one row each
    return n.select("info_rows", "frozen_rows", ((F.col("info_rows") == F.col("frozen_rows")) & (F.col("info_rows") > 0)).alias("valid"))
