"""Current state of versioned tables: the latest row of each key, without deleted ones."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # rank = 1 lets Catalyst keep one row of each key before the shuffle (WindowGroupLimit): a hot key costs no task more
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    name = f"rank {uuid.uuid4().hex}"  # no column of a caller's has this name
    return df.withColumn(name, rank).where(F.col(f"`{name}`") == 1).drop(name)


def final_latest(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = (), deleted: str | None = None) -> DataFrame:
    """One row of each key: the greatest version, then the greatest ties. A key whose row is `deleted` (1) is dropped,
    after the choice, so a tombstone hides what it supersedes."""
    out = _ranked(df, keys, [F.col(c).desc_nulls_last() for c in (version, *ties)])
    return out.where(F.col(deleted) == 0) if deleted else out


def first_wins(df: DataFrame, keys: Sequence[str], position: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row of each key: the first by position."""
    return _ranked(df, keys, [F.col(c).asc_nulls_last() for c in (position, *ties)])


def argmax_struct(df: DataFrame, keys: Sequence[str], version: str, fields: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """`fields` of the row of the greatest (version, ties) of each key: all from one row."""
    best = F.max_by(F.struct(*fields), F.struct(version, *ties)).alias("_best")
    return df.groupBy(*keys).agg(best, F.max(version).alias(version)).select(*keys, version, "_best.*")


def latest_per_key_of(df: DataFrame, keep: DataFrame, on: Sequence[str], keys: Sequence[str], version: str) -> DataFrame:
    """Rows whose `on` columns stand in `keep`, then the latest of each key; the restriction comes first, on purpose."""
    return final_latest(df.join(keep.select(*on).distinct(), list(on), "left_semi"), keys, version)


def max_version(df: DataFrame, version: str, default: int = 0) -> DataFrame:
    return df.agg(F.coalesce(F.max(version), F.lit(default)).cast("long").alias(version))


def resume_watermark(df: DataFrame, version: str, rewind: int = 1000) -> DataFrame:
    """Where to resume: the greatest version less `rewind`, not under zero."""
    return max_version(df, version).select(F.greatest(F.col(version) - rewind, F.lit(0)).cast("long").alias("watermark"))


def after_watermark(df: DataFrame, version: str, watermark: int | None) -> DataFrame:
    """Rows newer than the watermark; None keeps all."""
    return df if watermark is None else df.where(F.col(version) > watermark)
