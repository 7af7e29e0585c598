"""The display row of each hot mint: mint and metadata joined to the list, with defaults for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import default_if_empty
from tidemark.operators.versioned import final_latest


def left_any(left: DataFrame, right: DataFrame, key: str, version: str) -> DataFrame:
    """A left join that matches at most one row, the latest; the right side is cut to the left's keys first."""
    one = final_latest(right.join(left.select(key).distinct(), key, "left_semi"), [key], version)
    return left.join(one, key, "left")


def token_info(hot: DataFrame, mints: DataFrame, metadata: DataFrame) -> DataFrame:
    """A row for each different mint of `hot`, exactly."""
    m = mints.select("mint", "decimals", F.col("supply").alias("supply_raw"), F.col("updated_slot").alias("mint_updated_slot"))
    d = metadata.select("mint", "name", "symbol", "uri", "token_standard", "extensions", F.col("updated_slot").alias("metadata_updated_slot"))
    both = left_any(left_any(hot.select("mint").distinct(), m, "mint", "mint_updated_slot"), d, "mint", "metadata_updated_slot")
    slot = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return both.select(
        "mint", F.coalesce("decimals", F.lit(0).cast("short")).alias("decimals"), F.coalesce("supply_raw", F.lit(0).cast("decimal(20,0)")).alias("supply_raw"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "symbol", "uri")], "token_standard", default_if_empty(F.col("extensions"), F.lit("[]")).alias("extensions"),
        slot("mint_updated_slot").alias("mint_updated_slot"), slot("metadata_updated_slot").alias("metadata_updated_slot"),
        F.greatest(slot("mint_updated_slot"), slot("metadata_updated_slot")).alias("updated_slot"),
    )


def enabled(hot_tokens: DataFrame) -> DataFrame:
    """(mint, version) of the tokens that are enabled: the choice of the latest version comes before the filter."""
    return final_latest(hot_tokens, ["mint"], "version", ["enable"]).where("enable = 1").select("mint", "version")


def restrict(df: DataFrame, keys: DataFrame, key: str = "mint", bound: int = 1_000_000) -> DataFrame:
    """Rows whose key is listed. The list is broadcast if it has at most `bound` keys, else both sides are shuffled."""
    listed = keys.select(key).distinct()
    small = listed.limit(bound + 1).count() <= bound
    return df.join(F.broadcast(listed) if small else listed, key, "left_semi")
