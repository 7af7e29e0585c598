"""Closed accounts: candidates in a delta, and the tombstones that follow from what the state knows of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versioned import final_latest


def canonical_empty(data_len: Column, lamports: Column, owner_is_default: Column, executable: Column) -> Column:
    """An account that was closed for good: nothing in it, owned by nobody."""
    return (data_len == 0) & (lamports == 0) & owner_is_default & ~executable


def close_candidates(accounts: DataFrame, key: str = "pubkey", slot: str = "slot", lamports: str = "lamports") -> DataFrame:
    """(key, slot): accounts without lamports, at the latest slot each was seen so."""
    return accounts.where(F.col(lamports) == 0).groupBy(key).agg(F.max(slot).alias(slot))


def tombstones(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """State rows that delete: for each candidate whose account is live in `state` at an earlier slot.

    The pair is recovered from the state, as the closed account no longer has it.
    """
    now = final_latest(state, ["pubkey"], "updated_slot", ["is_deleted"], deleted="is_deleted").select("pubkey", "mint", "owner", F.col("updated_slot").alias("seen"))
    hit = candidates.select("pubkey", "slot").join(now, "pubkey").where((F.col("seen") < F.col("slot")) & (F.col("mint") != "") & (F.col("owner") != ""))
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("decimal(20,0)")
    return hit.select(
        "pubkey", "mint", "owner", zero.alias("amount"), none.alias("delegate"), zero.alias("delegated_amount"), F.lit(0).cast("byte").alias("state"),
        none.alias("close_authority"), F.lit(1).cast("byte").alias("is_deleted"), F.col("slot").cast("long").alias("updated_slot"),
    )
