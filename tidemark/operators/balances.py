"""Balances of holders: full aggregate, and a refresh of the pairs that a delta touched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versioned import final_latest

PAIR = ["mint", "owner"]


def live(accounts: DataFrame) -> DataFrame:
    """Accounts that count: neither deleted nor uninitialized."""
    return accounts.where((F.col("is_deleted") == 0) & (F.col("state") != 0))


def full_balances(accounts: DataFrame, baseline: bool = False) -> DataFrame:
    """(mint, owner, amount_raw, updated_slot) of pairs with a positive sum.

    `baseline`: the table holds one row for each account already, so versions need no collapse.
    """
    current = accounts if baseline else final_latest(accounts, ["pubkey"], "updated_slot", ["is_deleted"])
    sums = live(current).groupBy(*PAIR).agg(F.sum("amount").alias("amount_raw"), F.max("updated_slot").alias("updated_slot"))
    return sums.where(F.col("amount_raw") > 0).select(*PAIR, "amount_raw", "updated_slot")


def affected_pairs(*changes: DataFrame) -> DataFrame:
    """Different (mint, owner) pairs of all changes."""
    out = changes[0].select(*PAIR)
    for more in changes[1:]:
        out = out.unionByName(more.select(*PAIR))
    return out.distinct()


def refreshed_balances(accounts: DataFrame, pairs: DataFrame, snapshot_slot: int, collapse_first: bool = False) -> DataFrame:
    """New balance versions of `pairs`, zero for those without a live account.

    Versions of an account are collapsed among the rows of the affected pairs only, as only those are read. An account
    that moved from one pair to another is then still counted for its old pair when that one alone is refreshed;
    `collapse_first` looks at all rows instead.
    """
    if collapse_first:
        rows = final_latest(accounts, ["pubkey"], "updated_slot", ["is_deleted"]).join(pairs, PAIR, "left_semi")
    else:
        rows = final_latest(accounts.join(pairs, PAIR, "left_semi"), ["pubkey"], "updated_slot", ["is_deleted"])
    sums = live(rows).groupBy(*PAIR).agg(F.sum("amount").alias("amount"))
    amount = F.coalesce("amount", F.lit(0).cast(sums.schema["amount"].dataType)).alias("amount_raw")
    return pairs.select(*PAIR).distinct().join(sums, PAIR, "left").select(*PAIR, amount, F.lit(snapshot_slot).cast("long").alias("updated_slot"))


def current_balances(versions: DataFrame) -> DataFrame:
    """Balances as served: the latest version of each pair, zeros left out."""
    return final_latest(versions, PAIR, "updated_slot").where(F.col("amount_raw") > 0)


def top_holders(versions: DataFrame, mint: str, n: int = 100) -> DataFrame:
    """The largest holders of one mint; ties by owner."""
    return current_balances(versions.where(F.col("mint") == mint)).orderBy(F.desc("amount_raw"), "owner").limit(n)


def wallet_assets(versions: DataFrame, owner: str) -> DataFrame:
    return current_balances(versions.where(F.col("owner") == owner)).orderBy("mint")
