"""The watch as Structured Streaming: micro-batches of account versions keep state and balances by foreachBatch.

State is laid out in BUCKETS folders by pair, and a batch reads the folders of the pairs it touches alone. Every
COMPACT batches what came before is rewritten as a base without superseded rows, so what a batch reads doesn't grow
with the number of batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import balances
from tidemark.operators.versioned import final_latest
from tidemark.plans.schemas import TABLES, conform
from tidemark.sources import paths

STATE, BALANCE = "hot_token_account_state", "hot_wallet_token_balance"
BUCKETS, COMPACT = 64, 50
#: An account's versions under another pair are kept: a pair's sum asks for the latest of its own.
_KEPT = {STATE: ["pubkey", "mint", "owner"], BALANCE: ["mint", "owner"]}


def _bucket() -> Column:
    return F.pmod(F.xxhash64("mint", "owner"), F.lit(BUCKETS)).cast("int").alias("bucket")


def refresh_balances(changes: DataFrame, root: str, checkpoint: str, interval: str | None = None, compact: int = COMPACT) -> StreamingQuery:
    """Append a stream of account versions (deleted ones included) to the state, and refresh the pairs each batch touches.

    Every batch writes `batch=<id>` folders with overwrite and reads only those of earlier batches, so a batch that is
    run again after a failure gives the same result. Without an interval the query takes what there is and ends.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number and number % compact == 0:
            rewrite(spark, root, number - 1)
        _write(conform(batch, STATE), folder(root, STATE, number))
        new = _read(spark, STATE, [folder(root, STATE, number)])
        slot = new.agg(F.max("updated_slot")).first()[0]
        if slot is None:
            return
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most BUCKETS
        state = versions(spark, root, STATE, number + 1).where(F.col("bucket").isin(touched)).drop("bucket")
        out = balances.refreshed_balances(state, balances.affected_pairs(new.drop("bucket")), slot)
        _write(conform(out, BALANCE), folder(root, BALANCE, number))

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def folder(root: str, table: str, number: int, kind: str = "batch") -> str:
    return paths.join(root, table, f"{kind}={number}")


def _write(rows: DataFrame, path: str) -> None:
    rows.select("*", _bucket()).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _read(spark: SparkSession, table: str, at: list[str]) -> DataFrame:
    schema = T.StructType([*TABLES[table].fields, T.StructField("bucket", T.IntegerType())])
    if not at:
        return spark.createDataFrame([], schema)
    # partitions are found under each folder by itself
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in at])


def _listed(spark: SparkSession, root: str, table: str, kind: str) -> list[int]:
    names = [x for x in paths.children(spark, paths.join(root, table)) if x.startswith(f"{kind}=")]
    return sorted(int(x.split("=")[1]) for x in names if paths.complete(spark, paths.join(root, table, x)))


def versions(spark: SparkSession, root: str, table: str, before: int | None = None) -> DataFrame:
    """The rows of all batches, or of those numbered under `before`: the last base and the batches after it."""
    fits = lambda n: before is None or n < before
    bases = [n for n in _listed(spark, root, table, "base") if fits(n)]
    base = bases[-1] if bases else -1
    at = [folder(root, table, n) for n in _listed(spark, root, table, "batch") if n > base and fits(n)]
    return _read(spark, table, ([folder(root, table, base, "base")] if bases else []) + at)


def rewrite(spark: SparkSession, root: str, last: int) -> None:
    """Make one base of all batches up to `last`. It is complete before what it replaces goes."""
    for table, key in _KEPT.items():
        ties = [c for c in TABLES[table].names if c not in (*key, "updated_slot")]
        rows = final_latest(versions(spark, root, table, last + 1).drop("bucket"), key, "updated_slot", ties)
        _write(rows, folder(root, table, last, "base"))
        for kind, upto in (("batch", last), ("base", last - 1)):
            for n in _listed(spark, root, table, kind):
                if n <= upto:
                    paths.delete(spark, folder(root, table, n, kind))


def current_balances(spark: SparkSession, root: str) -> DataFrame:
    return balances.current_balances(versions(spark, root, BALANCE).drop("bucket"))
