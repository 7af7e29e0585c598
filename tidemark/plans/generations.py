"""Generations of tables: a new one is built aside and published by one atomic step; deltas are appended idempotently.

A generation is a folder with a subfolder for each table. Each load of a table goes to its own `batch=<id>` folder, so
that a repeated load overwrites itself. The pointer file names the generation that serves; replacing it publishes all
tables at once. The local parts (pointer, locks) need a file system with an atomic rename.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.balances import top_holders, wallet_assets
from tidemark.operators.reports import staging_check
from tidemark.operators.versioned import final_latest
from tidemark.plans.schemas import KEYS, ORDERS, TABLES
from tidemark.sources import paths
from tidemark.sources.lists import read_frozen, write_frozen

#: Fixed value: rows after which a file is ended.
FILE_ROWS = 1_000_000
#: Batches of a table after which the watch rewrites it to its current rows.
COMPACT_AFTER = 64


class NotReady(RuntimeError):
    pass


class Generation:
    """`complete`: it is or was published, so that a table which isn't there is an error and not an empty one."""

    def __init__(self, spark: SparkSession, root: str, name: str, complete: bool = False) -> None:
        self.spark, self.root, self.name, self.complete = spark, root, name, complete
        self.path = paths.join(root, f"gen={name}")

    def _folder(self, table: str, copy: int) -> str:
        return paths.join(self.path, table) if not copy else paths.join(self.path, f"sorted-{copy}", table)

    def write(self, table: str, rows: DataFrame, batch: str) -> None:
        """Each copy of the table is sorted in its own way, so that reads by the first columns of one skip files and row groups."""
        orders = ORDERS[table]
        if len(orders) > 1:  # one evaluation for all copies
            aside = paths.join(self.path, "_unsorted", f"{table}-{uuid.uuid4().hex}")
            rows.write.parquet(aside)
            rows = self.spark.read.schema(rows.schema).parquet(aside)
        for copy, order in enumerate(orders):
            placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
            placed.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(paths.join(self._folder(table, copy), f"batch={batch}"))
        if len(orders) > 1:
            paths.delete(self.spark, aside)

    def batches(self, table: str) -> list[str]:
        """Names of the batches that were written whole."""
        at = self._folder(table, len(ORDERS[table]) - 1)  # the last copy is written last
        return [x for x in paths.children(self.spark, at) if x.startswith("batch=") and paths.complete(self.spark, paths.join(at, x))]

    def versions(self, table: str, by: str | None = None, without: str | None = None) -> DataFrame:
        """All rows of a table, superseded ones included, read from the copy that is sorted by column `by`; an empty
        frame if there is none yet. `without`: a batch to leave out."""
        copy = next((k for k, order in enumerate(ORDERS[table]) if order[0] == by), 0)
        names = [x for x in self.batches(table) if x != f"batch={without}"]
        if not names:
            if self.complete and without is None:
                raise NotReady(f"{self.path} has no table {table}")
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(*[paths.join(self._folder(table, copy), x) for x in names])

    def current(self, table: str, by: str | None = None, where: Column | None = None) -> DataFrame:
        """The table as it serves: the latest version of each key, without deleted rows. `where`, on key columns alone,
        goes down to the scan."""
        deleted = "is_deleted" if "is_deleted" in TABLES[table].names else None
        ties = [c for c in TABLES[table].names if c not in (*KEYS[table], "updated_slot", "creators")]
        rows = self.versions(table, by)
        return final_latest(rows if where is None else rows.where(where), KEYS[table], "updated_slot", ties, deleted)

    def holders(self, mint: str, n: int) -> DataFrame:
        """The largest balances of a token."""
        rows = self.current("hot_wallet_token_balance", "mint", F.col("mint") == mint)
        return top_holders(rows, mint, n)

    def assets(self, owner: str) -> DataFrame:
        """A holder's balances."""
        return wallet_assets(self.current("hot_wallet_token_balance", "owner", F.col("owner") == owner), owner)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.versions(t) for t in TABLES}

    def freeze(self, mints: DataFrame) -> None:
        """Keep the list, unless one was kept whole before."""
        at = paths.join(self.path, "frozen")
        if not paths.complete(self.spark, at):
            paths.delete(self.spark, at)
            write_frozen(mints, at)

    def frozen(self) -> DataFrame:
        return read_frozen(self.spark, paths.join(self.path, "frozen"))

    def compact(self, table: str) -> None:
        """Rewrite a table to its current rows. The new batch is complete before the old ones go; tombstones stay until
        the next full load, as replays may still bring what they hide."""
        old = self.batches(table)
        ties = [c for c in TABLES[table].names if c not in (*KEYS[table], "updated_slot", "creators")]
        self.write(table, final_latest(self.versions(table), KEYS[table], "updated_slot", ties), f"compact-{uuid.uuid4().hex}")
        for batch in old:
            for copy in range(len(ORDERS[table])):
                paths.delete(self.spark, paths.join(self._folder(table, copy), batch))

    def compact_if_due(self, after: int = COMPACT_AFTER) -> list[str]:
        """The tables that had so many batches that they were rewritten."""
        due = [t for t in TABLES if len(self.batches(t)) >= after]
        for table in due:
            self.compact(table)
        return due

    def validate(self) -> None:
        """A display row for each frozen token, and at least one."""
        row = staging_check(self.current("hot_token_info"), self.frozen()).first()
        if not row["valid"]:
            raise NotReady(f"{row['info_rows']} display rows for {row['frozen_rows']} frozen tokens")


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.pointer = paths.join(root, "CURRENT")
        paths.make(spark, root)

    def new(self) -> Generation:
        return Generation(self.spark, self.root, uuid.uuid4().hex)

    def generation(self, name: str) -> Generation:
        return Generation(self.spark, self.root, name)

    def serving(self) -> Generation | None:
        name = self._pointed().get("generation")
        return Generation(self.spark, self.root, name, complete=True) if name else None

    def _pointed(self) -> dict:
        return json.loads(paths.read_text(self.spark, self.pointer)) if paths.exists(self.spark, self.pointer) else {}

    def sweep(self, keep: set[str]) -> list[str]:
        """Remove the generations that neither serve, nor did so last, nor are named in `keep`; their names."""
        pointed = self._pointed()
        keep = keep | {pointed.get("generation"), pointed.get("previous")}
        gone = [x for x in paths.children(self.spark, self.root) if x.startswith("gen=") and x[4:] not in keep]
        for name in gone:
            paths.delete(self.spark, paths.join(self.root, name))
        return [x[4:] for x in gone]

    def publish(self, new: Generation, expected: str | None) -> bool:
        """Make `new` serve if `expected` still does. Publishing what serves already is no error, so it can be repeated."""
        now = self.serving()
        if now and now.name == new.name:
            return False
        if (now.name if now else None) != expected:
            raise NotReady(f"{now and now.name} serves, not {expected}")
        new.validate()
        paths.replace_text(self.spark, self.pointer, json.dumps({"generation": new.name, "previous": expected}))
        return True

    def views(self, prefix: str = "") -> None:
        """Temporary views of the serving tables' current rows."""
        now = self.serving()
        if now is None:
            raise NotReady("nothing is published")
        for table in TABLES:
            now.current(table).createOrReplaceTempView(prefix + table)

    @contextmanager
    def single_writer(self, stale: float = 24 * 3600):
        """Only one process writes; another one fails at once. The lock is a file that creating it claims, on whatever
        file system; one that is older than `stale` seconds was left by a killed process. On a local file system the
        operating system's lock is used, which ends with its process."""
        if "://" not in self.root and not self.root.startswith("file:"):
            import fcntl

            with open(os.path.join(self.root, "LOCK"), "w") as f:
                try:
                    fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
                except BlockingIOError as e:
                    raise NotReady("another writer is at work") from e
                yield
            return
        at, fs = paths._at(self.spark, paths.join(self.root, "LOCK"))
        if fs.exists(at) and time.time() - fs.getFileStatus(at).getModificationTime() / 1000 > stale:
            fs.delete(at, False)
        if not fs.createNewFile(at):
            raise NotReady("another writer is at work")
        try:
            yield
        finally:
            fs.delete(at, False)
