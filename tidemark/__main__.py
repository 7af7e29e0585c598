"""The command line: python -m tidemark COMMAND --store DIR ...

import SOURCE     load one checkpoint, an archive or an unpacked directory, as a new generation and publish it
watch DIRECTORY   keep the serving generation up to date with the archives of a folder
hot-list CSV      add the tokens of a CSV file to the allow-list
validate-schema   compare the serving tables with what is expected; the exit code is 1 if they differ
rebuild           balances and display rows of the serving generation anew from its state
close SOURCE      mark accounts that a checkpoint shows as closed, without loading it
opcodes SOURCE    instruction statistics of a folder (or `-`: a tar on standard input) of programs, as CSV
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import balances
from tidemark.operators.reports import table_gaps
from tidemark.operators.token_info import enabled, token_info
from tidemark.operators.versioned import final_latest
from tidemark.plans.generations import Generation, NotReady, Store
from tidemark.plans.ingest import full_load, read_stats, repaired_tombstones
from tidemark.plans.schemas import KEYS, ORDERS, TABLES, conform
from tidemark.sources import archive, lists, paths, programs
from tidemark.streaming.watch import Watch

log = logging.getLogger("tidemark")


def hot_path(store: Store) -> str:
    return paths.join(store.root, "hot_token")


def hot_tokens(store: Store) -> DataFrame:
    return lists.read_hot(store.spark, hot_path(store))


def serving(store: Store) -> Generation:
    if (now := store.serving()) is None:
        raise NotReady("nothing is published")
    return now


def load(store: Store, source: str) -> Generation:
    """A new generation of one checkpoint, published."""
    records, slot = archive.read_checkpoint(store.spark, source)
    before, new = store.serving(), store.new()
    new.freeze(enabled(hot_tokens(store)))
    at = paths.join(new.path, "_records")
    records.write.parquet(at)  # decoded once, read by every table
    records = store.spark.read.parquet(at)
    for table, rows in full_load(records, new.frozen(), slot, new.versions("raw_token_metadata").limit(0)).items():
        new.write(table, rows, f"full-{slot}")
    log.info("slot %s: %s", slot, read_stats(records))
    paths.delete(store.spark, at)
    store.publish(new, before.name if before else None)
    return new


def described(spark: SparkSession, tables: dict[str, list[tuple[str, str]]]) -> DataFrame:
    rows = [(t, c, kind) for t, columns in tables.items() for c, kind in columns]
    return spark.createDataFrame(rows, "table_name string, column_name string, kind string")


def gaps(store: Store) -> DataFrame:
    """What the serving generation's files lack of tables and columns, and whether keys and sort orders are columns they have."""
    now = serving(store)
    read = lambda t: store.spark.read.parquet(*[paths.join(now._folder(t, 0), b) for b in now.batches(t)]).schema.fields
    have = {t: [(f.name, f.dataType.simpleString()) for f in read(t)] for t in TABLES if now.batches(t)}
    want = {t: [(f.name, f.dataType.simpleString()) for f in TABLES[t].fields] for t in TABLES}
    for t in TABLES:
        names = {c for c, _ in have.get(t, [])}
        roles = [(c, f"key {k}") for k, c in enumerate(KEYS[t])] + [(c, f"sorted {k}") for k, c in enumerate(ORDERS[t][0])]
        want[t] += roles
        have[t] = have.get(t, []) + [x for x in roles if x[0] in names] if names else []
    return table_gaps(described(store.spark, have), described(store.spark, want))


def rebuild(store: Store) -> None:
    now = serving(store)
    slot = now.versions("hot_token_account_state").agg({"updated_slot": "max"}).first()[0] or 0
    batch = f"rebuild-{uuid.uuid4().hex}"
    old = {t: now.batches(t) for t in ("hot_wallet_token_balance", "hot_token_info")}
    full = conform(balances.full_balances(now.versions("hot_token_account_state")), "hot_wallet_token_balance")
    info = conform(token_info(now.frozen(), now.versions("raw_token_mint"), final_latest(now.versions("raw_token_metadata"), ["mint"], "updated_slot")), "hot_token_info")
    now.write("hot_wallet_token_balance", full, batch)
    now.write("hot_token_info", info, batch)
    for table, batches in old.items():
        for name in batches:
            for copy in range(len(ORDERS[table])):
                paths.delete(store.spark, paths.join(now._folder(table, copy), name))
    log.info("rebuilt up to slot %s", slot)


def close(store: Store, source: str) -> int:
    """How many accounts were marked; their pairs' balances are refreshed."""
    now = serving(store)
    records, slot = archive.read_checkpoint(store.spark, source)
    state = now.versions("hot_token_account_state")
    batch = f"close-{uuid.uuid4().hex}"
    at = paths.join(now.path, "_closed", batch)
    repaired_tombstones(records, state).write.parquet(at)
    gone = store.spark.read.schema(TABLES["hot_token_account_state"]).parquet(at)
    n = gone.count()
    if n:
        refreshed = balances.refreshed_balances(state.unionByName(gone), balances.affected_pairs(gone), slot)
        now.write("hot_wallet_token_balance", conform(refreshed, "hot_wallet_token_balance"), batch)
        now.write("hot_token_account_state", gone, batch)
    paths.delete(store.spark, at)
    return n


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--store", help="folder of the tables")
    parser.add_argument("--log-file")
    parser.add_argument("--log-level", default="INFO", choices=["ERROR", "WARNING", "INFO", "DEBUG"])
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("import", "close", "hot-list", "opcodes"):
        one = commands.add_parser(name)
        one.add_argument("source")
        if name == "opcodes":
            one.add_argument("out")
    commands.add_parser("validate-schema")
    commands.add_parser("rebuild")
    follow = commands.add_parser("watch")
    follow.add_argument("directory")
    follow.add_argument("--poll", type=float, default=5.0, help="seconds between looks at the folder")
    follow.add_argument("--rewind", type=int, default=1000, help="slots to go back when there are tables but no journal")
    follow.add_argument("--bootstrap", action="store_true", help="start anew from a full archive; what serves goes on serving until then")
    follow.add_argument("--once", action="store_true", help="end when nothing is to do")
    args = parser.parse_args(argv)
    logging.basicConfig(level=args.log_level, filename=args.log_file, format="%(asctime)s %(levelname)s %(message)s")
    spark = spark or SparkSession.builder.appName("tidemark").getOrCreate()
    if args.command == "opcodes":
        aside = f"{args.out.rstrip('/')}-{uuid.uuid4().hex}"
        rows = programs.read_program_tar(spark, sys.stdin.buffer, aside) if args.source == "-" else programs.read_programs(spark, args.source)
        programs.write_histogram(programs.histogram(programs.instruction_counts(rows)), args.out)
        paths.delete(spark, aside)
        return 0
    if not args.store:
        parser.error("--store is needed")
    store = Store(spark, args.store)
    if args.command == "validate-schema":
        found = gaps(store).collect()
        for r in found:
            log.error("%s.%s: %s, expected %s, found %s", r.table_name, r.column_name, r.problem, r.expected, r.actual)
        return int(bool(found))
    if args.command == "watch":
        watch = Watch(spark, store, args.directory, lambda: hot_tokens(store), args.rewind, args.bootstrap)
        watch.run() if args.once else watch.follow(args.poll)
        return 0
    with store.single_writer():
        if args.command == "import":
            load(store, args.source)
        elif args.command == "hot-list":
            lists.append_hot(lists.read_hot_csv(spark, args.source), hot_path(store))
        elif args.command == "rebuild":
            rebuild(store)
        else:
            log.info("%s accounts marked", close(store, os.fspath(args.source)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
