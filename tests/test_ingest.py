"""Full load, increments, tombstones, generations and the watch, on checkpoints built byte by byte."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.operators import balances
from tidemark.plans import ingest
from tidemark.plans.generations import NotReady, Store
from tidemark.plans.schemas import TABLES, SchemaMismatch, assert_schema, conform
from tidemark.sources import archive, records
from tidemark.streaming import stream
from tidemark.streaming.watch import Journal, Lane, Watch

HOT = ["m1", "m2", "m3"]


def rec(tag, data, owner=ingest.TOKEN, lamports=1, executable=False):
    return fx.key(tag), lamports, 0, owner, executable, bytes(32), data


def closed(tag):
    return rec(tag, b"", ingest.DEFAULT_OWNER, 0)


def full_records():
    ext = fx.extended_mint(fx.mint(500, 2), (9, b""), (19, fx.metadata_value("au", "m2", "Two", "T", "u2")))
    return [
        rec("a1", fx.account("m1", "w1", 10)),
        rec("a2", fx.account("m1", "w1", 5)),
        rec("a3", fx.account("m1", "w2", 0)),
        rec("a4", fx.account("m2", "w1", 7) + b"\x02", ingest.TOKEN_EXT),
        rec("a5", fx.account("cold", "w1", 9)),
        rec("m1", fx.mint(1000, 6, "auth")),
        rec("m2", ext, ingest.TOKEN_EXT),
        rec("meta1", fx.program_metadata("up", "m1", "One", "O", "u1", 50, ["c"], True, b"\0\1\x02\0\0"), ingest.METADATA),
        rec("p", b"\1", fx.key("other"), 3, True),
    ]


def delta_records():
    return [rec("a1", fx.account("m1", "w1", 4)), closed("a4"), closed("unknown"), rec("a6", fx.account("m1", "w3", 0)), rec("a2", bytes(165), lamports=0)]


def df_of(spark, path_tmp, slot, files):
    path = str(path_tmp / f"x{slot}.tar.zst")
    archive.write_archive(path, slot, files)
    return archive.read_checkpoint(spark, path)[0]


def hot(spark):
    return spark.createDataFrame([(fx.name(h),) for h in HOT], "mint string")


def pairs(df):
    label = {fx.name(x): x for x in (*HOT, "w1", "w2", "w3")}
    return {(label[r.mint], label[r.owner], int(r.amount_raw)) for r in df.collect()}


def test_full_then_incremental(spark, tmp_path):
    full = df_of(spark, tmp_path, 100, [(90, 1, records.pack(full_records()))])
    tables = ingest.full_load(full, hot(spark), 100, spark.createDataFrame([], TABLES["raw_token_metadata"]))
    for name, df in tables.items():
        assert_schema(df, name)
    assert tables["raw_account"].count() == 9
    assert pairs(tables["hot_wallet_token_balance"]) == {("m1", "w1", 15), ("m2", "w1", 7)}
    assert {r.updated_slot for r in tables["hot_token_account_state"].collect()} == {90}
    meta = {r.mint: r for r in tables["raw_token_metadata"].collect()}
    one, two = meta[fx.name("m1")], meta[fx.name("m2")]
    assert (one["name"], one.token_standard, one.seller_fee_basis_points, one.creators, one.extensions) == ("One", 2, 50, [fx.name("c")], "[]")
    assert (two["name"], two.update_authority, two.is_mutable) == ("Two", fx.name("au"), True)
    assert [x["extension"] for x in json.loads(two.extensions)] == ["nonTransferable", "tokenMetadata"]
    info = {r.mint: r for r in tables["hot_token_info"].collect()}
    assert len(info) == 3 and (info[fx.name("m1")].decimals, info[fx.name("m1")].symbol, info[fx.name("m3")].decimals, info[fx.name("m3")]["name"]) == (6, "O", 0, "")

    delta = df_of(spark, tmp_path, 200, [(150, 1, records.pack(delta_records()))])
    new = ingest.incremental_load(delta, hot(spark), 200, tables)
    state = {(r.pubkey, r.updated_slot): r for r in new["hot_token_account_state"].collect()}
    assert state[fx.name("a4"), 150].is_deleted == 1 and state[fx.name("a4"), 150].mint == fx.name("m2")
    assert state[fx.name("a2"), 150].is_deleted == 1 and state[fx.name("a6"), 150].amount == 0
    assert (fx.name("unknown"), 150) not in state
    assert pairs(new["hot_wallet_token_balance"]) == {("m1", "w1", 4), ("m2", "w1", 0), ("m1", "w3", 0)}
    served = balances.current_balances(tables["hot_wallet_token_balance"].unionByName(new["hot_wallet_token_balance"]))
    assert pairs(served) == {("m1", "w1", 4)}
    # no account changed its pair, so the refresh equals a full rebuild of the same state
    rebuilt = balances.full_balances(tables["hot_token_account_state"].unionByName(new["hot_token_account_state"]))
    assert pairs(rebuilt) == pairs(served)


def test_late_close_is_no_tombstone(spark, tmp_path):
    tables = ingest.full_load(df_of(spark, tmp_path, 100, [(90, 1, records.pack(full_records()))]), hot(spark), 100, spark.createDataFrame([], TABLES["raw_token_metadata"]))
    late = df_of(spark, tmp_path, 201, [(90, 1, records.pack([closed("a1")]))])
    assert ingest.incremental_load(late, hot(spark), 201, tables)["hot_token_account_state"].count() == 0


def test_stats(spark, tmp_path):
    got = ingest.ingest(df_of(spark, tmp_path, 100, [(90, 1, records.pack([*full_records(), closed("z"), rec("odd", b"123")]))]), hot(spark), 100, "full")
    s = got.stats.first().asDict()
    assert (s["accounts"], s["token_accounts"], s["token_ext_accounts"], s["mints"], s["metadata_accounts"], s["unexpected_size"], s["zero_balance"], s["canonical_empty"]) == (11, 4, 1, 2, 1, 1, 1, 1)


def test_metadata_ties_do_not_depend_on_order(spark):
    from tidemark.operators import metadata

    schema = "mint string, slot long, source_rank int, source_account string, name string"
    rows = [("m", 20, 0, "z", "program"), ("m", 20, 2, "a", "embedded"), ("m", 19, 2, "b", "old")]
    for order in (rows, rows[::-1]):
        assert metadata.winning_fields(spark.createDataFrame(order, schema), fields=["name"]).first()["name"] == "embedded"


def test_schema_gate(spark):
    with pytest.raises(SchemaMismatch):
        conform(spark.createDataFrame([("a",)], "mint string"), "hot_token_info")
    old = spark.createDataFrame([], TABLES["raw_token_metadata"]).drop("extensions")
    assert conform(old, "raw_token_metadata").columns == TABLES["raw_token_metadata"].names
    with pytest.raises(SchemaMismatch):
        assert_schema(spark.createDataFrame([("a", 1)], "mint string, enable int"), "hot_token_info")


def tokens(spark):
    return lambda: spark.createDataFrame([(fx.name(h), 1, 1) for h in HOT] + [(fx.name("m3"), 0, 2), ("gone", 0, 1)], "mint string, enable int, version long")


def put(directory, base, slot, rows, storage_slot):
    name = f"snapshot-{slot}-h.tar.zst" if base is None else f"incremental-snapshot-{base}-{slot}-h.tar.zst"
    archive.write_archive(os.path.join(directory, name), slot, [(storage_slot, 1, records.pack(rows))])


def test_watch_from_nothing_to_a_second_generation(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    store = Store(spark, str(tmp_path / "store"))
    watch = Watch(spark, store, folder, tokens(spark))
    assert watch.run() == [] and store.serving() is None
    put(folder, None, 100, full_records(), 90)
    done = watch.run()
    assert done[0] == "full 100" and done[1].startswith("publish") and len(done) == 2
    first = store.serving()
    assert first.frozen().count() == 2 and first.current("hot_token_info").count() == 2
    put(folder, 100, 200, delta_records(), 150)
    watch = Watch(spark, store, folder, tokens(spark))  # as after a restart
    assert watch.run() == ["incremental active 200"]
    assert pairs(balances.current_balances(first.versions("hot_wallet_token_balance"))) == {("m1", "w1", 4)}
    assert watch.run() == []
    # the same increment again changes nothing
    watch.journal.active.max_slot = 100
    assert watch.run() == ["incremental active 200"]
    assert pairs(balances.current_balances(first.versions("hot_wallet_token_balance"))) == {("m1", "w1", 4)}

    put(folder, None, 300, [rec("a1", fx.account("m1", "w1", 40)), rec("m1", fx.mint(1, 6))], 250)
    put(folder, 300, 400, [rec("a9", fx.account("m1", "w2", 1))], 350)
    done = watch.run()
    assert done[:2] == ["full 300", "incremental staging 400"] and done[2].startswith("publish")
    second = store.serving()
    assert second.name != first.name and watch.journal.active == Lane("ready", watch.journal.active.full_path, 300, 400, second.name)
    assert pairs(balances.current_balances(second.versions("hot_wallet_token_balance"))) == {("m1", "w1", 40), ("m1", "w2", 1)}
    # meanwhile the old generation took what it hadn't seen
    assert ("m1", "w1", 40) in pairs(balances.current_balances(first.versions("hot_wallet_token_balance")))
    store.views("now_")
    assert spark.table("now_hot_token_info").count() == 2
    before = {tuple(r) for r in second.current("hot_token_account_state").collect()}
    second.compact("hot_token_account_state")
    assert {tuple(r) for r in second.current("hot_token_account_state").collect()} == before


def test_killed_in_a_full_load(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    put(folder, None, 100, full_records(), 90)
    store = Store(spark, str(tmp_path / "store"))
    watch = Watch(spark, store, folder, tokens(spark))
    monkeypatch.setattr("tidemark.streaming.watch.full_load", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        watch.run()
    monkeypatch.undo()
    again = Watch(spark, store, folder, tokens(spark))
    assert again.journal.shared_full["slot"] == 100 and again.journal.staging.phase == "full_loading"
    assert again.run()[0] == "full 100" and store.serving().name == again.journal.active.generation


def test_publish_needs_the_expected_generation_and_complete_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    new = store.new()
    new.freeze(hot(spark))
    with pytest.raises(NotReady):
        store.publish(new, None)
    with pytest.raises(NotReady):
        store.publish(new, "another")
    with store.single_writer(), pytest.raises(NotReady), store.single_writer():
        pass


@pytest.mark.parametrize("raw,phase,slot", [({"version": 2, "max_slot": 7}, "ready", 7), ({"max_slot": None}, "waiting_for_full", None), ({"version": 3, "active": {"phase": "ready", "max_slot": 9, "junk": 1}, "staging": {}}, "ready", 9), ({"version": 4, "active": {"phase": "full_merging"}, "cutover": None}, "full_merging", None), ({"version": 5}, "disabled", None)])
def test_journal_forms(spark, tmp_path, raw, phase, slot):
    path = str(tmp_path / "journal.json")
    with open(path, "w") as f:
        json.dump(raw, f)
    j = Journal.load(spark, path)
    assert (j.version, j.active.phase, j.active.max_slot) == (5, phase, slot)
    j.save(spark, path)
    assert Journal.load(spark, path) == j
    with pytest.raises(ValueError):
        Journal.migrated({"version": 6})
    with pytest.raises(ValueError):
        Journal.migrated({"version": 5, "active": {"phase": "unheard_of"}})


def test_stream_of_versions(spark, tmp_path):
    root, source = str(tmp_path / "root"), str(tmp_path / "source")
    rows = lambda *x: conform(spark.createDataFrame(list(x), "pubkey string, mint string, owner string, amount int, is_deleted int, updated_slot long").withColumns({"delegate": F.lit(None), "delegated_amount": F.lit(0), "state": F.lit(1), "close_authority": F.lit(None)}), "hot_token_account_state")
    read = lambda: spark.readStream.schema(TABLES["hot_token_account_state"]).parquet(source)
    run = lambda: stream.refresh_balances(read(), root, str(tmp_path / "checkpoint")).awaitTermination()
    rows(("k1", "m", "o", 5, 0, 1), ("k2", "m", "o", 7, 0, 1), ("k3", "m", "p", 1, 0, 1)).write.parquet(source)
    run()
    assert {(r.owner, int(r.amount_raw)) for r in stream.current_balances(spark, root).collect()} == {("o", 12), ("p", 1)}
    rows(("k1", "m", "o", 2, 0, 3), ("k3", "m", "p", 0, 1, 3)).write.mode("append").parquet(source)
    run()
    assert {(r.owner, int(r.amount_raw)) for r in stream.current_balances(spark, root).collect()} == {("o", 9)}
