"""The command line end to end, the manifest, streams of records, and stores that are named by a URI."""

import io
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tests.test_ingest import closed, delta_records, full_records, pairs, put
from tidemark import __main__ as command
from tidemark.functions import base58
from tidemark.operators import balances
from tidemark.plans.generations import NotReady, Store
from tidemark.sources import archive, manifest, paths, records


def served(store):
    return pairs(balances.current_balances(store.serving().versions("hot_wallet_token_balance")))


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_import_repair_rebuild_and_watch(spark, tmp_path, scheme):
    root, folder = scheme + str(tmp_path / "store"), tmp_path / "in"
    folder.mkdir()
    csv = tmp_path / "hot.csv"
    csv.write_text("n,address\n" + "".join(f"{k},{fx.name(m)}\n" for k, m in enumerate(["m1", "m2", "m3"])))
    run = lambda *args: command.main(["--store", root, *args], spark)
    run("hot-list", str(csv))
    put(str(folder), None, 100, full_records(), 90)
    source = str(folder / "snapshot-100-h.tar.zst")
    run("import", source)
    store = Store(spark, root)
    assert served(store) == {("m1", "w1", 15), ("m2", "w1", 7)} and run("validate-schema") == 0
    first = store.serving()
    assert [int(r.amount_raw) for r in first.holders(fx.name("m1"), 5).collect()] == [15]
    assert sorted(int(r.amount_raw) for r in first.assets(fx.name("w1")).collect()) == [7, 15]
    late = str(tmp_path / "x.tar.zst")
    archive.write_archive(late, 120, [(110, 1, records.pack([closed("a4"), closed("unknown")]))])
    run("close", late)
    assert served(store) == {("m1", "w1", 15)}
    run("rebuild")
    assert served(store) == {("m1", "w1", 15)}
    put(str(folder), 100, 200, delta_records(), 150)
    run("watch", "--once", str(folder))
    assert served(store) == {("m1", "w1", 4)}
    run("import", source)
    assert store.serving().name != first.name and served(store) == {("m1", "w1", 15), ("m2", "w1", 7)}
    paths.delete(spark, paths.join(store.serving().path, "hot_token_info"))
    assert run("validate-schema") == 1
    with pytest.raises(NotReady):
        store.serving().versions("hot_token_info")


def test_one_pass_over_the_archive(spark, tmp_path, monkeypatch):
    """A delta's tables read the decoded records, not the archive."""
    from tidemark.streaming import watch as W

    folder = str(tmp_path / "in")
    os.makedirs(folder)
    put(folder, None, 100, full_records(), 90)
    hot = lambda: spark.createDataFrame([(fx.name(m), 1, 1) for m in ("m1", "m2")], "mint string, enable int, version long")
    W.Watch(spark, Store(spark, str(tmp_path / "s")), folder, hot).run()
    put(folder, 100, 200, delta_records(), 150)
    plans = []
    inner = W.incremental_load

    def spied(*args):
        out = inner(*args)
        plans.extend(df._jdf.queryExecution().toString() for df in out.values())
        return out

    monkeypatch.setattr(W, "incremental_load", spied)
    watch = W.Watch(spark, Store(spark, str(tmp_path / "s")), folder, hot)
    assert watch.run() == ["incremental active 200"]
    assert len(plans) == 5 and not any("ledger_archive" in p or "Python Data Source" in p for p in plans)
    assert watch.remove_processed() == [os.path.join(folder, x) for x in ("incremental-snapshot-100-200-h.tar.zst", "snapshot-100-h.tar.zst")]
    looks = iter([False, False, True])
    watch.follow(0.01, lambda: next(looks))


def test_a_recorded_full_archive_that_is_gone_is_an_error(spark, tmp_path):
    from tidemark.streaming.watch import Watch

    folder = str(tmp_path / "in")
    os.makedirs(folder)
    watch = Watch(spark, Store(spark, str(tmp_path / "s")), folder, lambda: None)
    watch.journal.shared_full = {"path": os.path.join(folder, "snapshot-1-h.tar.zst"), "slot": 1, "generation": "g", "active_slot": None}
    with pytest.raises(NotReady, match="is not there"):
        watch.run()


def test_half_written_frozen_list_is_written_anew(spark, tmp_path):
    new = Store(spark, str(tmp_path / "s")).new()
    at = os.path.join(new.path, "frozen")
    os.makedirs(at)
    with open(os.path.join(at, "part-0.txt"), "w") as f:
        f.write("half\n")
    new.freeze(spark.createDataFrame([("a",), ("b",)], "mint string"))
    new.freeze(spark.createDataFrame([("other",)], "mint string"))
    assert sorted(r.mint for r in new.frozen().collect()) == ["a", "b"]


def bank() -> bytes:
    """A manifest's bank with something in every list, written apart from the module's own."""
    u = lambda *n: struct.pack(f"<{len(n)}Q", *n)
    k = lambda c: bytes([c]) * 32
    schedule = u(1, 2) + b"\1" + u(3, 4)
    stakes = u(1) + k(1) + u(5) + u(6, 3) + b"abc" + k(2) + b"\0" + u(7) + u(2) + (k(3) + k(4) + u(1, 2, 3, 4)) * 2 + u(0, 9) + u(1) + u(1, 2, 3, 4)
    out = u(7) + b"\1" + k(9) + u(2) + (k(5) + u(1, 2, 3)) * 2 + u(300)
    out += u(1) + u(8, 9) + k(6) + k(7) + u(41) + u(1) + u(5, 6) + u(1, 2, 3, 4, 5) + b"\1" + u(12) + u(64) + bytes(16) + u(1, 2, 3)
    out += u(42) + u(1, 2) + k(8) + u(3) + u(5000) + u(1, 2, 3, 4) + b"\x32" + u(6) + u(1) + schedule + u(2) + u(3, 4) + b"\x32" + schedule + u(1, 2, 3, 4, 5, 6)
    out += stakes + u(1) + k(1) + u(0) + u(1) + k(2) + u(9)
    out += u(1) + u(77) + stakes + u(88) + u(1) + k(1) + u(2) + k(2) + k(3) + u(9) + u(1) + k(4) + k(5)
    return out + b"\1"


def test_manifest():
    files = struct.pack("<QQQQQQQQQ", 2, 5, 2, 1, 136, 2, 272, 9, 0)
    assert manifest.read(io.BytesIO(bank() + files + b"what follows")) == (42, {(5, 1): 136, (5, 2): 272})
    assert manifest.read(io.BytesIO(manifest.body(7, [(1, 2, 3), (1, 4, 5), (6, 7, 8)]))) == (7, {(1, 2): 3, (1, 4): 5, (6, 7): 8})
    with pytest.raises(EOFError):
        manifest.read(io.BytesIO(bank()[:-40]))


def test_listed_lengths_end_the_files_of_an_archive(spark, tmp_path):
    entry = lambda k, n: (fx.key(k), k, 0, fx.key("o"), False, bytes(32), b"d" * n)
    content = records.pack([entry(1, 3), entry(2, 5)])
    path = str(tmp_path / "snapshot-10-x.tar.zst")
    archive.write_archive(path, 10, [(5, 1, content + bytes(272))], manifest.body(10, [(5, 1, len(content))]))
    assert archive.read_checkpoint(spark, path)[0].count() == 2
    archive.write_archive(path, 10, [(5, 1, content)], manifest.body(10, [(5, 2, len(content))]))
    with pytest.raises(Exception, match="not in the manifest"):
        archive.read_checkpoint(spark, path)[0].collect()


@pytest.mark.parametrize("chunk", [1, 50, 137, 1 << 20])
def test_a_stream_gives_the_records_of_its_bytes(chunk):
    rng = random.Random(chunk)
    blob = records.pack([(fx.key(k), k, 0, fx.key("o"), False, bytes(32), bytes(rng.randrange(400))) for k in range(30)])
    for end in (len(blob), len(blob) - 8, 300):
        assert list(records.walk_stream(io.BytesIO(blob).read, end, chunk)) == list(records.walk(blob, end))
    with pytest.raises(EOFError):
        list(records.walk_stream(io.BytesIO(blob).read, len(blob) + 8, chunk))


def test_base58_of_many_keys(spark):
    rng = random.Random(3)
    keys = [rng.randbytes(32) for _ in range(300)] + [bytes(32), bytes(31) + b"\1", bytes(7) + rng.randbytes(25), b"\xff" * 32, None, b"", b"ab", b"\0\0x"]
    got = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k binary, n int").select(base58.base58("k").alias("t"), "n").collect()
    assert [r.t for r in sorted(got, key=lambda r: r.n)] == [None if k is None else base58.encode(k) for k in keys]


def test_align_is_exact_beyond_doubles(spark):
    from tidemark.functions import scalar

    values = [0, 1, 8, 9, 2**53 + 1, 2**62 + 3]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", scalar.align8(F.col("v")).alias("a")).collect()
    assert {r.v: r.a for r in got} == {v: -(-v // 8) * 8 for v in values}
