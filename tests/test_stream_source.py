from tests import fixtures as fx
from tidemark.sources import archive, records
from tidemark.streaming.source import ArchiveStream, chain


def test_chain():
    found = [("f100", None, 100), ("f150", None, 150), ("i100-180", 100, 180), ("i150-200", 150, 200), ("i190-300", 190, 300), ("i400-500", 400, 500)]
    assert [(x[0], x[3]) for x in chain(found, -1)] == [("f150", -1), ("i150-200", 150), ("i190-300", 200)]
    assert [x[0] for x in chain(found, 100)] == ["i100-180", "i150-200", "i190-300"]
    assert [x[0] for x in chain(found, 100, 200)] == ["i100-180", "i150-200"]
    assert chain(found, 500) == [] and [x[0] for x in chain(found[:2], 120)] == ["f150"]


def test_stream_reads_each_archive_once(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    put = lambda name, slot, *files: archive.write_archive(str(folder / name), slot, [(s, i, records.pack([(fx.key(i), i, 0, fx.key("o"), False, bytes(32), b"")])) for s, i in files])
    spark.dataSource.register(ArchiveStream)

    def run():
        df = spark.readStream.format("ledger_archives").load(str(folder)).select("archive_slot", "kind", "slot", "lamports")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.archive_slot, r.kind, r.slot, int(r.lamports)) for r in spark.read.parquet(out).collect())

    put("snapshot-100-x.tar.zst", 100, (90, 1), (95, 2))
    assert run() == [(100, "full", 90, 1), (100, "full", 95, 2)]
    put("incremental-snapshot-100-200-x.tar.zst", 200, (90, 3), (150, 4))
    got = run()
    assert got[2:] == [(200, "incremental", 150, 4)]
    assert run() == got
