import io
import os
import struct
import tarfile

import pytest

from tests import fixtures as fx
from tidemark.sources import archive, discovery, lists, programs, records


def entry(k, data=b"", lamports=None, owner="o", executable=False):
    return fx.key(f"k{k}"), k if lamports is None else lamports, 0, fx.key(owner), executable, fx.key(f"h{k}"), data


def test_records_round_trip_and_stop_at_what_does_not_fit():
    rows = [entry(k, bytes([k]) * (k * 3 % 17)) for k in range(9)]
    blob = records.pack(rows)
    got = list(records.walk(blob))
    assert [(g[1], g[2], *g[4:]) for g in got] == [(r[0], r[1], *r[3:]) for r in rows]
    assert all(g[0] % 8 == 0 for g in got)
    assert len(list(records.walk(blob, len(blob) - 8))) == 8 and list(records.walk(b"12345")) == []
    assert [len(b) for b in records.batches(1, 1, blob)] == [9]


@pytest.mark.parametrize("size,valid,error", [(5, 8, EOFError), (0, 0, ValueError), (1 << 40, 17 << 30, ValueError)])
def test_sizes(size, valid, error):
    with pytest.raises(error):
        records.check_size(size, valid)


def test_archive(spark, tmp_path):
    files = [(5, 1, records.pack([entry(1), entry(2, b"data")])), (9, 4, records.pack([entry(3)]))]
    path = str(tmp_path / "snapshot-10-x.tar.zst")
    archive.write_archive(path, 10, files)
    df, slot = archive.read_checkpoint(spark, path)
    assert slot == 10 and sorted((r.slot, r.file_id, int(r.lamports), bytes(r.data)) for r in df.collect()) == [(5, 1, 1, b""), (5, 1, 2, b"data"), (9, 4, 3, b"")]
    later, _ = archive.read_checkpoint(spark, path, min_slot=5)
    assert [r.slot for r in later.collect()] == [9]
    assert archive.file_count(path) is None


def test_archive_without_manifest(tmp_path):
    def tar(*names):
        path = str(tmp_path / f"{len(names)}{names[0][:3]}.tar")
        with tarfile.open(path, "w") as t:
            for n in names:
                t.addfile(tarfile.TarInfo(n), io.BytesIO(b""))
        return path

    with pytest.raises(archive.UnexpectedStorage):
        archive.archive_slot(tar("accounts/1.2", "snapshots/3/3"))
    with pytest.raises(archive.NoManifest):
        archive.archive_slot(tar("version"))
    assert archive.manifest_slot("snapshots/7/8") is None and archive.manifest_slot("./snapshots/7/7") == 7


def test_directory(spark, tmp_path):
    for d in ("snapshots/7", "snapshots/12", "snapshots/x", "accounts"):
        os.makedirs(tmp_path / d)
    with pytest.raises(archive.NoManifest):
        archive.directory_slot(str(tmp_path))
    (tmp_path / "snapshots/status_cache").write_bytes(b"")
    for n, k in (("5.1", 1), ("9.4", 2), ("notes", 3)):
        (tmp_path / "accounts" / n).write_bytes(records.pack([entry(k)]) + bytes(200))
    df, slot = archive.read_checkpoint(spark, str(tmp_path), min_slot=5, manifest=spark.createDataFrame([(9, 4, 136), (5, 1, 136)], "slot long, file_id long, valid_len long"))
    assert slot == 12 and [(r.slot, int(r.lamports)) for r in df.collect()] == [(9, 2)] and archive.file_count(str(tmp_path)) == 2
    lacking = spark.createDataFrame([(5, 1, 136)], "slot long, file_id long, valid_len long")
    with pytest.raises(Exception, match="not in the manifest"):
        archive.read_checkpoint(spark, str(tmp_path), manifest=lacking)[0].collect()
    whole = archive.with_valid_length(archive.storage_files(spark, str(tmp_path)), lacking.limit(0))
    assert [r.valid_len for r in whole.collect()] == [None, None]


def names(spark, *paths):
    return discovery.catalogue(spark.createDataFrame([(p,) for p in paths], "path string"))


def test_choice_of_archives(spark):
    got = names(spark, "/a/snapshot-1000-AbC.tar.zst", "/a/snapshot-1500-Abc.tar.zst", "/b/snapshot-1500-Abc.tar.zst", "/a/snapshot-1-0OIl.tar.zst", "incremental-snapshot-950-1550-x.tar.zst", "incremental-snapshot-950-2000-x.tar.zst", "incremental-snapshot-900-1500-x.tar.zst", "incremental-snapshot-1100-2500-x.tar.zst", "incremental-snapshot-1100-2500-x.tar.gz", "x")
    assert got.count() == 7
    assert [(r.base_slot, r.slot) for r in discovery.eligible_incrementals(got, 1000).collect()] == [(950, 2000), (950, 1550), (900, 1500)]
    assert [(r.slot, r.path[1]) for r in discovery.eligible_fulls(got, 1000).collect()] == [(1500, "a"), (1500, "b")]
    assert discovery.newest_full(got, 1000).first().path[1] == "a" and discovery.newest_full(got, 1500).count() == 0
    assert [r.slot for r in discovery.candidates(got, 1000).collect()] == [2000, 1550, 1500, 1500, 1500]
    assert discovery.processed(got, 1500).count() == 4


def test_discover_reads_a_folder(spark, tmp_path):
    (tmp_path / "snapshot-5-x.tar.zst").write_bytes(b"")
    (tmp_path / "other").write_bytes(b"")
    assert [(r.kind, r.slot) for r in discovery.discover(spark, str(tmp_path)).collect()] == [("full", 5)]


def test_token_lists(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("n,address\n1, abc \n2,def\n")
    bad.write_text("n,address\n1,abc\n2,\n")
    assert [tuple(r) for r in lists.read_hot_csv(spark, str(good)).collect()] == [("abc", 1, 1), ("def", 1, 1)]
    with pytest.raises(Exception, match="empty mint"):
        lists.read_hot_csv(spark, str(bad)).collect()
    frozen = str(tmp_path / "frozen")
    lists.write_frozen(lists.read_hot_csv(spark, str(good)), frozen)
    assert sorted(r.mint for r in lists.read_frozen(spark, frozen).collect()) == ["abc", "def"]
    (tmp_path / "none.txt").write_text("")
    with pytest.raises(ValueError):
        lists.read_frozen(spark, str(tmp_path / "none.txt"))
    (tmp_path / "hot-1.txt").write_text("x")
    (tmp_path / "hot-2.txt").write_text("x")
    assert lists.unreferenced(str(tmp_path), "hot-", {str(tmp_path / "hot-2.txt")}) == [str(tmp_path / "hot-1.txt")]


def elf(text: bytes) -> bytes:
    names = b"\0.text\0.names\0"
    head = bytearray(64)
    head[:6] = b"\x7fELF\x02\x01"
    struct.pack_into("<Q", head, 0x28, 64 + len(text) + len(names))
    struct.pack_into("<HHH", head, 0x3A, 64, 3, 2)
    section = lambda at, offset, size: struct.pack("<IIQQQQ", at, 0, 0, 0, offset, size) + bytes(24)
    return bytes(head) + text + names + section(0, 0, 0) + section(1, 64, len(text)) + section(7, 64 + len(text), len(names))


def test_instruction_histogram(spark, tmp_path):
    wide = bytes([0x18]) + bytes(15)
    one = elf(wide + bytes([0x95]) + bytes(7) + bytes([0x07]) + bytes(7))
    two = elf(bytes([0x95]) + bytes(7) + bytes([0xFF]) + bytes(7) + b"cut")
    (tmp_path / "p").mkdir()
    for n, b in (("a.so", one), ("b.so", two)):
        (tmp_path / "p" / n).write_bytes(b)
    rows = programs.histogram(programs.instruction_counts(programs.read_programs(spark, str(tmp_path / "p"))))
    assert [tuple(r) for r in rows.collect()] == [("0x07", "ADD64_IMM", 1, 1), ("0x18", "LD_DW_IMM", 1, 1), ("0x95", "EXIT", 2, 2), ("0xff", "invalid", 1, 1)]
    programs.write_histogram(rows, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["opcode", "mnemonic", "num_programs", "num_insns"]
    stream = io.BytesIO()
    with tarfile.open(fileobj=stream, mode="w") as t:
        info = tarfile.TarInfo("a.so")
        info.size = len(one)
        t.addfile(info, io.BytesIO(one))
    stream.seek(0)
    assert programs.read_program_tar(spark, stream, str(tmp_path / "aside")).count() == 1
    with pytest.raises(ValueError):
        programs.text_section(b"no elf")


def test_mnemonics_by_known_opcodes():
    m = programs.mnemonics()
    known = {0x07: "ADD64_IMM", 0x0F: "ADD64_REG", 0x61: "LD_W_REG", 0x7B: "ST_DW_REG", 0x15: "JEQ_IMM", 0xB7: "MOV64_IMM", 0xBC: "MOV32_REG", 0x30: "LD_ABS_B", 0xC7: "ARSH64_IMM", 0xE4: "SDIV32_IMM", 0x85: "CALL_IMM", 0xDD: "JSLE_REG"}
    assert {k: m[k] for k in known} == known and len(m) == 105 and len(set(m.values())) == 105
