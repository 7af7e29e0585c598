"""Checkpoints as Spark sources: compressed archives (one stream, so one task) and unpacked directories (splittable).

`spark.read.format("ledger_archive").load(path)` reads a .tar.zst (or .tar) archive: the manifest must come before the
storage files; its path `snapshots/<slot>/<slot>` gives the checkpoint's slot. Storage files at or under the option
`min_slot` are passed over without being decoded. Storage files are decoded as they stream by, in batches, because one
may be larger than memory. Their valid lengths are those that the manifest lists; without a list they count whole.
Repartition before heavy work: the archive itself can't be split.
"""

from __future__ import annotations

import io
import os
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.scalar import storage_name
from tidemark.sources import manifest as manifest_body
from tidemark.sources import records

_STORAGE = re.compile(r"(?:^|/)accounts/(\d+)\.(\d+)$")
_MANIFEST = re.compile(r"(?:^|/)snapshots/(\d+)/(\d+)$")
_NAME = re.compile(r"^(\d+)\.(\d+)$")


class NoManifest(ValueError):
    pass


class UnexpectedStorage(ValueError):
    pass


def open_stream(path: str) -> io.BufferedIOBase:
    """A byte stream of a local path or any URI that Arrow's file systems know; .zst is decompressed."""
    raw = records.open_bytes(path)
    if path.split("?")[0].endswith(".zst"):
        import zstandard

        return zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(raw, closefd=True)
    return raw


def manifest_slot(name: str) -> int | None:
    """The slot that a manifest's path names twice; None for other paths."""
    m = _MANIFEST.search(name)
    return int(m[1]) if m and m[1] == m[2] else None


def entries(path: str, min_slot: int | None = None) -> Iterator[tuple[int, int, int, Iterator[tuple]]]:
    """(checkpoint slot, slot, file id, records) of each storage file, in the archive's order; the records must be read
    before the next file is asked for."""
    found: int | None = None
    listed: dict[tuple[int, int], int] = {}
    with open_stream(path) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
        for member in tar:
            if found is None and (slot := manifest_slot(member.name)) is not None:
                found, listed = slot, manifest_body.valid_lengths(tar.extractfile(member)) if member.size else {}
                continue
            m = _STORAGE.search(member.name)
            if not m or not member.isfile():
                continue
            if found is None:
                raise UnexpectedStorage(f"{member.name} comes before the manifest")
            if min_slot is not None and int(m[1]) <= min_slot:
                continue
            valid = listed.get((int(m[1]), int(m[2]))) if listed else member.size
            if valid is None:
                raise UnexpectedStorage(f"storage file {m[1]}.{m[2]} is not in the manifest")
            records.check_size(member.size, valid)
            yield found, int(m[1]), int(m[2]), records.walk_stream(tar.extractfile(member).read, valid)
    if found is None:
        raise NoManifest(path)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.min_slot = int(options["min_slot"]) if "min_slot" in options else None

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for _, slot, file_id, found in entries(self.path, self.min_slot):
            yield from records.stacked(slot, file_id, found)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledger_archive"

    def schema(self):
        return records.RECORD_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def archive_slot(path: str) -> int:
    """The checkpoint's slot, from the head of the archive."""
    with open_stream(path) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
        for member in tar:
            if (slot := manifest_slot(member.name)) is not None:
                return slot
            if _STORAGE.search(member.name):
                raise UnexpectedStorage(f"{member.name} comes before the manifest")
    raise NoManifest(path)


def directory_slot(path: str) -> int:
    """The greatest numeric directory under snapshots/; its status cache must be there."""
    at = os.path.join(path, "snapshots")
    if not os.path.exists(os.path.join(at, "status_cache")):
        raise NoManifest(f"{at} has no status cache")
    slots = [int(x) for x in os.listdir(at) if x.isdigit() and os.path.isdir(os.path.join(at, x))]
    if not slots:
        raise NoManifest(path)
    return max(slots)


def storage_files(spark: SparkSession, path: str, min_slot: int | None = None) -> DataFrame:
    """(slot, file_id, path, length) of an unpacked directory's storage files; names of another form are passed over."""
    files = spark.read.format("binaryFile").load(os.path.join(path, "accounts"))  # the content column is never read
    name = F.element_at(F.split("path", "/"), -1)
    out = files.select(storage_name(name, 1).alias("slot"), storage_name(name, 2).alias("file_id"), "path", "length").where("slot IS NOT NULL AND file_id IS NOT NULL")
    return out if min_slot is None else out.where(F.col("slot") > min_slot)


def with_valid_length(files: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Adds valid_len from (slot, file_id, valid_len) rows: an empty list leaves it null (the whole file counts); a file
    that a non-empty list lacks is an error."""
    if manifest is None or not manifest.take(1):
        return files.withColumn("valid_len", F.lit(None).cast("long"))
    listed = manifest.select("slot", "file_id", F.col("valid_len").cast("long"))
    out = files.join(listed, ["slot", "file_id"], "left")
    missing = F.raise_error(F.format_string("storage file %d.%d is not in the manifest", "slot", "file_id")).cast("long")
    return out.withColumn("valid_len", F.coalesce("valid_len", missing))


def read_checkpoint(spark: SparkSession, path: str, min_slot: int | None = None, manifest: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The records of an archive or directory, and its slot."""
    if os.path.isdir(path):
        slot = directory_slot(path)
        if manifest is None:
            manifest = directory_manifest(spark, path, slot)
        return records.decode_files(with_valid_length(storage_files(spark, path, min_slot), manifest)), slot
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("ledger_archive")
    if min_slot is not None:
        reader = reader.option("min_slot", str(min_slot))
    return reader.load(path), archive_slot(path)


def directory_manifest(spark: SparkSession, path: str, slot: int) -> DataFrame | None:
    """(slot, file_id, valid_len) that the directory's manifest lists, if it has one."""
    at = os.path.join(path, "snapshots", str(slot), str(slot))
    if not os.path.isfile(at) or not os.path.getsize(at):
        return None
    with open(at, "rb") as f:
        listed = manifest_body.valid_lengths(f)
    return spark.createDataFrame([(s, i, n) for (s, i), n in listed.items()], "slot long, file_id long, valid_len long")


def file_count(path: str) -> int | None:
    """How many storage files a directory has; an archive doesn't tell."""
    return sum(bool(_NAME.match(x)) for x in os.listdir(os.path.join(path, "accounts"))) if os.path.isdir(path) else None


def write_archive(path: str, slot: int, files: list[tuple[int, int, bytes]], manifest: bytes = b"") -> None:
    """An archive of (slot, file id, content) storage files, manifest first. For fixtures and tools."""
    import zstandard

    with open(path, "wb") as raw, zstandard.ZstdCompressor().stream_writer(raw) as out, tarfile.open(fileobj=out, mode="w|") as tar:
        for name, content in ((f"snapshots/{slot}/{slot}", manifest), *((f"accounts/{s}.{i}", c) for s, i, c in files)):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
