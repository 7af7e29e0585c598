"""Account records packed in storage files, to and from DataFrames.

A record is a 48-byte header (write version, data length, key), 56 bytes of account fields (lamports, rent epoch, owner,
executable, padding), a 32-byte hash and the data; every piece starts at a multiple of eight. The walk ends at the first
record that doesn't fit in the valid length.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEAD = struct.Struct("<QQ32s")
_ACCOUNT = struct.Struct("<QQ32sB7x")
_HASH = 32
MAX_FILE = 16 << 30
#: Records that make a batch on the way to Spark, and bytes of their data after which it is cut earlier.
BATCH_ROWS, BATCH_BYTES = 4096, 32 << 20
#: Bytes after which a piece of a storage file ends, at its record's end; records of a file that one task takes, about.
PIECE_BYTES, PART_ROWS = 4 << 20, 100_000

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("slot", T.LongType()),
        T.StructField("file_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("pubkey", T.BinaryType()),
        T.StructField("lamports", T.DecimalType(20, 0)),
        T.StructField("rent_epoch", T.DecimalType(20, 0)),
        T.StructField("owner", T.BinaryType()),
        T.StructField("executable", T.BooleanType()),
        T.StructField("hash", T.BinaryType()),
        T.StructField("data_len", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ]
)
_U64 = pa.decimal128(20, 0)
_ARROW = pa.schema(
    [("slot", pa.int64()), ("file_id", pa.int64()), ("offset", pa.int64()), ("pubkey", pa.binary()), ("lamports", _U64), ("rent_epoch", _U64), ("owner", pa.binary()), ("executable", pa.bool_()), ("hash", pa.binary()), ("data_len", pa.int64()), ("data", pa.binary())]
)
_PIECE = pa.schema([("slot", pa.int64()), ("file_id", pa.int64()), ("start", pa.int64()), ("valid_len", pa.int64()), ("content", pa.binary())])


def _up8(n: int) -> int:
    return n + (-n) % 8


def check_size(size: int, valid: int) -> None:
    """Reject what can't be a storage file."""
    if valid <= 0:
        raise ValueError("storage file is empty")
    if valid > MAX_FILE:
        raise ValueError(f"storage file of {valid} bytes is over the limit of {MAX_FILE}")
    if size < valid:
        raise EOFError(f"storage file has {size} bytes, {valid} are required")


def walk(blob: bytes | memoryview, valid: int | None = None) -> Iterator[tuple]:
    """(offset, pubkey, lamports, rent_epoch, owner, executable, hash, data) of each record."""
    view = memoryview(blob)
    end = len(view) if valid is None else valid
    at = 0
    while at + _HEAD.size <= end:
        _, size, key = _HEAD.unpack_from(view, at)
        account = _up8(at + _HEAD.size)
        digest = _up8(account + _ACCOUNT.size)
        data = _up8(digest + _HASH)
        if data + size > end:
            return
        lamports, rent, owner, executable = _ACCOUNT.unpack_from(view, account)
        yield at, key, lamports, rent, owner, bool(executable), bytes(view[digest : digest + _HASH]), bytes(view[data : data + size])
        at = _up8(data + size)


def walk_stream(read: Callable[[int], bytes], end: int, chunk: int = 8 << 20) -> Iterator[tuple]:
    """`walk` over the first `end` bytes of a stream, of which no more than a record and `chunk` bytes are held."""
    held, start, got = b"", 0, 0
    wanted = chunk
    while True:
        while got < end and len(held) < wanted:
            more = read(min(end - got, max(wanted - len(held), chunk)))
            if not more:
                raise EOFError(f"storage file has {got} bytes, {end} are required")
            got += len(more)
            held += more
        at = 0
        for at, *row in walk(held):
            yield start + at, *row
            at = _up8(_up8(_up8(_up8(at + _HEAD.size) + _ACCOUNT.size) + _HASH) + len(row[-1]))
        if got >= end:
            return
        held, start = held[at:], start + at
        wanted = max(chunk, 2 * len(held))  # a record that is longer than what is held


def pack(records: Iterable[tuple]) -> bytes:
    """The storage file of (pubkey, lamports, rent_epoch, owner, executable, hash, data) records; `walk` undoes it."""
    out = bytearray()
    for key, lamports, rent, owner, executable, digest, data in records:
        for piece in (_HEAD.pack(0, len(data), key), _ACCOUNT.pack(lamports, rent, owner, executable), digest, data):
            out += piece
            out += bytes(-len(out) % 8)
    return bytes(out)


def batches(slot: int, file_id: int, blob: bytes | memoryview, valid: int | None = None) -> Iterator[pa.RecordBatch]:
    return stacked(slot, file_id, walk(blob, valid))


def stacked(slot: int, file_id: int, found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a file's records, cut by rows and by bytes, so a file of many GB never stands in one batch."""
    rows: list[tuple] = []
    held = 0
    for offset, key, lamports, rent, owner, executable, digest, data in found:
        rows.append((slot, file_id, offset, key, Decimal(lamports), Decimal(rent), owner, executable, digest, len(data), data))
        held += len(data)
        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def decode(blobs: DataFrame) -> DataFrame:
    """Records of (slot, file_id, valid_len, content) rows; a null valid_len takes the whole content. Pieces of files have
    a column `start` too, where in the file they begin."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for slot, file_id, valid, content, start in zip(*(part.column(k) for k in range(5))):
                blob, n, start = memoryview(content.as_buffer()), valid.as_py(), start.as_py()
                check_size(len(blob), len(blob) if n is None else n)
                yield from stacked(slot.as_py(), file_id.as_py(), ((start + at, *row) for at, *row in walk(blob, n)))

    start = F.col("start") if "start" in blobs.columns else F.lit(0)
    return blobs.select("slot", "file_id", "valid_len", "content", start.cast("long").alias("start")).mapInArrow(run, RECORD_SCHEMA)


def decode_files(files: DataFrame) -> DataFrame:
    """Records of (slot, file_id, valid_len, path, length) rows: each file is opened where it is decoded, and read in pieces."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for slot, file_id, valid, path, length in zip(*(part.column(k).to_pylist() for k in range(5))):
                end = length if valid is None else valid
                check_size(length, end)
                with open_bytes(path) as f:
                    yield from stacked(slot, file_id, walk_stream(f.read, end))

    return files.select("slot", "file_id", "valid_len", "path", "length").mapInArrow(run, RECORD_SCHEMA)


def open_bytes(path: str):
    """A byte stream of a local path or any URI that Arrow's file systems know."""
    if path.startswith("file:"):
        from urllib.parse import unquote, urlsplit

        return open(unquote(urlsplit(path).path), "rb")
    if "://" in path:
        from pyarrow import fs

        at, inner = fs.FileSystem.from_uri(path)
        return at.open_input_stream(inner, compression=None)
    return open(path, "rb")


#: The columns that `_pieces` reads, after the number of the file's part.
_PACKED = ["slot", "file_id", "pubkey", "lamports", "rent_epoch", "owner", "executable", "hash", "data"]


def _pieces(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(slot, file_id, start, content) of batches that are sorted by file and part; no more than one piece is held at a time."""
    now, start, held = None, 0, bytearray()
    for batch in parts:
        for a in range(0, batch.num_rows, BATCH_ROWS):
            for part, slot, file_id, key, lamports, rent, *rest in zip(*(c.to_pylist() for c in batch.slice(a, BATCH_ROWS).columns)):
                if now != (slot, file_id, part):
                    if held:
                        yield *now[:2], start, bytes(held)
                    now, start, held = (slot, file_id, part), 0, bytearray()
                held += pack([(key, int(lamports), int(rent), *rest)])
                if len(held) >= most:
                    yield *now[:2], start, bytes(held)
                    start, held = start + len(held), bytearray()
    if held:
        yield *now[:2], start, bytes(held)


def encode_pieces(accounts: DataFrame, most: int = PIECE_BYTES) -> DataFrame:
    """(slot, file_id, start, valid_len, content): storage files of decoded records, in pieces of whole records and about
    `most` bytes. A file's pieces in order are what `encode` makes of it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, file_id, start, content in _pieces(parts, most):
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((slot, file_id, start, len(content), content), _PIECE)], schema=_PIECE)

    rows = accounts.repartition("slot", "file_id").sortWithinPartitions("slot", "file_id", "offset")  # the sort spills
    return rows.select(F.lit(0).alias("part"), *_PACKED).mapInArrow(run, "slot long, file_id long, start long, valid_len long, content binary")


def through_files(accounts: DataFrame, most: int = PIECE_BYTES, part_rows: int = PART_ROWS) -> DataFrame:
    """`decode` of `encode` for files of any size: packed and walked in one pass, a piece at a time.

    A file of over `part_rows` records is dealt to several tasks by offset, each packing a file of its own; the offsets of
    its records count from there.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, file_id, start, content in _pieces(parts, most):
            yield from stacked(slot, file_id, ((start + at, *row) for at, *row in walk(content)))

    files = accounts.groupBy("slot", "file_id").agg(F.count("*").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"))
    large = files.where(F.col("n") > part_rows).select(F.col("slot").alias("s"), F.col("file_id").alias("f"), "low", ((F.col("high") - F.col("low") + 1) / F.ceil(F.col("n") / part_rows)).alias("width"))
    rows = accounts.join(F.broadcast(large), (F.col("slot") == F.col("s")) & (F.col("file_id") == F.col("f")), "left")  # as many rows as parts at most
    rows = rows.withColumn("part", F.coalesce(F.floor((F.col("offset") - F.col("low")) / F.col("width")), F.lit(0)))
    rows = rows.repartition("slot", "file_id", "part").sortWithinPartitions("slot", "file_id", "part", "offset").select("part", *_PACKED)
    return rows.mapInArrow(run, RECORD_SCHEMA)


def encode(accounts: DataFrame) -> DataFrame:
    """(slot, file_id, valid_len, content): storage files of decoded records, one for each (slot, file_id). A file is held
    whole; `encode_pieces` is for large ones."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        names = ["pubkey", "lamports", "rent_epoch", "owner", "executable", "hash", "data"]
        rows = zip(*(group.column(n).to_pylist() for n in names))
        blob = pack((k, int(lam), int(rent), o, x, h, d) for k, lam, rent, o, x, h, d in rows)
        return pa.table({"slot": group.column("slot")[:1], "file_id": group.column("file_id")[:1], "valid_len": pa.array([len(blob)], pa.int64()), "content": pa.array([blob], pa.binary())})

    return accounts.groupBy("slot", "file_id").applyInArrow(run, "slot long, file_id long, valid_len long, content binary")
