"""Archives as a streaming source: offsets are slots, a micro-batch is the archives that lead from one slot to another.

`spark.readStream.format("ledger_archives").load(folder)` gives the records of each new archive with the archive's slot
and kind. From a slot, the furthest incremental that starts at or before it is taken, else the furthest full archive;
storage files at or under the slot that was reached before are passed over, so nothing is read twice. Options:
`start_slot` (where to begin, -1 by default) and `max_archives` (by how many archives each look goes
further than the one before it, so that a query that has fallen behind isn't offered everything at once; no bound by
default). The trigger's interval is the poll interval; the query's checkpoint keeps
the slot that was reached.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources import archive, records

_FULL = re.compile(r"^snapshot-(\d+)-[1-9A-HJ-NP-Za-km-z]+\.tar\.zst$")
_DELTA = re.compile(r"^incremental-snapshot-(\d+)-(\d+)-[1-9A-HJ-NP-Za-km-z]+\.tar\.zst$")
SCHEMA = T.StructType([T.StructField("archive_slot", T.LongType()), T.StructField("kind", T.StringType()), *records.RECORD_SCHEMA.fields])


def listed(folder: str) -> list[tuple[str, int | None, int]]:
    """(path, base slot or None for a full archive, slot)."""
    out = []
    for e in os.scandir(folder):
        if m := _FULL.match(e.name):
            out.append((e.path, None, int(m[1])))
        elif m := _DELTA.match(e.name):
            out.append((e.path, int(m[1]), int(m[2])))
    return sorted(out)


def chain(found: list[tuple[str, int | None, int]], start: int, end: int | None = None) -> list[tuple[str, int | None, int, int]]:
    """The archives to read in turn to get from `start` as far as possible (or to `end`): path, base, slot, slot before."""
    out, at = [], start
    while True:
        ahead = [x for x in found if x[2] > at and (end is None or x[2] <= end)]
        fit = [x for x in ahead if x[1] is not None and x[1] <= at and at >= 0] or [x for x in ahead if x[1] is None]
        if not fit:
            return out
        path, base, slot = min(fit, key=lambda x: (-x[2], x[0]))
        out.append((path, base, slot, at))
        at = slot


@dataclass
class Archive(InputPartition):
    path: str
    kind: str
    slot: int
    before: int | None


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.start = options["path"], int(options.get("start_slot", -1))
        self.most = int(options["max_archives"]) if "max_archives" in options else None
        self.offered = 0

    def initialOffset(self) -> dict:
        return {"slot": self.start}

    def latestOffset(self) -> dict:
        steps = chain(listed(self.folder), self.start)
        if self.most:
            # a query that resumes knows where it is only after it has been offered more than that
            self.offered = min(self.offered + self.most, len(steps))
            steps = steps[: self.offered]
        return {"slot": steps[-1][2] if steps else self.start}

    def partitions(self, start: dict, end: dict) -> list[Archive]:
        steps = chain(listed(self.folder), start["slot"], end["slot"])
        # a full archive read first is the baseline and is taken whole
        return [Archive(path, "full" if base is None else "incremental", slot, None if base is None else before) for path, base, slot, before in steps]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        for _, slot, file_id, found in archive.entries(partition.path, partition.before):
            for batch in records.stacked(slot, file_id, found):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([partition.slot] * n, pa.int64()), pa.array([partition.kind] * n), *batch.columns], names=SCHEMA.names)

    def commit(self, end: dict) -> None:
        self.start, self.offered = end["slot"], 0  # later offsets are looked for from here


class ArchiveStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledger_archives"

    def schema(self) -> T.StructType:
        return SCHEMA

    def streamReader(self, schema: T.StructType) -> Reader:
        return Reader(self.options)
