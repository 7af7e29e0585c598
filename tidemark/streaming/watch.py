"""Watch a folder of archives and keep the serving generation up to date.

Two lanes: the active one serves and takes incrementals; a newer full archive starts the staging lane. While that full
archive is loaded, the active lane takes the part of it that it hasn't seen. When staging has taken its first
incremental, it is published. Each step is noted in a journal before it starts and after it is done, and repeating a
step does no harm, so the watch can be killed at any point.
"""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.token_info import enabled
from tidemark.plans.generations import COMPACT_AFTER, Generation, NotReady, Store
from tidemark.plans.ingest import fan_out, full_load, incremental_load, read_stats
from tidemark.sources import archive, discovery, paths

log = logging.getLogger(__name__)

#: Fixed value: the version of the journal's form.
VERSION = 5
PHASES = ("disabled", "waiting_for_full", "full_loading", "full_merging", "ready", "incremental_loading", "cutover_pending")


@dataclass
class Lane:
    phase: str = "disabled"
    full_path: str | None = None
    full_slot: int | None = None
    max_slot: int | None = None
    generation: str | None = None
    inflight: str | None = None


@dataclass
class Journal:
    version: int = VERSION
    active: Lane = field(default_factory=Lane)
    staging: Lane = field(default_factory=Lane)
    cutover: dict | None = None
    shared_full: dict | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        paths.replace_text(spark, path, json.dumps(asdict(self), indent=1))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Journal:
        return cls.migrated(json.loads(paths.read_text(spark, path))) if paths.exists(spark, path) else cls()

    @classmethod
    def migrated(cls, raw: dict) -> Journal:
        """Older forms had one lane at the top level (2), lanes without a cut-over (3), or without a shared load (4)."""
        version = raw.get("version", 2)
        if version > VERSION:
            raise ValueError(f"the journal is of version {version}")
        lane = lambda x: Lane(**{k: v for k, v in (x or {}).items() if k in Lane.__dataclass_fields__})
        if version == 2:
            slot = raw.get("max_slot")
            old = Lane("ready" if slot is not None else "waiting_for_full", raw.get("full_path"), raw.get("full_slot"), slot, raw.get("generation"))
            return cls(active=old)
        out = cls(VERSION, lane(raw.get("active")), lane(raw.get("staging")), raw.get("cutover"), raw.get("shared_full"))
        for one in (out.active, out.staging):
            if one.phase not in PHASES:
                raise ValueError(f"unknown phase {one.phase}")
        return out


class Watch:
    def __init__(self, spark: SparkSession, store: Store, directory: str, hot_tokens, rewind: int = 1000, bootstrap: bool = False, compact_after: int = COMPACT_AFTER) -> None:
        """`hot_tokens`: called for the current (mint, enable, version) list when a generation freezes it. `bootstrap`:
        don't resume from the serving tables; they serve on until a full archive has made new ones."""
        self.spark, self.store, self.directory, self.hot_tokens, self.rewind, self.compact_after = spark, store, directory, hot_tokens, rewind, compact_after
        self.path = paths.join(store.root, "journal.json")
        self.journal = Journal() if bootstrap else Journal.load(spark, self.path)
        if bootstrap:
            return
        if self.journal.active.max_slot is None and (now := store.serving()) and self.journal.active.phase == "disabled":
            # no journal but tables: resume a little before what they hold; versions make the repetition harmless
            slot = now.versions("raw_account").agg(F.coalesce(F.max("updated_slot"), F.lit(0))).first()[0]
            self.journal.active = Lane("ready", max_slot=max(0, slot - rewind), full_slot=max(0, slot - rewind), generation=now.name)

    def save(self) -> None:
        self.journal.save(self.spark, self.path)

    def archives(self) -> list:
        return discovery.discover(self.spark, self.directory).collect()  # a folder's archives are few

    def step(self) -> str | None:
        """Do the most urgent thing; what it was, or None if nothing is to do."""
        j = self.journal
        if j.shared_full:
            return self._load_full(j.shared_full)
        if j.cutover or j.active.phase == j.staging.phase == "cutover_pending":
            return self._cut_over()
        found = self.archives()
        base = j.active.full_slot if j.active.full_slot is not None else -1
        newer = max((a for a in found if a["kind"] == "full" and a["slot"] > base), key=lambda a: (a["slot"], [-ord(c) for c in a["path"]]), default=None)
        if newer is not None and j.staging.phase == "disabled":
            j.shared_full = {"path": newer["path"], "slot": newer["slot"], "generation": self.store.new().name, "active_slot": j.active.max_slot}
            j.staging = Lane("full_loading", newer["path"], newer["slot"], None, j.shared_full["generation"])
            self.save()
            return self._load_full(j.shared_full)
        for name in ("staging", "active"):
            lane = getattr(j, name)
            if lane.phase not in ("ready", "incremental_loading") or lane.max_slot is None:
                continue
            fit = [a for a in found if a["kind"] == "incremental" and a["base_slot"] <= lane.max_slot < a["slot"]]
            if fit:
                best = min(fit, key=lambda a: (-a["slot"], a["path"]))
                return self._load_incremental(name, lane, best["path"], best["slot"])
        return None

    def run(self, limit: int = 1000) -> list[str]:
        """Steps until nothing is to do."""
        with self.store.single_writer():
            return self._steps(limit)

    def _steps(self, limit: int = 1000) -> list[str]:
        out: list[str] = []
        while len(out) < limit and (done := self.step()):
            log.info("%s", done)
            out.append(done)
        return out

    def follow(self, seconds: float = 5.0, stop: Callable[[], bool] = lambda: False) -> None:
        """Keep on: look for archives every so many seconds, until `stop` says so."""
        with self.store.single_writer():
            while not stop():
                if not self._steps():
                    time.sleep(seconds)

    def _recorded(self, path: str, slot: int) -> str:
        """The full archive that the journal names, if it is still there under the same name."""
        if not any(a["kind"] == "full" and a["path"] == path and a["slot"] == slot for a in self.archives()):
            raise NotReady(f"the full archive {path} of slot {slot} that the journal names is not there")
        return path

    def _decoded(self, generation: Generation, path: str, name: str, min_slot: int | None = None) -> tuple[DataFrame, int, str]:
        """The archive's records, decoded once and written, its slot, and where they are."""
        at = paths.join(generation.path, "_records", name)
        slot = archive.directory_slot(path) if os.path.isdir(path) else archive.archive_slot(path)
        if not paths.complete(self.spark, at):
            archive.read_checkpoint(self.spark, path, min_slot)[0].write.mode("overwrite").parquet(at)
        return self.spark.read.parquet(at), slot, at

    def _load_full(self, load: dict) -> str:
        """One scan of the archive feeds the new generation and, for what the active lane hasn't seen, the active one."""
        j = self.journal
        new = self.store.generation(load["generation"])
        records, slot, at = self._decoded(new, self._recorded(load["path"], load["slot"]), f"full-{load['slot']}")
        new.freeze(enabled(self.hot_tokens()))
        hot = new.frozen()
        for table, rows in full_load(records, hot, slot, new.versions("raw_token_metadata").limit(0)).items():
            new.write(table, rows, f"full-{slot}")
        active = self.store.serving()
        if active is not None and load["active_slot"] is not None and load["active_slot"] < slot:
            self._append(active, fan_out(records, {"active": load["active_slot"]})["active"], slot, f"full-{slot}")
            j.active.max_slot = max(j.active.max_slot, slot)
        log.info("full %s: %s", slot, read_stats(records))
        j.staging = Lane("ready", load["path"], load["slot"], slot, new.name)
        j.shared_full = None
        if active is None:  # nothing serves yet, so there is nothing to wait for
            j.cutover = {"active": None, "staging": new.name}
        self.save()
        paths.delete(self.spark, at)  # the decoded records have done their work
        return f"full {load['slot']}"

    def _append(self, generation: Generation, records: DataFrame, slot: int, batch: str) -> None:
        # a batch must not read what it replaces, should an earlier attempt have written it
        before = {t: generation.versions(t, without=batch) for t in ("raw_token_metadata", "hot_token_account_state")}
        by_pair = generation.versions("hot_token_account_state", by="mint", without=batch)
        rows = incremental_load(records, generation.frozen(), slot, before, by_pair)
        state = rows.pop("hot_token_account_state")
        for table, df in {**rows, "hot_token_account_state": state}.items():
            generation.write(table, df, batch)
        generation.compact_if_due(self.compact_after)

    def _load_incremental(self, name: str, lane: Lane, path: str, slot: int) -> str:
        lane.phase, lane.inflight = "incremental_loading", path
        self.save()
        generation = self.store.generation(lane.generation)
        records, snapshot, at = self._decoded(generation, path, f"incremental-{slot}", lane.max_slot)
        self._append(generation, records, snapshot, f"incremental-{slot}")
        log.info("incremental %s: %s", slot, read_stats(records))
        lane.max_slot, lane.inflight, lane.phase = slot, None, "ready"
        if name == "staging":
            lane.phase = self.journal.active.phase = "cutover_pending"
        self.save()
        paths.delete(self.spark, at)
        return f"incremental {name} {slot}"

    def remove_processed(self) -> list[str]:
        """Delete the archives that the active lane no longer needs; their paths. Nothing calls this by itself."""
        j = self.journal
        slots = [x.max_slot for x in (j.active, j.staging) if x.max_slot is not None]
        if not slots or j.shared_full:
            return []
        gone = [r["path"] for r in discovery.processed(discovery.discover(self.spark, self.directory), min(slots)).collect()]  # a folder's archives are few
        for path in gone:
            paths.delete(self.spark, path)
        return gone

    def _cut_over(self) -> str:
        j = self.journal
        now = self.store.serving()
        if j.cutover is None:
            j.cutover = {"active": now.name if now else None, "staging": j.staging.generation}
            self.save()
        new = self.store.generation(j.cutover["staging"])
        self.store.publish(new, j.cutover["active"])
        j.active = Lane("ready", j.staging.full_path, j.staging.full_slot, j.staging.max_slot, new.name)
        j.staging, j.cutover = Lane(), None
        self.save()
        # what neither lane refers to any more: generations, their frozen lists and decoded records
        self.store.sweep({x for x in (j.active.generation, j.staging.generation) if x})
        return f"publish {new.name}"
