"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two segments of 32 bits, and a table for each holds the different fingerprints under that segment's
value. Two fingerprints at distance two or less differ by one bit at most in one of the segments, so each enumerates the
Hamming ball of radius one around either of its segments, 33 values, fetches what the table holds there, and complete
distances are verified; components follow. Copies were grouped before and cost nothing.

Many different fingerprints may still agree in a whole segment, as those of long texts made from one form do. A table
entry of more than CROWDED fingerprints is not compared all with all: those that reach it are put under whole
fingerprints as keys, each under itself and all 64 flips of one bit. Two at distance two or less share such a key and a
key holds 65 at most, whatever the data. Neighbours in a key are linked in order.

`representatives` follows another rule, the pipeline's: texts whose sets of five-word shingles have a Jaccard similarity of
0.8 or more are one group. Some 15 % of the bits of two such texts differ, too many for one fingerprint of 64 bits and
balls, so its SimHash is WIDE bits long. Each shingle votes on all of them by a row of normally distributed numbers, its
bucket's, counted up or down by its hash; a bit is set if the sum is positive, so bits differ as often as the angle of
the two sets says. Each table's key is another choice of these bits, more of them the more texts there are, and as many
tables as let a pair of the least similarity meet but for MISS. Texts that meet in a table are compared by CHECK further
bits; an entry of over CROWDED texts stays together. The similarity of what is left is verified exactly (see
`substring_dedup.links`), so fingerprints only choose what is compared. Texts of fewer than five words are near only to
equal words.

Defined results: null and empty texts have no words and the fingerprint zero, which links like any other. Fewer words
than a shingle form one shingle. Repeated rows and ids give one result row for each input row. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import simhash, substring_dedup
from tidemark.llm.common import PLAIN_WORD, ascii_lower, components, forget, words, written

#: Fingerprints of one table entry that are compared with each that reaches it.
CROWDED = 64
SEGMENT_BITS = 32
SHINGLE = 5
#: Rows of votes, bits from which the tables of `representatives` draw, and bits for the distance alone.
BUCKETS, WIDE, CHECK = 1024, 2048, 128
#: How often texts of just the similarity asked for may meet in no table, and the deviation of their share of differing
#: bits (0.0090 to 0.0099 as measured): of WIDE draws, and of shingles that fall into one bucket.
MISS, SPREAD = 3e-5, 0.01
#: Texts that are taken at a time, table entries that one pass is meant to make, and passes at most.
BLOCK, PASS, PASSES = 256, 16_000_000, 8


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, text_hash, fp, copies): the fingerprint of each text; rows equal in id and text are one row with a count."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), words(ascii_lower(text), PLAIN_WORD).alias("w"))
    terms = simhash.term_rows(rows, ["id", "text_hash"], "w", size)
    h = F.when(F.size("w") > 0, F.xxhash64(F.concat_ws(" ", *simhash.shingle("w", size)))).otherwise(F.lit(0).cast("long"))
    terms = terms.select("id", "text_hash", "_i", h.alias("h"))
    sums = terms.groupBy("id", "text_hash").agg(
        F.count("*").alias("n"), F.sum((F.col("_i") == 0).cast("long")).alias("copies"), *simhash.vote_sums(F.col("h"))
    )
    return sums.select("id", "text_hash", simhash.majority(F.col("n")).alias("fp"), "copies")


def segment_values(fp: Column) -> list[Column]:
    return [fp.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)), F.shiftrightunsigned(fp, SEGMENT_BITS)]


def _tables(fps: DataFrame, name: str, reach: int) -> DataFrame:
    """(name, segment, value): each fingerprint under all values within `reach` (0 or 1) bits of each segment."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    flips = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)), bit)) if reach else F.array(F.lit(0).cast("long"))
    rows = fps.select(F.col("fp").alias(name), F.posexplode(F.array(*segment_values(F.col("fp")))).alias("segment", "value"))
    return rows.withColumn("flip", F.explode(flips)).select(name, "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))


def links(fps: DataFrame, radius: int = 2, crowded: int = CROWDED) -> DataFrame:
    """(a, b): verified links between different fingerprints of column `fp`, each there once, that connect whatever is within `radius`.

    `radius` is 0 (none) to 2. Of a crowded table entry, links that follow from others by way of a shared key are left out.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius must be 0, 1 or 2")
    near = (F.col("other") < F.col("fp")) & (simhash.distance(F.col("fp"), F.col("other")) <= radius)
    probes, entries = _tables(fps, "fp", radius // 2), _tables(fps, "other", 0)
    full = written(entries.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("segment", "value"), "crowded-entries")
    if not full.head(1):
        forget(full)
        return probes.join(entries, ["segment", "value"]).where(near).select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct()
    met = probes.join(entries.join(full, ["segment", "value"], "left_anti"), ["segment", "value"]).where(near).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    reached = probes.join(full, ["segment", "value"], "left_semi").select("fp").distinct()
    keyed = reached.select("fp", F.explode(F.concat(F.array("fp"), simhash.flips(F.col("fp")))).alias("key"))
    order = Window.partitionBy("key").orderBy("fp")  # 65 at most
    # at radius 1 a key's own fingerprint is one of the two
    other = F.lag("fp").over(order) if radius == 2 else F.max(F.when(F.col("fp") == F.col("key"), F.col("fp"))).over(Window.partitionBy("key"))
    pairs = keyed.select("fp", other.alias("other")).where(F.col("other").isNotNull() & (F.col("other") != F.col("fp")))
    pairs = pairs.select(F.greatest("fp", "other").alias("fp"), F.least("fp", "other").alias("other"))
    return met.unionByName(pairs.where(near).select(F.col("fp").alias("a"), F.col("other").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id) for each row; component_id is the smallest id that links reach."""
    fps = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("id").alias("low"))
    linked = components(links(least.select("fp"), radius)) if radius else fps.select(F.col("fp").alias("node"), F.col("fp").alias("root")).limit(0)
    linked = linked.select(F.col("node").alias("fp"), "root")
    by_fp = least.join(linked, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    by_root = by_fp.groupBy("root").agg(F.min("low").alias("component_id"))
    named = by_fp.join(by_root, "root").select("fp", "component_id")
    out = fps.join(named, "fp").select("id", "fp", "component_id", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    out = written(out.select(F.col("id").alias(id_col), simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id"), "near-duplicates")
    forget(fps)
    return out


@cache
def _votes() -> np.ndarray:
    """A row for each bucket; whole numbers, so sums are the same in any order."""
    return np.rint(np.random.default_rng(78).standard_normal((BUCKETS, CHECK + WIDE)) * 64).astype(np.float32)


def wide_fingerprints(h: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """CHECK + WIDE bits, packed, for each of `count` texts: `h` are the hashes of its different shingles, `owner` their text."""
    out = np.zeros((count, (CHECK + WIDE) // 8), np.uint8)
    bucket, sign = (h >> np.uint64(20)).astype(np.int64) % BUCKETS, 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64)
    cuts = np.searchsorted(owner, np.arange(0, count + BLOCK, BLOCK))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        size = min(BLOCK, count - k * BLOCK)
        sums = np.bincount((owner[a:b] - k * BLOCK) * BUCKETS + bucket[a:b], sign[a:b], size * BUCKETS).astype(np.float32).reshape(size, BUCKETS)
        out[k * BLOCK : k * BLOCK + size] = np.packbits(sums @ _votes() > 0, axis=1)
    return out


def _prints(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The identity of each text's words, whether it has a shingle, and the fingerprints of those that have."""
    words = substring_dedup.words_of(texts)
    begin, stop = words.cuts[:-1], words.cuts[1:]
    unit, check = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int32)
    some = stop > begin
    unit[some], check[some] = substring_dedup.identities(words.h, begin[some], stop[some])
    has = stop - begin >= SHINGLE
    sets = [np.unique(substring_dedup.shingle_hashes(words.h[a:b])) for a, b in zip(begin[has].tolist(), stop[has].tolist())]
    if not sets:
        return unit, check, has, np.zeros((0, (CHECK + WIDE) // 8), np.uint8)
    return unit, check, has, wide_fingerprints(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets]), len(sets))


def _whole_texts(rows: DataFrame) -> DataFrame:
    """id, text_hash, unit, check, fp (null for texts of fewer words than a shingle) of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in substring_dedup.parts(batch.column(2)):
                part = batch.slice(a, len(texts))
                unit, check, has, prints = _prints(texts)
                each = iter(prints)
                fp = pa.array([next(each).tobytes() if x else None for x in has], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(unit), pa.array(check), fp], names=["id", "text_hash", "unit", "check", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text_hash", "text").mapInArrow(run, f"id {kind}, text_hash long, unit long, check int, fp binary")


def differing(similarity: float) -> float:
    """The share of bits in which two sets of this Jaccard similarity differ at most: their angle, the same sizes given."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def wide_tables(count: int, similarity: float) -> tuple[int, int]:
    """Bits of a key, so many that strangers seldom share one, and the number of tables for `count` texts."""
    bits = min(32, max(8, count.bit_length() + 1))
    z = np.linspace(-6, 6, 241)
    chance = np.exp(-z * z / 2) / np.exp(-z * z / 2).sum()
    apart = np.log1p(-np.minimum((1 - np.clip(differing(similarity) + z * SPREAD, 0, 1)) ** bits, 1 - 1e-12))
    most = next(n for k in range(40) if chance @ np.exp((n := 1 << k) * apart) <= MISS)
    return bits, bisect_left(range(most), True, key=lambda n: bool(chance @ np.exp(n * apart) <= MISS))


def _entries(prints: DataFrame, bits: int, numbers: range) -> DataFrame:
    """(key, unit, c0, c1): each of `prints` (unit, fp) in the tables of these numbers, with the bits for the distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = np.array([np.random.default_rng([79, t]).choice(WIDE, bits, replace=False) + CHECK for t in numbers])
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                each = np.ascontiguousarray(np.unpackbits(raw, axis=1).T)
                key = np.repeat(np.array(numbers, np.int64), part.num_rows).reshape(len(numbers), -1)
                for k in range(bits):
                    key = key << 1 | each[drawn[:, k]]
                own = np.ascontiguousarray(raw[:, : CHECK // 8]).view(np.int64)
                columns = key.ravel(), *(np.tile(x, len(numbers)) for x in (part.column(0).to_numpy(), own[:, 0], own[:, 1]))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "unit", "c0", "c1"])

    return prints.select("unit", "fp").mapInArrow(run, "key long, unit long, c0 long, c1 long")


def _meetings(key: np.ndarray, c0: np.ndarray, c1: np.ndarray, radius: int) -> np.ndarray:
    """Whether each row, sorted by key, has another within `radius` under its key or is in a crowded entry."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((first, [len(key)])))
    crowded = np.repeat(size > CROWDED, size)
    near, at = crowded.copy(), np.flatnonzero(~crowded)
    for d in range(1, CROWDED):
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        if not len(at):
            break
        met = at[np.bitwise_count((c0[at] ^ c0[at + d]).view(np.uint64)).astype(int) + np.bitwise_count((c1[at] ^ c1[at + d]).view(np.uint64)) <= radius]
        near[met] = near[met + d] = True
    return near


def _met(entries: DataFrame, radius: int) -> DataFrame:
    """(unit, band): the entries that are near others under their key. A key's rows come one after another; once a key is
    known to be crowded, its rows are passed on as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, crowded = [np.zeros(0, np.int64)] * 4, None
        out = lambda rows, near: pa.RecordBatch.from_arrays([pa.array(rows[1][near]), pa.array(rows[0][near])], names=["unit", "band"])
        for batch in batches:
            rows = [np.concatenate((a, batch.column(k).to_numpy())) for k, a in enumerate(rest)]
            if not len(rows[0]):
                continue
            if crowded is not None and (more := int(np.searchsorted(rows[0], crowded, side="right"))):
                yield out(rows, slice(0, more))
                rest = rows = [x[more:] for x in rows]
                if not len(rows[0]):
                    continue
            begin = int(np.searchsorted(rows[0], rows[0][-1]))
            if len(rows[0]) - begin > CROWDED:
                crowded, begin = rows[0][-1], len(rows[0])
            yield out(rows, _meetings(rows[0][:begin], *(x[:begin] for x in rows[2:]), radius).nonzero()[0])
            rest = [x[begin:] for x in rows]
        yield out(rest, _meetings(rest[0], *rest[2:], radius).nonzero()[0])

    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(run, "unit long, band long")


def meetings(prints: DataFrame, similarity: float, made: list[DataFrame]) -> DataFrame:
    """(unit, bands): for each of `prints` (unit, fp) that is near others in a table, the keys where it is.

    Tables are made and searched a few at a time, so that their shuffles don't all lie on disk at once.
    """
    count = prints.count()
    bits, tables = wide_tables(count, similarity)
    share = differing(similarity)
    radius = math.floor(CHECK * share + 5.5 * math.sqrt(CHECK * share * (1 - share)))
    step = -(-tables // min(PASSES, max(1, -(-count * tables // PASS))))
    found = [substring_dedup.kept(made, _met(_entries(prints, bits, range(a, min(tables, a + step))), radius), "met") for a in range(0, tables, step)]
    both = found[0]
    for df in found[1:]:
        both = both.unionByName(df)
    return both.groupBy("unit").agg(F.collect_list("band").alias("bands"))  # one for each table at most


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """The rows of `docs`, all their columns, that stay: of each group of near texts the one of smallest id, then text hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), ascii_lower(text).alias("text"))
    made: list[DataFrame] = []
    keep = substring_dedup.kept
    found = substring_dedup.told_apart(keep(made, _whole_texts(rows), "whole-texts"))
    one = keep(made, found.groupBy("unit").agg(F.min(F.struct(F.col("text_hash").alias("key"), "fp")).alias("p")).select("unit", "p.*"), "texts")
    met = keep(made, meetings(one.where(F.col("fp").isNotNull()).select("unit", "fp"), similarity, made), "met-by-text")
    grouped = substring_dedup.members(met, made)
    whole = [F.lit(x).cast(t).alias(n) for x, t, n in ((substring_dedup.SET, "int", "kind"), (0, "long", "start"), ((1 << 31) - 1, "long", "end"))]
    wanted = one.join(grouped.select("unit").distinct(), "unit", "left_semi").select("unit", "key", *whole)
    seen = keep(made, substring_dedup.look_up(rows.select(F.col("text_hash").alias("key"), "text"), wanted), "looked-up")
    made.append(near := substring_dedup.links(grouped, seen.select("unit", "s"), similarity))
    made.append(linked := components(near))
    least = found.groupBy("unit").agg(F.min(F.struct("id", "text_hash")).alias("low"))
    named = least.join(linked.withColumnRenamed("node", "unit"), "unit", "left")
    by_root = named.groupBy(F.coalesce("root", "unit").alias("root")).agg(F.min("low").alias("low"))
    tag = uuid.uuid4().hex  # no column of a caller's has such a name
    mine, theirs, own = f"id{tag}", f"hash{tag}", f"text{tag}"
    stay = written(by_root.select(F.col("low.id").alias(mine), F.col("low.text_hash").alias(theirs)), "stay")
    for df in made:
        forget(df)
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    kept = rows.join(stay, rows[id_col].eqNullSafe(stay[mine]) & (rows[own] == stay[theirs]), "left_semi")
    return kept.dropDuplicates([id_col, own]).select(*docs.columns)
