"""Benchmark decontamination: item-sized windows of documents whose SimHash is near a benchmark item's.

Texts become lower-case words (runs of letters and digits) and shingles of five words; a shingle's weight is how often
the item or window has it. The similarity of a window with an item is the overlap: the sum over shingles of the smaller
weight, divided by the item's weights. It is a leak from 0.8.

1. Only shingles that some item has weigh anything; their places in a text are its anchors, which one pass finds. A
   window of an item's length that starts between anchors has no shingle of the item that the one from the next anchor
   on lacks, so windows start at anchors. Of those, a window is laid if anchors of items of its length make 0.8 of the
   item's shingles at least and if it reaches an anchor that the window before didn't; all others hold less, or less
   than is needed. So the best window of every item in every text is laid, wherever its words were moved.
2. Each gets a 128-bit SimHash of its weighted anchors. Fingerprints are cut into eight blocks of 16 bits. RADIUS
   differing bits leave four or fewer in some block: items enumerate the Hamming ball of two bits around each of their blocks, windows
   that around theirs, and where the balls meet is every item within the radius. (A similarity of 0.8 is 19 to 26 bits
   on average, standard deviation under five.)
3. Those are verified: distance, then exact weighted overlap. Of an item's windows in a document the best is reported.

All on built-in expressions. The benchmark's shingles are broadcast only if they are at most BROADCAST_SHINGLES, else
joined by a shuffle.

Defined results: null and empty texts have no shingles and match nothing; so do items without words. An item of fewer
than five words is one shingle, its whole word sequence, and documents are searched for sequences of that length. Equal
items are each reported. Repeated rows of a document count once; rows of equal ids and different texts are searched each by
itself, and the best window of the id is reported; rows without an id can't be reported and are passed over. Of equal
windows the first is reported. Very long texts are used whole, other columns are ignored whatever their names, and empty
tables give an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import LETTER_WORD, forget, words, written

SIZE = 5
SIMILARITY = 0.8
RADIUS = 39
BLOCK_BITS = 16
BROADCAST_SHINGLES = 1_000_000
#: A text, told from others of its id by its hash, and a window there; items' lengths differ, so length is part of the key.
TEXT = ["doc_id", "twin"]
KEY = [*TEXT, "start", "length"]


def _split(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    return df.select(F.col(id_col).alias(name), words(text, LETTER_WORD).alias("w"))


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, twin, length, size, at, h) for each shingle of each item with words; twin tells items of equal id apart."""
    split = _split(items, id_col, text_col, "item_id").where(F.size("w") > 0)
    split = split.withColumn("length", F.size("w")).withColumn("size", F.least(F.lit(SIZE), F.size("w"))).withColumn("twin", F.xxhash64("w")).distinct()
    at = split.select("*", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))).alias("at"))
    return at.select("item_id", "twin", "length", "size", "at", F.xxhash64(*[F.get("w", F.col("at") + k) for k in range(SIZE)]).alias("h"))


def _both_halves(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, f0 and f1: the 128-bit SimHash of the shingle hashes `h` with weights `n`."""
    n = F.col("n")
    weighted = lambda h, name: [(F.sum(F.shiftright(h, i).bitwiseAND(F.lit(0x0000000100000001)) * n)).alias(f"{name}{i}") for i in range(32)]
    second = F.xxhash64(F.col("h"))
    sums = rows.groupBy(*keys).agg(F.sum("n").alias("_n"), *weighted(F.col("h"), "_a"), *weighted(second, "_b"))
    return sums.select(*keys, F.col("_n").alias("weight"), simhash.majority(F.col("_n"), "_a").alias("f0"), simhash.majority(F.col("_n"), "_b").alias("f1"))


def block_values() -> list[Column]:
    """The eight blocks of (f0, f1), each 16 bits."""
    return [F.shiftright(F.col(f), BLOCK_BITS * k).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int") for f in ("f0", "f1") for k in range(64 // BLOCK_BITS)]


def ball(radius: int, bits: int = BLOCK_BITS) -> list[int]:
    return [sum(1 << b for b in flips) for r in range(radius + 1) for flips in combinations(range(bits), r)]


def _tables(rows: DataFrame, columns: list, reach: int) -> DataFrame:
    """`columns`, block and value: a row for everything within `reach` bits of each block."""
    rows = rows.select(*columns, F.posexplode(F.array(*block_values())).alias("block", "value"))
    rows = rows.withColumn("flip", F.explode(F.array(*[F.lit(x) for x in ball(reach)])))
    return rows.withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")


def near_items(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Every pair of a window (KEY, f0, f1) and an item (item_id, item_twin, item_length, f0, f1) within `radius`: multi-index blocks.

    Some block differs by at most reach bits; items and windows enumerate half of that each.
    """
    reach = radius // len(block_values())
    laid = _tables(items, ["item_id", "item_twin", F.col("item_length").alias("length"), "f0", "f1"], (reach + 1) // 2)
    laid = laid.withColumnsRenamed({"f0": "i0", "f1": "i1"})
    met = _tables(windows, [*KEY, "f0", "f1"], reach // 2).join(laid, ["length", "block", "value"])
    d = simhash.distance(F.col("f0"), F.col("i0")) + simhash.distance(F.col("f1"), F.col("i1"))
    return met.where(d <= radius).select(*KEY, "item_id", "item_twin").distinct()


def _anchors(docs: DataFrame, shingles: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(TEXT, length, p, h): where shingles of items stand in the texts, for each length of an item that has them."""
    sizes = [r[0] for r in shingles.select("size").distinct().collect()]  # at most five values
    known = shingles.select("size", "h", "length").distinct()
    bounded = known.limit(BROADCAST_SHINGLES + 1).count() <= BROADCAST_SHINGLES
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    split = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("twin"), words(text, LETTER_WORD).alias("w"))
    found = None
    for size in sizes:
        places = F.when(F.size("w") >= size, F.sequence(F.lit(0), F.size("w") - size))
        rows = split.select(*TEXT, "w", F.explode(places).alias("p"))
        rows = rows.select(*TEXT, "p", F.xxhash64(*[F.get("w", F.col("p") + k) for k in range(size)]).alias("h"))
        some = known.where(F.col("size") == size).select("h", "length")
        met = rows.join(F.broadcast(some) if bounded else some, "h").select(*TEXT, "length", "p", "h")
        found = met if found is None else found.unionByName(met)
    return split.select(*TEXT).limit(0).selectExpr(*TEXT, "0 length", "0 p", "0L h") if found is None else found.distinct()


def _bags(anchors: DataFrame, similarity: float) -> DataFrame:
    """(KEY, h, n): the anchors of each window that can reach the similarity."""
    inside = F.greatest(F.col("length") - (SIZE - 1), F.lit(1))  # shingles of a window
    placed = anchors.select("*", inside.alias("inside"), (F.col("p") / inside).alias("x"))
    # places p to p + inside - 1, in the same frame for every length
    reach = "OVER (PARTITION BY doc_id, twin, length ORDER BY x RANGE BETWEEN CURRENT ROW AND 0.9999999D FOLLOWING)"
    seen = placed.select("*", F.expr(f"count(*) {reach}").alias("many"), F.expr(f"max(p) {reach}").alias("last"))
    before = F.lag("last").over(Window.partitionBy(*TEXT, "length").orderBy("x"))
    seen = seen.select("*", (F.coalesce(before, F.lit(-1)) < F.col("last")).alias("further"))
    laid = seen.where("further").where(F.col("many") >= F.ceil(F.col("inside") * similarity - 1e-9))
    # a window reaches into two cells of its own size at most, so it meets few anchors outside it
    cell = F.floor(F.col("p") / F.col("inside"))
    laid = laid.select(*TEXT, "length", "inside", F.col("p").alias("start"), F.explode(F.array(cell, cell + 1)).alias("cell"))
    met = laid.join(placed.select(*TEXT, "length", "p", "h", cell.alias("cell")), [*TEXT, "length", "cell"])
    met = met.where((F.col("p") >= F.col("start")) & (F.col("p") < F.col("start") + F.col("inside")))
    return met.groupBy(*KEY, "h").agg(F.count("*").alias("n"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(id_col, item_id, similarity, start, length): the best window for each document and leaked item.

    `start` and `length` count words of the document.
    """
    shingles = written(item_shingles(items, item_id, item_text), "benchmark-shingles")
    anchors = written(_anchors(docs, shingles, id_col, text_col), "anchors")
    bags = written(_bags(anchors, similarity), "windows")
    weights = shingles.groupBy("item_id", F.col("twin").alias("item_twin"), "length", "h").agg(F.count("*").alias("n"))
    fps = _both_halves(weights, ["item_id", "item_twin", "length"]).withColumnRenamed("length", "item_length")
    near = near_items(_both_halves(bags, KEY), fps, radius)
    weights = weights.select("item_id", "item_twin", "h", F.col("n").alias("m"))
    overlap = near.join(bags, KEY).join(weights, ["item_id", "item_twin", "h"]).groupBy(*KEY, "item_id", "item_twin").agg(F.sum(F.least("n", "m")).alias("shared"))
    scored = overlap.join(fps.select("item_id", "item_twin", "weight"), ["item_id", "item_twin"])
    scored = scored.withColumn("similarity", F.col("shared") / F.col("weight")).where(F.col("similarity") >= similarity)
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("similarity"), "start", "length")
    out = scored.withColumn("rank", F.row_number().over(best)).where("rank = 1")
    out = out.select(F.col("doc_id").alias(id_col), F.col("item_id").alias(item_id), "similarity", F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length"))
    out = written(out, "leaks")
    for df in (shingles, anchors, bags):
        forget(df)
    return out


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all their columns, that hold no leaked item; rows without an id stay."""
    bad = leaks(docs, items, id_col, text_col).select(id_col).distinct()
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
