"""Hamming search by permuted block tables, with DataFrame operations only.

64 bits are cut into `radius + spare` blocks. Fingerprints within `radius` of each other agree on at least `spare`
blocks; for every choice of `spare` blocks there is one table, whose key is those blocks' bits (the permutation that
brings them to the front). Whatever is within the radius meets in a table, and the complete distance is verified.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.simhash import distance


def blocks(count: int, bits: int = 64) -> list[tuple[int, int]]:
    """(first bit, width) of `count` blocks as even as they can be."""
    edges = [round(i * bits / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _mask(first: int, width: int) -> int:
    m = ((1 << width) - 1) << first
    return m - (1 << 64) if m >= 1 << 63 else m


def table_keys(fp: Column, radius: int, spare: int = 2) -> Column:
    """An array with (table, key) for each table."""
    cut = blocks(radius + spare)
    out = []
    for number, chosen in enumerate(combinations(cut, spare)):
        mask = 0
        for first, width in chosen:
            mask |= _mask(first, width)
        out.append(F.struct(F.lit(number).alias("table"), fp.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*out)


def matches(queries: DataFrame, entries: DataFrame, radius: int, spare: int = 2) -> DataFrame:
    """(query, fp, distance): for every different fingerprint in `queries.fp`, all different ones of `entries.fp` within `radius`.

    Both sides are made distinct first, so copies cost nothing; the caller joins its rows to the classes. A join by
    (table, key) follows, whose large keys adaptive execution splits.
    """
    q = queries.select(F.col("fp").alias("query")).where(F.col("query").isNotNull()).distinct()
    e = entries.select("fp").where(F.col("fp").isNotNull()).distinct()
    q = q.select("query", F.explode(table_keys(F.col("query"), radius, spare)).alias("at")).select("query", "at.table", "at.key")
    e = e.select("fp", F.explode(table_keys(F.col("fp"), radius, spare)).alias("at")).select("fp", "at.table", "at.key")
    found = q.join(e, ["table", "key"]).withColumn("distance", distance(F.col("query"), F.col("fp")))
    return found.where(F.col("distance") <= radius).select("query", "fp", "distance").distinct()
