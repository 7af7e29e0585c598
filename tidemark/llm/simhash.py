"""SimHash with built-in expressions only: one row for each term, votes summed in packed lanes.

A 64-bit term hash votes on 64 bits. Bit i and bit i + 32 share a long: ``(h >> i) & 0x100000001`` puts one in each
half, so 32 ordinary sums count all 64 bits (up to 2^31 terms of a text) inside whole-stage code generation, with
partial sums before the shuffle. No array of votes and no Python is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAIR = 0x0000000100000001
_LOW = 0xFFFFFFFF


def term_rows(df: DataFrame, keep: list[str], words: str, size: int) -> DataFrame:
    """A row for each shingle of `size` consecutive words, repeats included: `keep`, `_i` (its place) and `words`.

    Fewer words make one row of what there is; none make one row whose shingle is empty. The array itself stays one
    reference while rows are generated, it isn't copied.
    """
    n = F.greatest(F.size(words) - size, F.lit(0))
    return df.select(*keep, words, F.explode(F.sequence(F.lit(0), n)).alias("_i"))


def shingle(words: str, size: int) -> list[Column]:
    return [F.get(F.col(words), F.col("_i") + k) for k in range(size)]


def vote_sums(h: Column, name: str = "_v") -> list[Column]:
    return [F.sum(F.shiftright(h, i).bitwiseAND(F.lit(_PAIR))).alias(f"{name}{i}") for i in range(32)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def majority(n: Column, name: str = "_v") -> Column:
    """The fingerprint as a long: a bit is set if over half of `n` terms set it.

    A loop over an array, as 64 spelled-out conditions would make code that the driver and each executor must hold.
    """
    over = lambda v, place: F.when(v * 2 > n, _bit(place)).otherwise(F.lit(0).cast("long"))
    both = F.transform(F.array(*[f"{name}{i}" for i in range(32)]), lambda v, i: over(v.bitwiseAND(F.lit(_LOW)), i).bitwiseOR(over(F.shiftright(v, 32), i + 32)))
    return F.aggregate(both, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def flips(fp: Column) -> Column:
    """All 64 fingerprints that differ in one bit."""
    return F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: fp.bitwiseXOR(_bit(i)))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def distance(a: Column, b: Column) -> Column:
    """Differing bits of two fingerprints."""
    return F.bit_count(a.bitwiseXOR(b))
