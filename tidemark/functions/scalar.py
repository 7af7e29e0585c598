"""Scalar functions built from Catalyst expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unit names of readable sizes, each 1024 times the one before.
SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")
#: Labels of token account states.
ACCOUNT_STATES = ("uninitialized", "initialized", "frozen")


def u_le(data: Column, offset: int, size: int) -> Column:
    """An unsigned little-endian integer of `size` bytes at `offset`, exact up to 2^64 - 1, as decimal(20,0)."""
    raw = F.substring(data, offset + 1, size)
    return F.when(F.length(raw) == size, F.conv(_turned(F.hex(raw), size), 16, 10).cast("decimal(20,0)"))


def _turned(text: Column, size: int) -> Column:
    """Hex digits with their bytes in the other order. (reverse() takes binary for UTF-8 and would keep its characters.)"""
    return text if size == 1 else F.regexp_replace(text, "(..)" * size, "".join(f"${k}" for k in range(size, 0, -1)))


def to_u64_le(value: Column) -> Column:
    """Eight little-endian bytes of a non-negative decimal or integer."""
    return F.unhex(_turned(F.lpad(F.conv(value.cast("string"), 10, 16), 16, "0"), 8))


def bytes_at(data: Column, offset: int, size: int) -> Column:
    raw = F.substring(data, offset + 1, size)
    return F.when(F.length(raw) == size, raw)


def key_or_null(key: Column) -> Column:
    """A key of zero bytes stands for none."""
    return F.when(F.hex(key).rlike("[1-9A-F]"), key)


def align8(x: Column) -> Column:
    return (x + 7 - F.pmod(x + 7, F.lit(8))).cast("long")


def minus_saturating(a: Column, b: Column | int) -> Column:
    return F.greatest(a - b, F.lit(0))


def readable_size(n: Column, largest: str = SIZE_UNITS[-1]) -> Column:
    """Bytes (a long) as text: two decimals and a unit of 1024s, `largest` at most. Rounded exactly, ties to even, as C's printf does;
    Java's rounds the shortest decimal form of a double, ties up."""
    names = SIZE_UNITS[: SIZE_UNITS.index(largest) + 1]
    out = F.concat_ws(" ", _hundredths(n, 1024 ** (len(names) - 1)), F.lit(names[-1]))
    for k in range(len(names) - 2, -1, -1):
        out = F.when(n < 1024 ** (k + 1), F.concat_ws(" ", _hundredths(n, 1024**k), F.lit(names[k]))).otherwise(out)
    return F.when(n.isNotNull(), out)


def _hundredths(n: Column, unit: int) -> Column:
    """n / unit with two decimals, by whole numbers."""
    of, div = F.lit(unit).cast("decimal(20,0)"), lambda a, b: F.call_function("div", a, b)
    n = n.cast("decimal(20,0)")
    scaled = (n % of) * 100
    down, twice = div(scaled, of), (scaled % of) * 2
    odd = F.pmod(down, F.lit(2)) == 1
    up = F.when((twice > of) | (twice == of) & odd, 1).otherwise(0)
    total = div(n, of) * 100 + down + up
    return F.when(F.lit(unit) == 1, F.concat(n.cast("string"), F.lit(".00"))).otherwise(F.concat(div(total, F.lit(100)).cast("string"), F.lit("."), F.lpad((total % 100).cast("string"), 2, "0")))


def state_label(state: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, label in enumerate(ACCOUNT_STATES):
        out = F.when(state == k, label).otherwise(out)
    return out


def default_if_empty(x: Column, default: Column) -> Column:
    """`x` unless it is null or the empty text."""
    return F.coalesce(F.nullif(x, F.lit("")), default)


def storage_name(name: Column, part: int) -> Column:
    """Slot (part 1) or file number (part 2) of a storage file's name `<slot>.<number>`; null for other names."""
    return F.regexp_extract(name, r"^(\d+)\.(\d+)$", part).try_cast("long")


def snapshot_kind(source: Column) -> Column:
    """'incremental' or 'full' by the base name; what is neither counts as incremental. A query part is cut off."""
    base = F.element_at(F.split(F.element_at(F.split(source, r"\?"), 1), "/"), -1)
    return F.when(base.startswith("incremental-snapshot-"), "incremental").when(base.startswith("snapshot-"), "full").otherwise("incremental")


def sorting_key(text: Column) -> Column:
    """A sorting key without spaces, brackets and quotes, for comparison."""
    return F.regexp_replace(text, r"[\s()`\"']", "")


def duration(seconds: float) -> str:
    """HH:MM:SS, rounded up; 'unknown' for what is no duration."""
    if not math.isfinite(seconds) or seconds < 0:
        return "unknown"
    s = math.ceil(seconds)
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"


def duration_text(seconds: Column) -> Column:
    s = F.ceil(seconds)
    text = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    bad = seconds.isNull() | F.isnan(seconds) | (seconds < 0) | (seconds == float("inf"))
    return F.when(bad, "unknown").otherwise(text)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part * 100.0 / whole)
