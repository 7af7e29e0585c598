"""Token metadata from several sources: the winning fields, the winning extensions, and their merge with what is there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versioned import final_latest, first_wins

#: Later sources win at equal slots.
SOURCES = ("program", "standalone", "embedded")
FIELDS = ("name", "symbol", "uri", "update_authority", "is_mutable", "token_standard", "seller_fee_basis_points", "creators")


def winning_fields(candidates: DataFrame, key: str = "mint", order: Sequence[str] = ("slot", "source_rank", "source_account"), fields: Sequence[str] = FIELDS) -> DataFrame:
    """One row of each key: the greatest of (order, fields) compared in turn, so arrival order plays no part."""
    return final_latest(candidates, [key], order[0], [*order[1:], *fields])


def winning_extensions(candidates: DataFrame, key: str = "mint", slot: str = "slot", text: str = "extensions") -> DataFrame:
    return final_latest(candidates, [key], slot, [text]).select(key, slot, text)


def merged(patches: DataFrame, existing: DataFrame, snapshot_slot: int, key: str = "mint") -> DataFrame:
    """Metadata rows for patched keys: what a patch lacks is taken from the existing row, else a default.

    `patches` has `key`, `has_fields`, FIELDS and `extensions` (null: none). Fields come all from one side.
    """
    old = existing.select(F.col(key).alias("_key"), F.struct(*FIELDS, "extensions").alias("_old"))
    both = patches.join(old, patches[key] == old["_key"], "left")
    empty = {"name": F.lit(""), "symbol": F.lit(""), "uri": F.lit(""), "update_authority": F.lit(""), "is_mutable": F.lit(False), "token_standard": F.lit(None), "seller_fee_basis_points": F.lit(0), "creators": F.array().cast("array<string>")}

    def pick(c: str):
        kind = patches.schema[c].dataType
        previous = F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(empty[c].cast(kind))
        return F.when(F.col("has_fields"), F.col(c)).otherwise(previous).alias(c)

    extensions = F.coalesce("extensions", "_old.extensions", F.lit("[]")).alias("extensions")
    return both.select(key, *[pick(c) for c in FIELDS], extensions, F.lit(snapshot_slot).cast("long").alias("updated_slot"))


def extension_list(rows: DataFrame, key: str, kind: str, position: str, body: str) -> DataFrame:
    """(key, extensions): the first body of each kind, in order of position, as a JSON array."""
    once = first_wins(rows, [key, kind], position)
    ordered = F.array_sort(F.collect_list(F.struct(position, body)))
    text = F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda x: x[body]), ","), F.lit("]"))
    return once.groupBy(key).agg(text.alias("extensions"))
