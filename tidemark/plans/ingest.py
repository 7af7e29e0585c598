"""From decoded account records to the rows of the versioned tables.

The key columns of records stay binary until a row is known to be kept: the list of hot mints is matched on bytes, and
base58 text, which needs Python, is made for the survivors only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import decoders
from tidemark.functions.base58 import base58, decode, from_base58
from tidemark.operators import balances, metadata, tombstones
from tidemark.operators.reports import counters
from tidemark.operators.token_info import restrict, token_info
from tidemark.operators.versioned import final_latest
from tidemark.plans.schemas import conform

# The programs that own token accounts, extensible token accounts, and metadata; zero bytes own nothing.
TOKEN, TOKEN_EXT, METADATA = (decode(x) for x in ("TokenkegQfeZyiNwAJbNbGKPFXCWuBvf9Ss623VQ5DA", "TokenzQdBNbLqP5VEhdkAS6EPFLC1PHnBqCXEpPxuEb", "metaqbxxUerdq28cj1RbAWkYQm3ybzjb6a8bt518x1s"))
DEFAULT_OWNER = bytes(32)


def _is(column: str, key: bytes) -> Column:
    return F.col(column) == F.lit(key)


def route(records: DataFrame) -> DataFrame:
    """Adds `route` (token, token_ext, metadata, other) and the decoded `account` and `mint_row`, null where not such."""
    token, ext = _is("owner", TOKEN), _is("owner", TOKEN_EXT)
    name = F.when(token, "token").when(ext, "token_ext").when(_is("owner", METADATA), "metadata").otherwise("other")
    account, mint = (read(F.col("data"), token, ext) for read in (decoders.routed_account, decoders.routed_mint))
    return records.withColumns({"route": name, "account": account, "mint_row": mint})


@dataclass
class Ingested:
    """The rows of one checkpoint, lazily."""

    raw_account: DataFrame
    mints: DataFrame
    state: DataFrame
    field_candidates: DataFrame
    extension_candidates: DataFrame
    close_candidates: DataFrame
    stats: DataFrame


def raw_accounts(records: DataFrame, snapshot_slot: int) -> DataFrame:
    """Every account as it stands, the payload left out."""
    rows = records.select(base58("pubkey").alias("pubkey"), base58("owner").alias("owner"), "lamports", "data_len", "executable", F.lit(snapshot_slot).cast("long").alias("updated_slot"))
    return conform(rows, "raw_account")


def ingest(records: DataFrame, hot: DataFrame, snapshot_slot: int, kind: str) -> Ingested:
    """`hot`: column mint, base58. `kind`: full or incremental; a full one leaves accounts without balance out."""
    keys = hot.select(from_base58("mint").alias("mint_key")).where("mint_key IS NOT NULL")
    rows = route(records)
    here = F.lit(snapshot_slot).cast("long").alias("updated_slot")

    accounts = restrict(rows.where("account IS NOT NULL").select("slot", "pubkey", "account", F.col("account.mint").alias("mint_key")), keys, "mint_key")
    if kind == "full":
        accounts = accounts.where(F.col("account.amount") > 0)
    text = lambda c: base58(c)
    state = accounts.select(
        text("pubkey").alias("pubkey"), text("account.mint").alias("mint"), text("account.owner").alias("owner"), F.col("account.amount").alias("amount"), text("account.delegate").alias("delegate"),
        F.col("account.delegated_amount").alias("delegated_amount"), F.col("account.state").alias("state"), text("account.close_authority").alias("close_authority"), F.lit(0).alias("is_deleted"), F.col("slot").alias("updated_slot"),
    )

    own = restrict(rows.where("account IS NULL AND mint_row IS NOT NULL").withColumn("mint_key", F.col("pubkey")), keys, "mint_key")
    mints = own.select(text("pubkey").alias("mint"), text("mint_row.mint_authority").alias("mint_authority"), F.col("mint_row.supply").alias("supply"), F.col("mint_row.decimals").alias("decimals"), F.col("mint_row.is_initialized").alias("is_initialized"), text("mint_row.freeze_authority").alias("freeze_authority"), here)

    # extensions of mints, and what they say of the token's name
    ext = own.where("route = 'token_ext'").select("slot", text("pubkey").alias("mint"), decoders.mint_extensions("data").alias("x")).where("NOT x.failed")
    extension_candidates = ext.select("mint", "slot", F.col("x.extensions").alias("extensions"))
    embedded = ext.where("x.metadata.mint = mint").select(*_fields("x.metadata", "slot", 2, F.col("mint")))
    lone = rows.where("route = 'token_ext' AND account IS NULL AND mint_row IS NULL").select("slot", text("pubkey").alias("source_account"), decoders.standalone_metadata("data").alias("m"))
    lone = lone.where("m.mint IS NOT NULL").select(*_fields("m", "slot", 1, F.col("source_account")))
    program = rows.where("route = 'metadata'").select("slot", text("pubkey").alias("source_account"), decoders.metadata_account("data").alias("m")).where("m.mint IS NOT NULL")
    program = program.select(
        F.col("m.mint").alias("mint"), "slot", F.lit(0).alias("source_rank"), "source_account", *[F.col(f"m.{c}").alias(c) for c in ("name", "symbol", "uri", "update_authority", "is_mutable", "token_standard", "seller_fee_basis_points", "creators")]
    )
    candidates = restrict(program.unionByName(embedded).unionByName(lone), hot, "mint")

    empty = tombstones.canonical_empty(F.col("data_len"), F.col("lamports"), _is("owner", DEFAULT_OWNER), F.col("executable"))
    unread = (F.col("route") == "token") & (F.length("data") == decoders.ACCOUNT_LEN) & F.col("account").isNull()
    unread_ext = (F.col("route") == "token_ext") & F.col("account").isNull() & F.col("mint_row").isNull() & decoders.standalone_metadata("data")["mint"].isNull()
    closing = rows.where((F.col("lamports") == 0) & (empty | unread)).select("slot", "pubkey", "lamports").unionByName(rows.where((F.col("lamports") == 0) & unread_ext).select("slot", "pubkey", "lamports"))
    closing = tombstones.close_candidates(closing).select(text("pubkey").alias("pubkey"), "slot")

    stats = rows.agg(
        *counters(
            {
                "accounts": F.lit(True), "token_accounts": F.col("account").isNotNull() & (F.col("route") == "token"), "token_ext_accounts": F.col("account").isNotNull() & (F.col("route") == "token_ext"),
                "token_owner_seen": F.col("route") == "token", "token_ext_owner_seen": F.col("route") == "token_ext",
                "token_ext_unexpected_size": (F.col("route") == "token_ext") & (F.length("data") < decoders.MINT_LEN),
                "token_ext_unpack_failed": (F.col("route") == "token_ext") & (F.length("data") >= decoders.MINT_LEN) & F.col("account").isNull() & F.col("mint_row").isNull(),
                "close_candidates": (F.col("lamports") == 0) & (empty | unread), "mints": F.col("mint_row").isNotNull() & F.col("account").isNull(), "metadata_accounts": F.col("route") == "metadata", "unpack_failed": unread,
                "unexpected_size": (F.col("route") == "token") & ~F.length("data").isin(decoders.ACCOUNT_LEN, decoders.MINT_LEN), "zero_balance": F.col("account.amount") == 0, "canonical_empty": empty, "other": F.col("route") == "other",
            }
        )
    )
    return Ingested(raw_accounts(records, snapshot_slot), conform(mints, "raw_token_mint"), conform(state, "hot_token_account_state"), candidates, extension_candidates, closing, stats)


def _fields(at: str, slot: str, rank: int, source: Column) -> list[Column]:
    """A metadata value's fields; it has no standard, fee or creators, and is mutable while somebody may update it."""
    return [
        F.col(f"{at}.mint").alias("mint"), F.col(slot).alias("slot"), F.lit(rank).alias("source_rank"), source.alias("source_account"), *[F.col(f"{at}.{c}").alias(c) for c in ("name", "symbol", "uri")],
        F.coalesce(f"{at}.update_authority", F.lit("")).alias("update_authority"), F.col(f"{at}.update_authority").isNotNull().alias("is_mutable"), F.lit(None).cast("short").alias("token_standard"),
        F.lit(0).alias("seller_fee_basis_points"), F.array().cast("array<string>").alias("creators"),
    ]


def metadata_rows(got: Ingested, existing: DataFrame, snapshot_slot: int) -> DataFrame:
    """The metadata table's new rows: winners of this checkpoint laid over what there is."""
    fields = metadata.winning_fields(got.field_candidates).drop("slot", "source_rank", "source_account").withColumn("has_fields", F.lit(True))
    extensions = metadata.winning_extensions(got.extension_candidates).select("mint", "extensions")
    patches = fields.join(extensions, "mint", "full").withColumn("has_fields", F.coalesce("has_fields", F.lit(False)))
    return conform(metadata.merged(patches, existing, snapshot_slot), "raw_token_metadata")


def full_load(records: DataFrame, hot: DataFrame, snapshot_slot: int, empty_metadata: DataFrame) -> dict[str, DataFrame]:
    """All tables of a new generation."""
    got = ingest(records, hot, snapshot_slot, "full")
    meta = metadata_rows(got, empty_metadata, snapshot_slot)
    return {
        "raw_account": got.raw_account, "raw_token_mint": got.mints, "raw_token_metadata": meta, "hot_token_account_state": got.state,
        "hot_wallet_token_balance": conform(balances.full_balances(got.state), "hot_wallet_token_balance"), "hot_token_info": conform(token_info(hot, got.mints, meta), "hot_token_info"),
    }


def fan_out(records: DataFrame, above: dict[str, int | None]) -> dict[str, DataFrame]:
    """The records of one checkpoint for several lanes: those of slots above what each has seen (None: all)."""
    return {lane: records if slot is None else records.where(F.col("slot") > slot) for lane, slot in above.items()}


def repaired_tombstones(records: DataFrame, state: DataFrame) -> DataFrame:
    """The tombstones that a checkpoint's closed accounts call for in a state that missed them; nothing else is loaded."""
    empty = tombstones.canonical_empty(F.col("data_len"), F.col("lamports"), _is("owner", DEFAULT_OWNER), F.col("executable"))
    closing = tombstones.close_candidates(records.where((F.col("lamports") == 0) & empty).select("slot", "pubkey", "lamports"))
    return conform(tombstones.tombstones(closing.select(base58("pubkey").alias("pubkey"), "slot"), state), "hot_token_account_state")


def read_stats(records: DataFrame) -> dict[str, int]:
    """What a checkpoint held, for the log: storage files, records, those without lamports."""
    row = records.agg(F.count_distinct("slot", "file_id").alias("files"), F.count("*").alias("accounts"), F.count_if(F.col("lamports") == 0).alias("without_lamports")).first()
    return row.asDict()


def incremental_load(records: DataFrame, hot: DataFrame, snapshot_slot: int, tables: dict[str, DataFrame], by_pair: DataFrame | None = None) -> dict[str, DataFrame]:
    """The rows to append for an incremental checkpoint. `hot` is the generation's frozen list, whatever the list is now.

    State and tombstones come first; balances are then computed for the touched pairs over old and new state together.
    The display table is a full load's business. `by_pair`: the state's copy that is sorted by pairs, to read them from.
    """
    got = ingest(records, hot, snapshot_slot, "incremental")
    known = final_latest(tables["raw_token_metadata"], ["mint"], "updated_slot")
    gone = conform(tombstones.tombstones(got.close_candidates, tables["hot_token_account_state"].unionByName(got.state)), "hot_token_account_state")
    state = got.state.unionByName(gone)
    pairs = balances.affected_pairs(got.state, gone)
    old = tables["hot_token_account_state"] if by_pair is None else by_pair
    refreshed = balances.refreshed_balances(old.unionByName(state), pairs, snapshot_slot)
    return {
        "raw_account": got.raw_account, "raw_token_mint": got.mints, "raw_token_metadata": metadata_rows(got, known, snapshot_slot),
        "hot_token_account_state": state, "hot_wallet_token_balance": conform(refreshed, "hot_wallet_token_balance"),
    }
