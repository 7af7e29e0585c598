"""More of the query catalogue: byte layouts, sources and sinks, generations, the watch and the stream.

Files that these queries need are made of the general tables and lie in the folder that all executors reach.
"""

from __future__ import annotations

import os
import struct
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import decoders, scalar
from tidemark.functions.base58 import from_base58
from tidemark.operators import balances, token_info
from tidemark.operators.reports import table_gaps
from tidemark.plans import ingest, schemas
from tidemark.plans.catalogue import _FULL, _checkpoint, _hex, _hot, _key, archives, cents, once, query, t
from tidemark.plans.generations import Store
from tidemark.sources import archive, discovery, lists, manifest, paths, programs, records
from tidemark.streaming import stream
from tidemark.streaming.watch import Watch


def workspace(spark: SparkSession, name: str) -> str:
    """A folder of its own where all executors can read and write."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    at = paths.join(base, f"{name}-{uuid.uuid4().hex}")
    at = unquote(urlsplit(at).path) if at.startswith("file:") else at
    paths.make(spark, at)
    return at


def hexed(c: str | Column) -> Column:
    return F.lower(F.hex(c))


def raw(text: str) -> Column:
    return F.unhex(F.lit(text))


def le(value: Column, size: int) -> Column:
    """The low bytes of a number, little-endian."""
    return F.substring(scalar.to_u64_le(value), 1, size)


ZERO_KEY = "00" * 32


def account_data(mint: Column, owner: Column, amount: Column) -> Column:
    return F.concat(mint, owner, scalar.to_u64_le(amount), raw("00" * 36 + "01" + "00" * 12 + "00" * 8 + "00" * 36))


def mint_data(supply: Column, decimals: Column) -> Column:
    return F.concat(raw("00" * 36), scalar.to_u64_le(supply), le(decimals, 1), raw("01" + "00" * 36))


def text_data(text: Column) -> Column:
    body = text.cast("binary")
    return F.concat(le(F.length(body), 4), body)


# --- layouts ---------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1) THEN 'account' WHEN o_orderkey % 8 IN (3, 4) THEN 'mint' ELSE 'none' END AS kind FROM orders")
def extensible_layouts(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    account = account_data(_key("m", "o_custkey"), _key("w", "o_orderkey"), cents("o_totalprice"))
    mint = mint_data(cents("o_totalprice"), F.lit(6))
    padded = F.concat(mint, raw("00" * 83))
    forms = [account, F.concat(account, raw("02")), F.concat(account, raw("01")), mint, F.concat(padded, raw("01" + "09000000")), F.concat(padded, raw("02")), F.concat(account, raw("02" + "00" * 189)), F.substring(account, 1, 100)]
    data = F.lit(None).cast("binary")
    for k, form in enumerate(forms):
        data = F.when(F.col("o_orderkey") % 8 == k, form).otherwise(data)
    rows = o.select("o_orderkey", once(data, lambda d: F.struct(decoders.extended_account(d).isNotNull().alias("a"), decoders.extended_mint(d).isNotNull().alias("m"))).alias("is"))
    return rows.select("o_orderkey", F.when(F.col("is.a"), "account").when(F.col("is.m"), "mint").otherwise("none").alias("kind"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE '[{"extension":"nonTransferable","state":{}},{"extension":"defaultAccountState","state":{"accountState":"' || CASE p_size % 3 WHEN 0 THEN 'uninitialized' WHEN 1 THEN 'initialized' ELSE 'frozen' END || '"}}'
    || CASE WHEN p_partkey % 4 = 1 THEN ',{"extension":"mintCloseAuthority","state":{"closeAuthority":null}}' ELSE '' END || ']' END AS extensions, p_partkey % 4 = 3 AS failed, p_partkey % 4 = 2 AS warned FROM part"""
)
def mint_extensions_json(spark, sf_dir):
    part = F.col("p_partkey") % 4
    entry = lambda kind, value: F.concat(raw(struct.pack("<H", kind).hex()), le(F.length(value), 2), value)
    state = le(F.col("p_size") % 3, 1)
    # the second state is passed over, and so is the unknown type; a close authority of one byte is a warning
    tail = F.when(part == 1, entry(3, raw(ZERO_KEY))).when(part == 2, entry(3, raw("01"))).when(part == 3, raw("0600ff00")).otherwise(raw("0000ffff"))
    data = F.concat(mint_data(cents("p_retailprice"), F.lit(2)), raw("00" * 83 + "01"), entry(9, raw("")), entry(6, state), entry(6, raw("01")), entry(99, raw("abcd")), tail)
    rows = t(spark, sf_dir, "part").select("p_partkey", decoders.mint_extensions(data).alias("x"), (part == 3).alias("cut"))
    return rows.select("p_partkey", "x.extensions", "x.failed", (~F.col("x.failed") & F.col("x.warnings").isNotNull()).alias("warned"))


@query(
    """SELECT p_partkey, sha256('m' || p_partkey) AS mint, p_name AS name, p_brand AS symbol, p_type AS uri, CASE WHEN p_partkey % 2 = 0 THEN sha256('u' || p_size) END AS update_authority
    FROM part WHERE p_partkey % 5 <> 4"""
)
def metadata_values(spark, sf_dir):
    authority = F.when(F.col("p_partkey") % 2 == 0, _key("u", "p_size")).otherwise(raw(ZERO_KEY))
    name = F.when(F.col("p_partkey") % 5 == 4, raw("02000000c328")).otherwise(text_data(F.col("p_name")))  # no UTF-8
    data = F.concat(authority, _key("m", "p_partkey"), name, text_data(F.col("p_brand")), text_data(F.col("p_type")), raw("01000000"), text_data(F.lit("key")), text_data(F.lit("value")))
    rows = t(spark, sf_dir, "part").select("p_partkey", decoders.standalone_metadata(data).alias("m")).where("m.mint IS NOT NULL")
    return rows.select("p_partkey", hexed(from_base58("m.mint")).alias("mint"), "m.name", "m.symbol", "m.uri", hexed(from_base58("m.update_authority")).alias("update_authority"))


@query(
    """SELECT p_partkey, sha256('m' || p_partkey) AS mint, p_name AS name, p_size AS fee, CAST(CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 0 END AS BIGINT) AS creators, p_partkey % 2 = 1 AS is_mutable, CAST(CASE WHEN p_partkey % 7 <> 0 THEN 4 END AS SMALLINT) AS token_standard
    FROM part WHERE p_partkey % 11 <> 0"""
)
def metadata_accounts(spark, sf_dir):
    key = F.col("p_partkey")
    one = F.concat(_key("c", "p_size"), raw("0132"))
    creators = F.when(key % 3 == 0, F.concat(raw("0102000000"), one, one)).otherwise(raw("00"))
    tail = F.when(key % 7 != 0, raw("0001040000")).otherwise(raw(""))  # what is cut off at the end is none
    data = F.concat(
        F.when(key % 11 != 0, raw("04")).otherwise(raw("05")), _key("u", "p_size"), _key("m", "p_partkey"), text_data(F.col("p_name")), text_data(F.col("p_brand")), text_data(F.col("p_type")),
        le(F.col("p_size"), 2), creators, raw("00"), le(key % 2, 1), tail,
    )
    rows = t(spark, sf_dir, "part").select("p_partkey", "p_size", decoders.metadata_account(data).alias("m")).where("m.mint IS NOT NULL")
    fee = F.col("m.seller_fee_basis_points").cast(rows.schema["p_size"].dataType).alias("fee")
    return rows.select("p_partkey", hexed(from_base58("m.mint")).alias("mint"), "m.name", fee, F.size("m.creators").cast("long").alias("creators"), "m.is_mutable", "m.token_standard")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN sha256('k' || o_orderkey) END AS key, CASE WHEN o_custkey % 4 <> 0 THEN o_orderkey * 100.0 / (o_custkey % 4) END AS percent FROM orders")
def optional_values(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 3 == 0, raw(ZERO_KEY)).otherwise(_key("k", "o_orderkey"))
    return t(spark, sf_dir, "orders").select("o_orderkey", hexed(scalar.key_or_null(key)).alias("key"), scalar.percent(F.col("o_orderkey"), F.col("o_custkey") % 4).alias("percent"))


_OPERATIONS = "VALUES " + ", ".join(f"('{n}', {v})" for n, v in (("ADD", 0x00), ("SUB", 0x10), ("MUL", 0x20), ("DIV", 0x30), ("OR", 0x40), ("AND", 0x50), ("LSH", 0x60), ("RSH", 0x70)))


@query(
    f"""WITH names AS (SELECT op + kind + how AS opcode, name || bits || '_' || source AS mnemonic FROM ({_OPERATIONS}) o(name, op), (VALUES ('32', 4), ('64', 7)) k(bits, kind), (VALUES ('IMM', 0), ('REG', 8)) s(source, how)),
    seen AS (SELECT c_nationkey AS program, opcode FROM customer JOIN names ON c_custkey % 128 = opcode UNION ALL SELECT c_nationkey, 255 FROM customer WHERE c_custkey % 128 = 1)
    SELECT printf('0x%02x', seen.opcode) AS opcode, coalesce(mnemonic, 'invalid') AS mnemonic, count(DISTINCT program) AS num_programs, count(*) AS num_insns FROM seen LEFT JOIN names ON names.opcode = seen.opcode GROUP BY 1, 2"""
)
def opcode_names(spark, sf_dir):
    own = [v | kind | how for v in range(0, 0x80, 0x10) for kind in (4, 7) for how in (0, 8)]
    code = F.col("c_custkey") % 128
    opcode = F.when(code.isin(own), code).when(code == 1, 255).cast("int")
    counts = t(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("program"), opcode.alias("opcode")).where("opcode IS NOT NULL")
    return programs.histogram(counts.groupBy("program", "opcode").agg(F.count("*").alias("n")))


@query(
    """SELECT printf('0x%02x', op) AS opcode, CASE op WHEN 7 THEN 'ADD64_IMM' WHEN 24 THEN 'LD_DW_IMM' WHEN 149 THEN 'EXIT' ELSE 'invalid' END AS mnemonic, count(DISTINCT c_custkey) AS num_programs, count(*) AS num_insns
    FROM (SELECT c_custkey, unnest([CASE c_custkey % 2 WHEN 0 THEN 7 ELSE 255 END, 24, 149]) AS op FROM customer) GROUP BY op"""
)
def program_opcodes(spark, sf_dir):
    names = b"\0.text\0.names\0"
    size = 8 + 16 + 8
    head = bytearray(64)
    head[:6] = b"\x7fELF\x02\x01"
    struct.pack_into("<Q", head, 0x28, 64 + size + len(names))
    struct.pack_into("<HHH", head, 0x3A, 64, 3, 2)
    section = lambda at, offset, n: struct.pack("<IIQQQQ", at, 0, 0, 0, offset, n) + bytes(24)
    tail = names + section(0, 0, 0) + section(1, 64, size) + section(7, 64 + size, len(names))
    first = F.when(F.col("c_custkey") % 2 == 0, raw("07")).otherwise(raw("ff"))
    elf = F.concat(raw(head.hex()), first, raw("00" * 7), raw("18" + "00" * 15), raw("95" + "00" * 7), raw(tail.hex()))
    rows = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("program"), elf.alias("content"))
    return programs.histogram(programs.instruction_counts(rows))


# --- rows of the tables ----------------------------------------------------------------------------------------------


def _orders_checkpoint(spark, sf_dir) -> DataFrame:
    """Every order an account; of each, one in seven is closed."""
    return _checkpoint(t(spark, sf_dir, "orders"), F.col("o_orderkey") % 90 + 1, F.col("o_orderkey") % 7 == 0, F.when(F.col("o_orderstatus") == "P", 0).otherwise(cents("o_totalprice")))


@query(
    """SELECT sha256('k' || o_orderkey) AS pubkey, o_orderkey % 7 = 0 AS closed, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 165 END AS BIGINT) AS data_len, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END AS BIGINT) AS lamports, CAST(100 AS BIGINT) AS updated_slot FROM orders"""
)
def raw_account_rows(spark, sf_dir):
    rows = ingest.raw_accounts(_orders_checkpoint(spark, sf_dir), 100)
    return rows.select(hexed(from_base58("pubkey")).alias("pubkey"), (F.col("owner") == "1" * 32).alias("closed"), "data_len", F.col("lamports").cast("long").alias("lamports"), "updated_slot")


@query(
    """SELECT count(*) AS accounts, count(*) FILTER (o_orderkey % 7 <> 0) AS token_owner_seen, count(*) FILTER (o_orderkey % 7 <> 0) AS token_accounts, count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderstatus = 'P') AS zero_balance,
    count(*) FILTER (o_orderkey % 7 = 0) AS canonical_empty, count(*) FILTER (o_orderkey % 7 = 0) AS close_candidates, count(*) FILTER (o_orderkey % 7 = 0) AS other, CAST(0 AS BIGINT) AS mints, CAST(0 AS BIGINT) AS unpack_failed, CAST(0 AS BIGINT) AS unexpected_size FROM orders"""
)
def checkpoint_stats(spark, sf_dir):
    stats = ingest.ingest(_orders_checkpoint(spark, sf_dir), _hot(spark), 100, "full").stats
    return stats.select("accounts", "token_owner_seen", "token_accounts", "zero_balance", "canonical_empty", "close_candidates", "other", "mints", "unpack_failed", "unexpected_size")


@query(
    """SELECT 'full' AS kind, count(*) FILTER (o_orderstatus <> 'P') AS kept FROM orders WHERE o_orderkey % 7 <> 0 AND o_custkey % 50 < 25
    UNION ALL SELECT 'incremental', count(*) FROM orders WHERE o_orderkey % 7 <> 0 AND o_custkey % 50 < 25"""
)
def zero_balance_policy(spark, sf_dir):
    found = _orders_checkpoint(spark, sf_dir)
    one = lambda kind: ingest.ingest(found, _hot(spark), 100, kind).state.agg(F.count("*").alias("kept")).select(F.lit(kind).alias("kind"), "kept")
    return one("full").unionByName(one("incremental"))


def _records_of(rows: DataFrame, slot: Column, file_id: Column, offset: Column, pubkey: Column, owner: Column, data: Column) -> DataFrame:
    rows = rows.select(
        slot.cast("long").alias("slot"), file_id.cast("long").alias("file_id"), offset.cast("long").alias("offset"), pubkey.alias("pubkey"), F.lit(1).cast("decimal(20,0)").alias("lamports"),
        F.lit(0).cast("decimal(20,0)").alias("rent_epoch"), owner.alias("owner"), F.lit(False).alias("executable"), raw(ZERO_KEY).alias("hash"), data.alias("data"),
    )
    return records.through_files(rows)


@query(
    """SELECT sha256('m' || p_partkey) AS mint, CAST(round(p_retailprice * 100) AS BIGINT) AS supply, CAST(p_size AS SMALLINT) AS decimals, CAST(100 AS BIGINT) AS updated_slot FROM part WHERE p_partkey < 25 AND p_partkey % 5 <> 4"""
)
def mint_rows(spark, sf_dir):
    plain = mint_data(cents("p_retailprice"), F.col("p_size"))
    # one in five is of no mint's length, one in five of the extensible program
    data = F.when(F.col("p_partkey") % 5 == 4, F.concat(plain, raw("00"))).when(F.col("p_partkey") % 5 == 3, F.concat(plain, raw("00" * 83 + "01"))).otherwise(plain)
    owner = F.when(F.col("p_partkey") % 5 == 3, F.lit(ingest.TOKEN_EXT)).otherwise(F.lit(ingest.TOKEN))
    found = _records_of(t(spark, sf_dir, "part"), F.lit(90), F.col("p_partkey") % 3, F.col("p_partkey"), _key("m", "p_partkey"), owner, data)
    rows = ingest.ingest(found, _hot(spark), 100, "full").mints
    return rows.select(hexed(from_base58("mint")).alias("mint"), F.col("supply").cast("long").alias("supply"), "decimals", "updated_slot")


@query("SELECT sha256('m' || p_partkey) AS mint, p_name AS name, p_brand AS symbol, false AS is_mutable, CAST(100 AS BIGINT) AS updated_slot FROM part WHERE p_partkey < 25 AND p_partkey % 2 = 0")
def embedded_metadata(spark, sf_dir):
    value = F.concat(raw(ZERO_KEY), _key("m", "p_partkey"), text_data(F.col("p_name")), text_data(F.col("p_brand")), text_data(F.lit("u")), raw("00000000"))
    # half of the values name another mint than the one they stand in
    other = F.concat(raw(ZERO_KEY), _key("x", "p_partkey"), text_data(F.col("p_name")), text_data(F.col("p_brand")), text_data(F.lit("u")), raw("00000000"))
    own = F.when(F.col("p_partkey") % 2 == 0, value).otherwise(other)
    data = F.concat(mint_data(cents("p_retailprice"), F.col("p_size")), raw("00" * 83 + "01" + "1300"), le(F.length(own), 2), own)
    found = _records_of(t(spark, sf_dir, "part"), F.lit(90), F.col("p_partkey") % 3, F.col("p_partkey"), _key("m", "p_partkey"), F.lit(ingest.TOKEN_EXT), data)
    got = ingest.ingest(found, _hot(spark), 100, "full")
    rows = ingest.metadata_rows(got, spark.createDataFrame([], schemas.TABLES["raw_token_metadata"]), 100).where("name <> ''")
    return rows.select(hexed(from_base58("mint")).alias("mint"), "name", "symbol", "is_mutable", "updated_slot")


@query(
    """WITH m AS (SELECT o_custkey AS mint, o_orderkey AS slot, o_orderkey % 10 AS decimals FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
    d AS (SELECT c_custkey AS mint, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE c_mktsegment END AS extensions, c_custkey % 100 AS slot FROM customer WHERE c_custkey % 3 <> 0)
    SELECT CAST(c_custkey AS VARCHAR) AS mint, CAST(coalesce(decimals, 0) AS SMALLINT) AS decimals, coalesce(d.name, '') AS name, coalesce(nullif(d.extensions, ''), '[]') AS extensions, coalesce(m.slot, 0) AS mint_updated_slot, coalesce(d.slot, 0) AS metadata_updated_slot,
    greatest(coalesce(m.slot, 0), coalesce(d.slot, 0)) AS updated_slot FROM customer LEFT JOIN m ON m.mint = c_custkey LEFT JOIN d ON d.mint = c_custkey"""
)
def token_info_rows(spark, sf_dir):
    c, o = t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders")
    mint = F.col("c_custkey").cast("string").alias("mint")
    mints = o.select(F.col("o_custkey").cast("string").alias("mint"), (F.col("o_orderkey") % 10).cast("short").alias("decimals"), F.lit(1).cast("decimal(20,0)").alias("supply"), F.col("o_orderkey").alias("updated_slot"))
    empty = [F.lit("").alias(x) for x in ("symbol", "uri")]
    extensions = F.when(F.col("c_nationkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")).alias("extensions")
    meta = c.where("c_custkey % 3 <> 0").select(mint, F.col("c_name").alias("name"), *empty, F.lit(None).cast("short").alias("token_standard"), extensions, (F.col("c_custkey") % 100).alias("updated_slot"))
    rows = token_info.token_info(c.select(mint).unionByName(c.select(mint)), mints, meta)
    return rows.select("mint", "decimals", "name", "extensions", "mint_updated_slot", "metadata_updated_slot", "updated_slot")


# --- sources and sinks -----------------------------------------------------------------------------------------------


def _storage_files(spark, sf_dir) -> list[tuple[int, int, bytes]]:
    """(slot, file id, content) of a few storage files of customers; each has 64 bytes too many."""
    rows = t(spark, sf_dir, "customer").where("c_custkey < 200").orderBy("c_custkey").collect()
    files: dict[tuple[int, int], list] = {}
    for r in rows:
        key = r.c_custkey.to_bytes(32, "big")
        files.setdefault((r.c_custkey % 5, r.c_nationkey % 2), []).append((key, r.c_custkey, 0, key, False, bytes(32), b"x" * (r.c_custkey % 50)))
    return [(slot, number, records.pack(found) + bytes(136)) for (slot, number), found in files.items()]


_CUSTOMER_RECORDS = "SELECT c_custkey % 5 AS slot, c_nationkey % 2 AS file_id, c_custkey AS lamports, CAST(c_custkey % 50 AS BIGINT) AS data_len FROM customer WHERE c_custkey < 200"


def _listed(rows: DataFrame) -> DataFrame:
    return rows.select("slot", "file_id", F.col("lamports").cast("long").alias("lamports"), "data_len")


@query(f"SELECT * FROM ({_CUSTOMER_RECORDS}) WHERE slot > 1")
def archive_records(spark, sf_dir):
    files = _storage_files(spark, sf_dir)
    path = os.path.join(workspace(spark, "archive"), "snapshot-9-x.tar.zst")
    archive.write_archive(path, 9, files, manifest.body(9, [(s, i, len(b) - 136) for s, i, b in files]))
    return _listed(archive.read_checkpoint(spark, path, min_slot=1)[0])


@query(_CUSTOMER_RECORDS)
def directory_records(spark, sf_dir):
    files = _storage_files(spark, sf_dir)
    at = workspace(spark, "directory")
    for folder in ("accounts", "snapshots/9"):
        os.makedirs(os.path.join(at, folder))
    for name, content in [("snapshots/status_cache", b""), ("snapshots/9/9", manifest.body(9, [(s, i, len(b) - 136) for s, i, b in files])), *((f"accounts/{s}.{i}", b) for s, i, b in files)]:
        with open(os.path.join(at, name), "wb") as f:
            f.write(content)
    return _listed(archive.read_checkpoint(spark, at)[0])


@query("SELECT c_name AS mint, CAST(1 AS TINYINT) AS enable, CAST(1 AS BIGINT) AS version FROM customer")
def hot_list(spark, sf_dir):
    at = workspace(spark, "hot")
    t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("n"), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("address")).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(paths.join(at, "csv"))
    lists.append_hot(lists.read_hot_csv(spark, paths.join(at, "csv")), paths.join(at, "table"))
    return lists.read_hot(spark, paths.join(at, "table"))


@query("SELECT DISTINCT o_orderpriority || (o_custkey % 100) AS mint FROM orders")
def frozen_list(spark, sf_dir):
    at = paths.join(workspace(spark, "frozen"), "list")
    lists.write_frozen(t(spark, sf_dir, "orders").select(F.concat("o_orderpriority", (F.col("o_custkey") % 100).cast("string")).alias("mint")), at)
    return lists.read_frozen(spark, at)


@query(
    """WITH a AS (SELECT CASE o_orderstatus WHEN 'F' THEN '/d/snapshot-' || o_orderkey || '-7xKXt.tar.zst' ELSE '/d/incremental-snapshot-' || o_custkey || '-' || o_orderkey || '-7xKXt.tar.zst' END AS path, CASE o_orderstatus WHEN 'F' THEN 'full' ELSE 'incremental' END AS kind, o_orderkey AS slot
    FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 700 OR o_orderstatus = 'O' AND o_custkey <= 700 AND o_orderkey > 700)
    SELECT path, kind, slot, row_number() OVER (ORDER BY kind DESC, slot DESC, path) AS choice FROM a"""
)
def candidate_order(spark, sf_dir):
    return discovery.candidates(discovery.catalogue(archives(spark, sf_dir)), 700).select("path", "kind", "slot", F.col("choice").cast("long").alias("choice"))


@query("SELECT 'new' AS lane, o_orderkey % 90 + 1 AS slot, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'active', o_orderkey % 90 + 1, count(*) FROM orders WHERE o_orderkey % 90 + 1 > 60 GROUP BY 2")
def lanes_of_a_checkpoint(spark, sf_dir):
    lanes = ingest.fan_out(_orders_checkpoint(spark, sf_dir), {"new": None, "active": 60})
    count = lambda lane: lanes[lane].groupBy("slot").agg(F.count("*").alias("n")).select(F.lit(lane).alias("lane"), "slot", "n")
    return count("new").unionByName(count("active"))


@query(
    """SELECT 'raw_token_mint' AS table_name, NULL AS column_name, NULL AS expected, NULL AS actual, 'missing table' AS problem UNION ALL SELECT 'hot_token_info', 'supply_raw', 'decimal(20,0)', 'bigint', 'mismatch'
    UNION ALL SELECT 'hot_token_info', 'uri', 'string', NULL, 'missing' UNION ALL SELECT 'hot_wallet_token_balance', 'owner', 'key 1', 'key 0', 'mismatch' UNION ALL SELECT 'hot_wallet_token_balance', 'mint', 'key 0', 'key 1', 'mismatch'"""
)
def schema_conformance(spark, sf_dir):
    want = [(name, f.name, f.dataType.simpleString()) for name, schema in schemas.TABLES.items() for f in schema.fields]
    want += [(name, c, f"key {k}") for name, key in schemas.KEYS.items() for k, c in enumerate(key)]
    have = [("hot_token_info", c, "bigint") if (n, c, k) == ("hot_token_info", "supply_raw", "decimal(20,0)") else (n, c, k) for n, c, k in want if n != "raw_token_mint" and (n, c) != ("hot_token_info", "uri")]
    have = [(n, c, {"key 0": "key 1", "key 1": "key 0"}.get(k, k)) if n == "hot_wallet_token_balance" else (n, c, k) for n, c, k in have]
    frame = lambda rows: spark.createDataFrame(rows, "table_name string, column_name string, kind string")
    return table_gaps(frame(have), frame(want))


# --- generations, watch, stream --------------------------------------------------------------------------------------


def _balance_rows(spark, sf_dir, priority: str, slot: int) -> DataFrame:
    rows = t(spark, sf_dir, "orders").where(F.col("o_orderpriority") == priority)
    return rows.select(F.col("o_orderstatus").alias("mint"), (F.col("o_custkey") % 300).cast("string").alias("owner"), cents("o_totalprice").alias("amount_raw"), F.lit(slot).cast("long").alias("updated_slot"))


def _summed(rows: DataFrame) -> DataFrame:
    return schemas.conform(rows.groupBy("mint", "owner").agg(F.sum("amount_raw").alias("amount_raw"), F.max("updated_slot").alias("updated_slot")), "hot_wallet_token_balance")


_TWO_BATCHES = """batches AS (SELECT o_orderstatus AS mint, CAST(o_custkey % 300 AS VARCHAR) AS owner, CASE o_orderpriority WHEN '5-LOW' THEN 1 ELSE 2 END AS updated_slot, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS amount_raw
    FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT') GROUP BY ALL), latest AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY mint, owner ORDER BY updated_slot DESC) = 1)"""


def _generation(spark, sf_dir):
    new = Store(spark, workspace(spark, "store")).new()
    new.write("hot_wallet_token_balance", _summed(_balance_rows(spark, sf_dir, "5-LOW", 1)), "one")
    new.write("hot_wallet_token_balance", _summed(_balance_rows(spark, sf_dir, "1-URGENT", 2)), "two")
    new.write("hot_wallet_token_balance", _summed(_balance_rows(spark, sf_dir, "1-URGENT", 2)), "two")  # a repeated load
    return new


@query(f"WITH {_TWO_BATCHES} SELECT * FROM latest WHERE mint = 'O' ORDER BY amount_raw DESC, owner LIMIT 50")
def generation_holders(spark, sf_dir):
    return _generation(spark, sf_dir).holders("O", 50).withColumns({"amount_raw": F.col("amount_raw").cast("long"), "updated_slot": F.col("updated_slot").cast("int")})


@query(f"WITH {_TWO_BATCHES} SELECT * FROM latest WHERE owner = '7'")
def generation_assets(spark, sf_dir):
    return _generation(spark, sf_dir).assets("7").withColumns({"amount_raw": F.col("amount_raw").cast("long"), "updated_slot": F.col("updated_slot").cast("int")})


@query(f"WITH {_TWO_BATCHES} SELECT * FROM latest")
def compacted_table(spark, sf_dir):
    one = _generation(spark, sf_dir)
    one.compact_if_due(after=2)
    return one.versions("hot_wallet_token_balance").withColumns({"amount_raw": F.col("amount_raw").cast("long"), "updated_slot": F.col("updated_slot").cast("int")})


@query(
    f"""WITH {_FULL} SELECT sha256(k) AS pubkey, sha256(m) AS mint, sha256(w) AS owner, CAST(150 AS BIGINT) AS updated_slot FROM (SELECT 'k' || k AS k, m, w, status, k AS n, amount FROM full_state) WHERE status = 'F' AND n % 3 = 0 AND amount > 0"""
)
def tombstone_repair(spark, sf_dir):
    orders = t(spark, sf_dir, "orders")
    full = _checkpoint(orders, F.col("o_orderkey") % 90 + 1, F.lit(False), F.when(F.col("o_orderstatus") == "P", 0).otherwise(cents("o_totalprice")))
    state = ingest.ingest(full, _hot(spark), 100, "full").state
    closed = _checkpoint(orders.where("o_orderstatus = 'F' AND o_orderkey % 3 = 0"), F.lit(150), F.lit(True), F.lit(0).cast("long"))
    return ingest.repaired_tombstones(closed, state).select(*[hexed(from_base58(c)).alias(c) for c in ("pubkey", "mint", "owner")], "updated_slot")


def _put(folder: str, base: int | None, slot: int, found: DataFrame) -> None:
    """An archive of a few hundred records."""
    files = [(r.slot, r.file_id, bytes(r.content)) for r in records.encode(found).select("slot", "file_id", "content").collect()]
    name = f"snapshot-{slot}-h.tar.zst" if base is None else f"incremental-snapshot-{base}-{slot}-h.tar.zst"
    archive.write_archive(os.path.join(folder, name), slot, files, manifest.body(slot, [(s, i, len(b)) for s, i, b in files]))


@query(
    """WITH full_state AS (SELECT o_orderkey AS k, o_orderstatus AS status, 'm' || (o_custkey % 50) AS m, 'w' || o_custkey AS w, CASE o_orderstatus WHEN 'P' THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS amount FROM orders WHERE o_custkey % 50 < 25 AND o_orderkey < 400),
    now AS (SELECT m, w, CASE WHEN k % 3 = 0 THEN amount // 2 ELSE amount END AS amount FROM full_state WHERE NOT (status = 'F' AND k % 3 = 0))
    SELECT sha256(m) AS mint, sha256(w) AS owner, CAST(sum(amount) AS BIGINT) AS amount_raw FROM now GROUP BY m, w HAVING sum(amount) > 0"""
)
def watched_balances(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").where("o_orderkey < 400")
    amount = F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("long")).otherwise(cents("o_totalprice"))
    folder, root = workspace(spark, "archives"), workspace(spark, "watched")
    _put(folder, None, 100, _checkpoint(orders, F.col("o_orderkey") % 90 + 1, F.lit(False), amount))
    half = F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("long")).otherwise(F.expr("CAST(round(o_totalprice * 100) AS BIGINT) DIV 2"))
    _put(folder, 100, 200, _checkpoint(orders.where("o_orderkey % 3 = 0"), F.lit(150), F.col("o_orderstatus") == "F", half))
    hot = _hot(spark).select("mint", F.lit(1).alias("enable"), F.lit(1).alias("version"))
    Watch(spark, Store(spark, root), folder, lambda: hot).run()
    return _hex(balances.current_balances(Store(spark, root).serving().versions("hot_wallet_token_balance"))).drop("updated_slot")


@query(
    """WITH latest AS (SELECT event_type AS mint, user_id, value, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1)
    SELECT mint, CAST(user_id % 50 AS VARCHAR) AS owner, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount_raw FROM latest WHERE mint <> 'error' GROUP BY 1, 2 HAVING sum(CAST(round(value * 100) AS BIGINT)) > 0"""
)
def streamed_balances(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    rows = e.select(
        F.concat_ws("/", "event_type", text("user_id")).alias("pubkey"), F.col("event_type").alias("mint"), (F.col("user_id") % 50).cast("string").alias("owner"), cents("value").alias("amount"), none.alias("delegate"), F.lit(0).alias("delegated_amount"),
        F.lit(1).alias("state"), none.alias("close_authority"), (F.col("event_type") == "error").cast("int").alias("is_deleted"), F.col("event_id").alias("updated_slot"), "ts",
    )
    at = workspace(spark, "streamed")
    for early, late in ((None, 8), (8, 15), (15, None)):  # one file for each stretch of days, in order
        day = lambda d: F.to_timestamp(F.lit(f"2024-01-{d:02d}"))
        part = rows.where((F.lit(True) if early is None else F.col("ts") >= day(early)) & (F.lit(True) if late is None else F.col("ts") < day(late)))
        schemas.conform(part, "hot_token_account_state").coalesce(1).write.mode("append").parquet(paths.join(at, "source"))
    changes = spark.readStream.schema(schemas.TABLES["hot_token_account_state"]).option("maxFilesPerTrigger", 1).parquet(paths.join(at, "source"))
    stream.refresh_balances(changes, paths.join(at, "root"), paths.join(at, "checkpoint"), compact=2).awaitTermination()
    return stream.current_balances(spark, paths.join(at, "root")).select("mint", "owner", F.col("amount_raw").cast("long").alias("amount_raw"))
