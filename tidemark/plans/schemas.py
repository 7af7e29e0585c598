"""The schemas of the versioned tables and the check that a table conforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

U64 = T.DecimalType(20, 0)


def _of(spec: str) -> T.StructType:
    kinds = {"u64": U64, "string": T.StringType(), "long": T.LongType(), "short": T.ShortType(), "byte": T.ByteType(), "int": T.IntegerType(), "bool": T.BooleanType(), "strings": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in spec.split())])


#: Columns of the tables by name.
TABLES = {
    "raw_account": _of("pubkey:string owner:string lamports:u64 data_len:long executable:bool updated_slot:long"),
    "raw_token_mint": _of("mint:string mint_authority:string supply:u64 decimals:short is_initialized:bool freeze_authority:string updated_slot:long"),
    "raw_token_metadata": _of("mint:string name:string symbol:string uri:string update_authority:string is_mutable:bool token_standard:short seller_fee_basis_points:int creators:strings extensions:string updated_slot:long"),
    "hot_token_account_state": _of("pubkey:string mint:string owner:string amount:u64 delegate:string delegated_amount:u64 state:byte close_authority:string is_deleted:byte updated_slot:long"),
    "hot_wallet_token_balance": _of("mint:string owner:string amount_raw:u64 updated_slot:long"),
    "hot_token_info": _of("mint:string decimals:short supply_raw:u64 name:string symbol:string uri:string token_standard:short extensions:string mint_updated_slot:long metadata_updated_slot:long updated_slot:long"),
}
#: Key columns of each table's current state. An account that changed its owner program has two rows of raw_account.
KEYS = {
    "raw_account": ["owner", "pubkey"],
    "raw_token_mint": ["mint"],
    "raw_token_metadata": ["mint"],
    "hot_token_account_state": ["pubkey"],
    "hot_wallet_token_balance": ["mint", "owner"],
    "hot_token_info": ["mint"],
}
#: How the copies of each table are sorted, the first one being the table itself.
ORDERS = {
    "raw_account": [["owner", "pubkey"], ["pubkey"]],
    "raw_token_mint": [["mint"]],
    "raw_token_metadata": [["mint"]],
    "hot_token_account_state": [["pubkey"], ["mint", "owner", "pubkey"]],
    "hot_wallet_token_balance": [["mint", "amount_raw", "owner"], ["owner", "mint"]],
    "hot_token_info": [["mint"]],
}
HOT_TOKEN = _of("mint:string enable:byte version:long")


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, table: str) -> DataFrame:
    """`df` with the table's columns, in order and cast; a missing column is an error, but for `extensions`, which older
    tables lack and which defaults to an empty list."""
    from pyspark.sql import functions as F

    schema = TABLES[table]
    if missing := [n for n in schema.names if n not in df.columns and n != "extensions"]:
        raise SchemaMismatch(f"{table} lacks {missing}")
    pick = lambda f: F.col(f.name) if f.name in df.columns else F.lit("[]")
    return df.select(*[pick(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def assert_schema(df: DataFrame, table: str) -> None:
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {have.get(f.name)} instead of {f.dataType}" for f in TABLES[table].fields if have.get(f.name) != f.dataType]
    if wrong:
        raise SchemaMismatch(f"{table}: " + "; ".join(wrong))
