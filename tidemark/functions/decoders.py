"""Account payloads to columns: token accounts and mints natively, extensible layouts by Arrow-batched functions."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.base58 import encode
from tidemark.functions.scalar import ACCOUNT_STATES, bytes_at, u_le

# Lengths and markers of the token layouts.
ACCOUNT_LEN, MINT_LEN, MULTISIG_LEN, TLV_START = 165, 82, 355, 166
MINT_MARK, ACCOUNT_MARK = 1, 2


# --- native: fixed layouts -------------------------------------------------------------------------------------------


def _option(data: Column, at: int, value: Column) -> tuple[Column, Column]:
    """(value or null, well-formed) of a four-byte tag and what follows it."""
    tag = u_le(data, at, 4)
    return F.when(tag == 1, value), tag.isin(0, 1)


def _flag(data: Column, at: int) -> Column:
    return u_le(data, at, 1)


def token_account(data: Column) -> Column:
    """A struct of the first 165 bytes, null where they are no initialized token account. Keys stay binary."""
    delegate, ok1 = _option(data, 72, bytes_at(data, 76, 32))
    native, ok2 = _option(data, 109, u_le(data, 113, 8))
    closer, ok3 = _option(data, 129, bytes_at(data, 133, 32))
    state = _flag(data, 108)
    row = F.struct(
        bytes_at(data, 0, 32).alias("mint"), bytes_at(data, 32, 32).alias("owner"), u_le(data, 64, 8).alias("amount"), delegate.alias("delegate"),
        state.cast("byte").alias("state"), native.alias("rent_reserve"), u_le(data, 121, 8).alias("delegated_amount"), closer.alias("close_authority"),
    )
    return F.when((F.length(data) >= ACCOUNT_LEN) & state.isin(1, 2) & ok1 & ok2 & ok3, row)


def token_mint(data: Column) -> Column:
    """A struct of the first 82 bytes, null where they are no initialized mint."""
    authority, ok1 = _option(data, 0, bytes_at(data, 4, 32))
    freezer, ok2 = _option(data, 46, bytes_at(data, 50, 32))
    ready = _flag(data, 45)
    row = F.struct(authority.alias("mint_authority"), u_le(data, 36, 8).alias("supply"), _flag(data, 44).cast("short").alias("decimals"), (ready == 1).alias("is_initialized"), freezer.alias("freeze_authority"))
    return F.when((F.length(data) >= MINT_LEN) & (ready == 1) & ok1 & ok2, row)


def plain_account(data: Column) -> Column:
    return F.when(F.length(data) == ACCOUNT_LEN, token_account(data))


def plain_mint(data: Column) -> Column:
    return F.when(F.length(data) == MINT_LEN, token_mint(data))


def _extended(data: Column, base: int, mark: int) -> Column:
    """Whether the length and the mark fit: bare, or longer with the mark of its kind; a multisig's length is none."""
    n = F.length(data)
    return (n == base) | ((n > ACCOUNT_LEN) & (n != MULTISIG_LEN) & (_flag(data, ACCOUNT_LEN) == mark))


def _padded(data: Column) -> Column:
    """A mint with extensions is filled up with zeros to an account's length."""
    return (F.length(data) == MINT_LEN) | (F.hex(bytes_at(data, MINT_LEN, ACCOUNT_LEN - MINT_LEN)) == "00" * (ACCOUNT_LEN - MINT_LEN))


def extended_account(data: Column) -> Column:
    return F.when(_extended(data, ACCOUNT_LEN, ACCOUNT_MARK), token_account(data))


def extended_mint(data: Column) -> Column:
    return F.when(_extended(data, MINT_LEN, MINT_MARK) & _padded(data), token_mint(data))


def routed_account(data: Column, plain: Column, extensible: Column) -> Column:
    """The token account of either program, its layout spelled out once."""
    fits = F.when(plain, F.length(data) == ACCOUNT_LEN).when(extensible, _extended(data, ACCOUNT_LEN, ACCOUNT_MARK))
    return F.when(fits, token_account(data))


def routed_mint(data: Column, plain: Column, extensible: Column) -> Column:
    fits = F.when(plain, F.length(data) == MINT_LEN).when(extensible, _extended(data, MINT_LEN, MINT_MARK) & _padded(data))
    return F.when(fits, token_mint(data))


# --- Arrow-batched: extensions and metadata --------------------------------------------------------------------------


class Malformed(ValueError):
    pass


class Cursor:
    """Reads little-endian values one after another; anything that isn't there is Malformed."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise Malformed("value is cut off")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, kind: str) -> int:
        return struct.unpack("<" + kind, self.take(struct.calcsize("<" + kind)))[0]

    def text(self) -> str:
        try:
            return self.take(self.number("I")).decode()
        except UnicodeDecodeError as e:
            raise Malformed("text is not UTF-8") from e

    def key(self) -> bytes:
        return self.take(32)

    def flag(self) -> bool:
        n = self.number("B")
        if n > 1:
            raise Malformed("flag is neither 0 nor 1")
        return bool(n)

    def maybe(self, read: Callable):
        return read() if self.flag() else None

    @property
    def left(self) -> int:
        return len(self.data) - self.at


def key_text(raw: bytes) -> str | None:
    """Base58 of a key, None for the zero key."""
    return encode(raw) if any(raw) else None


def metadata_value(data: bytes) -> dict:
    """Update authority, mint, name, symbol and uri of a metadata value; additional pairs are checked and dropped."""
    c = Cursor(data)
    out = {"update_authority": key_text(c.key()), "mint": encode(c.key()), "name": c.text(), "symbol": c.text(), "uri": c.text()}
    pairs = c.number("I")
    if pairs > c.left // 8:  # each needs two lengths
        raise Malformed("more additional pairs than there is room for")
    for _ in range(2 * pairs):
        c.text()
    return out


def _fee(value: bytes) -> dict:
    u64 = lambda at: struct.unpack_from("<Q", value, at)[0]
    u16 = lambda at: struct.unpack_from("<H", value, at)[0]
    older = {"epoch": u64(72), "transferFeeBasisPoints": u16(88), "maximumFee": u64(80)}
    return {"transferFeeConfigAuthority": key_text(value[:32]), "newerTransferFee": {"transferFeeBasisPoints": u16(106), "maximumFee": u64(98)}, "olderTransferFee": older}


def _default_state(value: bytes) -> dict:
    if value[0] >= len(ACCOUNT_STATES):
        raise Malformed("unknown account state")
    return {"accountState": ACCOUNT_STATES[value[0]]}


def _named(data: bytes) -> dict:
    m = metadata_value(data)
    return {"name": m["name"], "symbol": m["symbol"], "uri": m["uri"], "updateAuthority": m["update_authority"]}


# Supported extension types, their names, lengths (None: any) and shapes.
EXTENSIONS: dict[int, tuple[str, int | None, Callable[[bytes], dict]]] = {
    1: ("transferFeeConfig", 108, _fee),
    3: ("mintCloseAuthority", 32, lambda v: {"closeAuthority": key_text(v)}),
    6: ("defaultAccountState", 1, _default_state),
    9: ("nonTransferable", 0, lambda v: {}),
    12: ("permanentDelegate", 32, lambda v: {"delegate": key_text(v)}),
    14: ("transferHook", 64, lambda v: {"authority": key_text(v[:32]), "programId": key_text(v[32:])}),
    18: ("metadataPointer", 64, lambda v: {"authority": key_text(v[:32])}),
    19: ("tokenMetadata", None, _named),
}


def tlv(data: bytes) -> list[tuple[int, bytes]]:
    """(type, value) in physical order; type 0 ends the list, a cut-off entry is Malformed."""
    c, out = Cursor(data), []
    c.at = min(TLV_START, len(data))
    while c.left:
        kind = c.take(4)
        kind, size = struct.unpack("<HH", kind)
        if kind == 0:
            break
        out.append((kind, c.take(size)))
    return out


def extensions(data: bytes) -> tuple[str, dict | None, list[str]]:
    """(JSON array, embedded metadata, warnings). Of equal types the first counts; unknown ones are passed over."""
    found, seen, warnings, metadata = [], set(), [], None
    for kind, value in tlv(data):
        if kind not in EXTENSIONS or kind in seen:
            continue
        seen.add(kind)
        name, size, shape = EXTENSIONS[kind]
        try:
            if size is not None and len(value) != size:
                raise Malformed(f"{len(value)} bytes instead of {size}")
            found.append({"extension": name, "state": shape(value)})
            if name == "tokenMetadata":
                metadata = metadata_value(value)
        except Malformed as e:
            warnings.append(f"extension type {kind}: {e}")
    return json.dumps(found, separators=(",", ":"), sort_keys=True, ensure_ascii=False), metadata, warnings


def program_metadata(data: bytes) -> dict | None:
    """The metadata program's account: None unless it is of the metadata kind. The two tails at its end are optional."""
    if not data or data[0] != 4:
        return None
    c = Cursor(data[1:])
    creator = lambda: (encode(c.key()), c.flag(), c.number("B"))[0]
    out = {"update_authority": encode(c.key()), "mint": encode(c.key()), "name": c.text(), "symbol": c.text(), "uri": c.text(), "seller_fee_basis_points": c.number("H")}

    def creators():
        n = c.number("I")
        if n > c.left // 34:
            raise Malformed("more creators than there is room for")
        return [creator() for _ in range(n)]

    out["creators"] = c.maybe(creators) or []
    c.flag()
    out["is_mutable"] = c.flag()
    out["token_standard"] = None
    try:
        c.maybe(lambda: c.number("B"))
        standard = c.maybe(lambda: c.number("B"))
        c.maybe(lambda: (c.flag(), c.key()))
        c.maybe(lambda: c.take(17))
        out["token_standard"] = standard
    except Malformed:
        pass
    return out


_META = T.StructType([T.StructField(n, T.StringType()) for n in ("update_authority", "mint", "name", "symbol", "uri")])
EXTENSION_SCHEMA = T.StructType([T.StructField("extensions", T.StringType()), T.StructField("metadata", _META), T.StructField("warnings", T.StringType()), T.StructField("failed", T.BooleanType())])
PROGRAM_SCHEMA = T.StructType(
    [*_META.fields, T.StructField("seller_fee_basis_points", T.IntegerType()), T.StructField("creators", T.ArrayType(T.StringType())), T.StructField("is_mutable", T.BooleanType()), T.StructField("token_standard", T.ShortType())]
)


def _frame(rows: list[dict], schema: T.StructType) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in schema.names})


@F.pandas_udf(EXTENSION_SCHEMA)
def mint_extensions(data: pd.Series) -> pd.DataFrame:
    """Extensions as JSON, embedded metadata and warnings of each mint; `failed` where the list itself is cut off."""
    rows = []
    for raw in data:
        try:
            text, metadata, warnings = extensions(bytes(raw or b""))
            rows.append({"extensions": text, "metadata": metadata, "warnings": "\n".join(warnings) or None, "failed": False})
        except Malformed as e:
            rows.append({"extensions": None, "metadata": None, "warnings": str(e), "failed": True})
    return _frame(rows, EXTENSION_SCHEMA)


def _each(parse: Callable[[bytes], dict | None], schema: T.StructType) -> Callable[[pd.Series], pd.DataFrame]:
    def run(data: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in data:
            try:
                rows.append((parse(bytes(raw)) if raw is not None else None) or {})
            except Malformed:
                rows.append({})
        return _frame(rows, schema)

    return run


@F.pandas_udf(_META)
def standalone_metadata(data: pd.Series) -> pd.DataFrame:
    """A metadata value that stands alone; `mint` is null where the data is none."""
    return _each(metadata_value, _META)(data)


@F.pandas_udf(PROGRAM_SCHEMA)
def metadata_account(data: pd.Series) -> pd.DataFrame:
    """The metadata program's account; `mint` is null where the data is none."""
    return _each(program_metadata, PROGRAM_SCHEMA)(data)
