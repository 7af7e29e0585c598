"""Byte-level fixtures of the account layouts, built independently of the decoders."""

import hashlib
import struct

from tidemark.functions.base58 import encode


def key(tag) -> bytes:
    return hashlib.sha256(str(tag).encode()).digest()


def name(tag) -> str:
    return encode(key(tag))


def option(raw: bytes | None, size: int) -> bytes:
    return struct.pack("<I", raw is not None) + (raw if raw is not None else bytes(size))


def account(mint, owner, amount, delegate=None, state=1, delegated=0, close=None) -> bytes:
    out = key(mint) + key(owner) + struct.pack("<Q", amount) + option(delegate and key(delegate), 32) + bytes([state]) + option(None, 8) + struct.pack("<Q", delegated) + option(close and key(close), 32)
    assert len(out) == 165
    return out


def mint(supply, decimals, authority=None, freeze=None, ready=1) -> bytes:
    out = option(authority and key(authority), 32) + struct.pack("<QBB", supply, decimals, ready) + option(freeze and key(freeze), 32)
    assert len(out) == 82
    return out


def tlv(*entries) -> bytes:
    return b"".join(struct.pack("<HH", kind, len(value)) + value for kind, value in entries)


def extended_mint(base: bytes, *entries) -> bytes:
    return base + bytes(165 - 82) + b"\x01" + tlv(*entries)


def text(x: str) -> bytes:
    return struct.pack("<I", len(x.encode())) + x.encode()


def metadata_value(authority, of, title, symbol, uri, pairs=()) -> bytes:
    raw = bytes(32) if authority is None else key(authority)
    return raw + key(of) + text(title) + text(symbol) + text(uri) + struct.pack("<I", len(pairs)) + b"".join(text(k) + text(v) for k, v in pairs)


def program_metadata(authority, of, title, symbol, uri, fee=0, creators=None, mutable=True, tail=b"") -> bytes:
    made = b"\0" if creators is None else b"\1" + struct.pack("<I", len(creators)) + b"".join(key(c) + b"\1\x32" for c in creators)
    return b"\x04" + key(authority) + key(of) + text(title) + text(symbol) + text(uri) + struct.pack("<H", fee) + made + b"\0" + bytes([mutable]) + tail
