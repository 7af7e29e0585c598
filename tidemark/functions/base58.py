"""Base58 text of binary keys. There is no built-in, so these are Arrow-batched functions for the edge of a plan."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the base58 alphabet.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_PLACE = {c: k for k, c in enumerate(ALPHABET)}


def encode(raw: bytes) -> str:
    n, out = int.from_bytes(raw, "big"), []
    while n:
        n, r = divmod(n, 58)
        out.append(ALPHABET[r])
    zeros = len(raw) - len(raw.lstrip(b"\0"))
    return "1" * zeros + "".join(reversed(out))


def decode(text: str) -> bytes:
    n = 0
    for c in text:
        n = n * 58 + _PLACE[c]
    zeros = len(text) - len(text.lstrip("1"))
    return b"\0" * zeros + n.to_bytes((n.bit_length() + 7) // 8, "big")


#: Keys are 32 bytes; 45 digits hold their largest value, five of them a 32-bit number.
KEY_BYTES, DIGITS, LIMB = 32, 45, 58**5


def encode_keys(raw: np.ndarray) -> pa.Array:
    """The base58 text of each row of a matrix of bytes, 32 columns: long division of all rows at once."""
    n = len(raw)
    words = np.ascontiguousarray(raw).view(">u4").astype(np.uint64)
    digits = np.zeros((n, DIGITS), np.uint8)
    for group in range(DIGITS // 5 - 1, -1, -1):
        rest = np.zeros(n, np.uint64)
        for k in range(words.shape[1]):
            now = (rest << np.uint64(32)) | words[:, k]
            words[:, k] = now // np.uint64(LIMB)
            rest = now % np.uint64(LIMB)
        for place in range(5 * group + 4, 5 * group - 1, -1):
            digits[:, place] = rest % np.uint64(58)
            rest //= np.uint64(58)
    first = np.where(digits.any(axis=1), (digits != 0).argmax(axis=1), DIGITS)
    zeros = np.where(raw.any(axis=1), (raw != 0).argmax(axis=1), KEY_BYTES)
    # each leading zero byte is a digit zero, and zero digits stand before the first other one
    start = first - zeros
    text = np.frombuffer(ALPHABET.encode(), np.uint8)[digits][np.arange(DIGITS)[None, :] >= start[:, None]]
    ends = np.concatenate(([0], np.cumsum(DIGITS - start))).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes()))


def encode_all(keys: pa.Array) -> pa.Array:
    if keys.null_count == 0 and len(keys) and pc.all(pc.equal(pc.binary_length(keys), KEY_BYTES)).as_py():
        at = np.frombuffer(keys.buffers()[1], np.int32, len(keys) + 1, keys.offset * 4)
        return encode_keys(np.frombuffer(keys.buffers()[2], np.uint8, KEY_BYTES * len(keys), int(at[0])).reshape(-1, KEY_BYTES))
    return pa.array([None if k is None else encode(k) for k in keys.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def base58(keys: pa.Array) -> pa.Array:
    """The base58 text of each binary key."""
    valid = keys.drop_null()
    if len(valid) == len(keys):
        return encode_all(keys)
    place = pa.array(np.cumsum(keys.is_valid().to_numpy(zero_copy_only=False)) - 1, pa.int64(), mask=keys.is_null().to_numpy(zero_copy_only=False))
    return encode_all(valid).take(place)


@F.pandas_udf(T.BinaryType())
def from_base58(texts: pd.Series) -> pd.Series:
    def one(t):
        try:
            return None if t is None else decode(t)
        except KeyError:
            return None

    return texts.map(one)
