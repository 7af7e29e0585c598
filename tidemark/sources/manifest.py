"""The manifest of a checkpoint: which storage files it has, and how many bytes of each are valid.

The manifest is a sequence of little-endian values of fixed size: first the bank's fields, which are passed over, then
the map from slots to their storage files. Lists, maps and sets begin with their length in eight bytes, an optional
value with one byte. It may be many GB, so it is read in pieces and nothing but the file list is kept.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from typing import BinaryIO

KEY, U64 = 32, 8


class _Source:
    """Reads and passes over values of a stream."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream = stream

    def take(self, n: int) -> bytes:
        parts = []
        while n:
            part = self.stream.read(min(n, 1 << 20))
            if not part:
                raise EOFError("the manifest is cut off")
            parts.append(part)
            n -= len(part)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        while n:
            n -= len(self.take(min(n, 1 << 20)))

    def u64(self) -> int:
        return struct.unpack("<Q", self.take(U64))[0]

    def option(self, size: int) -> None:
        if (tag := self.take(1)[0]) > 1:
            raise ValueError("the manifest has an option that is neither there nor not")
        self.skip(size * tag)

    def many(self, entry: int | Callable[[], None]) -> None:
        """A list, map or set: of entries of one size, or each by its own reading."""
        n = self.u64()
        if isinstance(entry, int):
            self.skip(n * entry)
        else:
            for _ in range(n):
                entry()


def _vote_account(s: _Source) -> None:
    s.skip(KEY + U64 + U64)  # key, stake, lamports
    s.many(1)  # data
    s.skip(KEY + 1 + U64)  # owner, executable, rent epoch


def _stakes(s: _Source) -> None:
    s.many(lambda: _vote_account(s))
    s.many(KEY + KEY + 4 * U64)  # delegations: staker, voter, stake, both epochs, rate
    s.skip(2 * U64)  # unused, epoch
    s.many(4 * U64)  # history: epoch, effective, activating, deactivating


def _epoch_stakes(s: _Source) -> None:
    s.skip(U64)  # epoch
    _stakes(s)
    s.skip(U64)  # total

    def node() -> None:
        s.skip(KEY)
        s.many(KEY)
        s.skip(U64)

    s.many(node)
    s.many(2 * KEY)  # authorized voters


SCHEDULE = 2 * U64 + 1 + 2 * U64


def _bank(s: _Source) -> int:
    """Pass over the bank's fields; its slot."""
    s.skip(U64)  # queue of block hashes: last index
    s.option(KEY)
    s.many(KEY + 3 * U64)
    s.skip(U64)
    s.many(2 * U64)  # ancestors
    s.skip(2 * KEY + U64)  # hash, parent's hash and slot
    s.many(2 * U64)  # hard forks
    s.skip(5 * U64)  # transactions, ticks, signatures, capitalization, last tick
    s.option(U64)
    s.skip(U64 + 16 + U64 + U64 + U64)  # ticks a slot, nanoseconds a slot, creation, slots a year, length of accounts
    slot = s.u64()
    s.skip(2 * U64 + KEY + U64)  # epoch, height, collector and its fees
    s.skip(U64 + 4 * U64 + 1 + U64)  # fee, its governor, collected rent
    s.skip(U64 + SCHEDULE + U64 + 2 * U64 + 1)  # rent collector
    s.skip(SCHEDULE + 6 * U64)  # schedule, inflation
    _stakes(s)
    s.many(KEY)
    s.many(KEY)
    s.many(KEY + U64)
    s.many(lambda: _epoch_stakes(s))
    s.skip(1)  # is a delta
    return slot


def read(stream: BinaryIO) -> tuple[int, dict[tuple[int, int], int]]:
    """(slot of the bank, valid length by (slot, file id))."""
    s = _Source(stream)
    slot = _bank(s)
    out: dict[tuple[int, int], int] = {}

    def files() -> None:
        at = s.u64()
        for _ in range(s.u64()):
            number, size = struct.unpack("<QQ", s.take(2 * U64))
            out[at, number] = size

    s.many(files)
    return slot, out


def body(slot: int, files: list[tuple[int, int, int]]) -> bytes:
    """A manifest of an empty bank that lists (slot, file id, valid length) files. For fixtures and tools."""
    zeros = bytes
    none, empty = zeros(1), zeros(U64)
    stakes = 2 * empty + zeros(2 * U64) + empty
    bank = zeros(U64) + none + empty + zeros(U64) + empty + zeros(2 * KEY + U64) + empty + zeros(5 * U64) + none + zeros(U64 + 16 + 3 * U64)
    bank += struct.pack("<Q", slot) + zeros(2 * U64 + KEY + U64) + zeros(6 * U64 + 1) + zeros(U64 + SCHEDULE + 3 * U64 + 1) + zeros(SCHEDULE + 6 * U64)
    bank += stakes + 3 * empty + empty + none
    by: dict[int, list[bytes]] = {}
    for at, number, size in files:
        by.setdefault(at, []).append(struct.pack("<QQ", number, size))
    return bank + struct.pack("<Q", len(by)) + b"".join(struct.pack("<QQ", at, len(x)) + b"".join(x) for at, x in by.items())


def valid_lengths(stream: BinaryIO) -> dict[tuple[int, int], int]:
    return read(stream)[1]
