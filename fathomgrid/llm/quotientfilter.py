"""Counting quotient filters: lossless counters of packed keys, sorted, so that filters merge like sorted runs.

A key is two whole numbers, `left` and `right`, of fixed widths. An invertible permutation spreads keys evenly. The
permuted left number is the quotient, the right one the remainder, and both are kept in full, so a counter is
exact and its key can be had back.

Within a filter the quotient's upper bits name a slot. Counters stand in slot order; one bit per slot says that it is
occupied, one bit per counter that it ends its slot's run, so the slot number itself is not stored. What is stored
is the rest of the quotient and the remainder, in as few bytes as their widths need, and the count, one byte for
counts below 255.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_ROUNDS = 4
_WIDE = 255


def _mixed(x: np.ndarray, turn: int) -> np.ndarray:
    """A 64-bit hash, multiplying and folding; numbers wrap."""
    x = (x + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


@dataclass(frozen=True)
class Keys:
    """Widths of a key's two numbers, at most 63 bits each."""

    left: int
    right: int

    def permuted(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in range(_ROUNDS):
            right = right ^ (_mixed(left, 2 * turn) & _mask(self.right))
            left = left ^ (_mixed(right, 2 * turn + 1) & _mask(self.left))
        return left, right

    def restored(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in reversed(range(_ROUNDS)):
            left = left ^ (_mixed(right, 2 * turn + 1) & _mask(self.left))
            right = right ^ (_mixed(left, 2 * turn) & _mask(self.right))
        return left, right


@dataclass
class Counters:
    """Permuted keys in order, each once, with counts."""

    quotient: np.ndarray
    remainder: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def part(self, chosen: slice | np.ndarray) -> Counters:
        return Counters(self.quotient[chosen], self.remainder[chosen], self.count[chosen])


def counted(keys: Keys, quotient: np.ndarray, remainder: np.ndarray, count: np.ndarray | None = None) -> Counters:
    """Sort keys and add up the counts (1 each by default) of equal ones."""
    if keys.left + keys.right <= 64:
        packed = (quotient << np.uint64(keys.right)) | remainder
        order = np.argsort(packed, kind="stable")
    else:
        order = np.lexsort((remainder, quotient))
    quotient, remainder = quotient[order], remainder[order]
    new = np.ones(len(order), bool)
    new[1:] = (quotient[1:] != quotient[:-1]) | (remainder[1:] != remainder[:-1])
    starts = np.flatnonzero(new)
    if count is None:
        total = np.diff(np.append(starts, len(order))).astype(np.int64)
    else:
        total = np.add.reduceat(count[order], starts) if len(starts) else count
    return Counters(quotient[starts], remainder[starts], total)


def merged(keys: Keys, filters: list[Counters]) -> Counters:
    """Sorted filters merged; their equal keys' counts are added."""
    return counted(
        keys,
        np.concatenate([f.quotient for f in filters]),
        np.concatenate([f.remainder for f in filters]),
        np.concatenate([f.count for f in filters]),
    )


def buckets(keys: Keys, counters: Counters, bits: int) -> list[tuple[int, Counters]]:
    """Counters by the first `bits` bits of the quotient."""
    of = (counters.quotient >> np.uint64(keys.left - bits)).astype(np.int64)
    found, starts = np.unique(of, return_index=True)
    ends = [*starts[1:], len(of)]
    return [(int(b), counters.part(slice(a, z))) for b, a, z in zip(found, starts, ends, strict=True)]


def _narrow(numbers: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widened(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return wide.view("<u8").reshape(n).astype(np.uint64), n * width


def stored_filter(keys: Keys, counters: Counters, bucket_bits: int) -> bytes:
    """Bytes of one bucket's counters."""
    n = len(counters)
    inner = keys.left - bucket_bits
    slot_bits = min(inner, max(1, int(n).bit_length()))
    rest = inner - slot_bits
    within = counters.quotient & _mask(inner)
    slot = (within >> np.uint64(rest)).astype(np.int64)
    occupied = np.zeros(1 << slot_bits, bool)
    occupied[slot] = True
    run_end = np.ones(n, bool)
    run_end[:-1] = slot[1:] != slot[:-1]
    wide = counters.count >= _WIDE
    return b"".join(
        [
            struct.pack("<IB", n, slot_bits),
            np.packbits(occupied).tobytes(),
            np.packbits(run_end).tobytes(),
            _narrow(within & _mask(rest), rest),
            _narrow(counters.remainder, keys.right),
            np.where(wide, _WIDE, counters.count).astype(np.uint8).tobytes(),
            counters.count[wide].astype("<i8").tobytes(),
        ]
    )


def read_filter(keys: Keys, data: bytes, bucket: int, bucket_bits: int) -> Counters:
    """The counters that `stored_filter` wrote."""
    n, slot_bits = struct.unpack_from("<IB", data)
    at, view = 5, memoryview(data)
    rest = keys.left - bucket_bits - slot_bits
    size = -(-(1 << slot_bits) // 8)
    slots = np.flatnonzero(np.unpackbits(np.frombuffer(view[at : at + size], np.uint8), count=1 << slot_bits))
    at += size
    size = -(-n // 8)
    run_end = np.unpackbits(np.frombuffer(view[at : at + size], np.uint8), count=n)
    at += size
    # Counters before a run's end belong to the slot of that run.
    run = np.cumsum(run_end, dtype=np.int64) - run_end
    low, size = _widened(view[at:], n, rest)
    at += size
    remainder, size = _widened(view[at:], n, keys.right)
    at += size
    count = np.frombuffer(view[at : at + n], np.uint8).astype(np.int64)
    wide = count == _WIDE
    count[wide] = np.frombuffer(view[at + n :], "<i8", int(wide.sum()))
    quotient = (np.uint64(bucket) << np.uint64(keys.left - bucket_bits)) | (
        slots[run].astype(np.uint64) << np.uint64(rest)
    ) | low
    return Counters(quotient, remainder, count)
