"""Counting quotient filters over packed word-id n-grams, without loss.

An n-gram of word ids of ``bits`` bits each is two numbers: the first id, and the others side by side.  A few Feistel rounds, which
can be undone, spread them evenly; the first number is then the quotient, the second the remainder.  A filter holds the sorted
n-grams of a shard with their counts.  Packed, it keeps no quotient: it keeps how many entries each slot (leading quotient bits)
has, the bits that remain of every entry in as few bytes as they need, and counters of one byte with an escape.  Since nothing of
the remainder is cut, two n-grams never share a counter, and unpacking gives ids and counts back exactly.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from caseloom.llm.common import mix

_HEAD = struct.Struct("<BBBqq")
_ROUNDS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)]
_ESCAPE = 255


def _shifted(x: np.ndarray, salt: np.uint64, bits: int) -> np.ndarray:
    return mix(x ^ salt) >> np.uint64(64 - bits)


def permute(first: np.ndarray, rest: np.ndarray, bits: int, rest_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feistel rounds over (``bits``, ``rest_bits``) bits; ``restore`` undoes them."""
    for k, salt in enumerate(_ROUNDS):
        if k % 2:
            rest = rest ^ _shifted(first, salt, rest_bits)
        else:
            first = first ^ _shifted(rest, salt, bits)
    return first, rest


def restore(first: np.ndarray, rest: np.ndarray, bits: int, rest_bits: int) -> tuple[np.ndarray, np.ndarray]:
    for k in reversed(range(len(_ROUNDS))):
        if k % 2:
            rest = rest ^ _shifted(first, _ROUNDS[k], rest_bits)
        else:
            first = first ^ _shifted(rest, _ROUNDS[k], bits)
    return first, rest


def _order(quotient: np.ndarray, remainder: np.ndarray, bits: int, rest_bits: int) -> np.ndarray:
    """Sorted order; a stable sort, so that runs already sorted are merged."""
    if bits + rest_bits <= 64:
        if bits == 0 or rest_bits == 64:
            return np.argsort(remainder, kind="stable")
        return np.argsort(quotient << np.uint64(rest_bits) | remainder, kind="stable")
    return np.lexsort((remainder, quotient))


@dataclass
class CountingFilter:
    """Sorted distinct entries: quotient of ``bits`` bits, remainder of ``rest_bits`` bits, count."""

    bits: int
    rest_bits: int
    quotient: np.ndarray
    remainder: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, quotient: np.ndarray, remainder: np.ndarray, count: np.ndarray | None, bits: int, rest_bits: int) -> CountingFilter:
        """Filter of entries in any order, equal ones summed (``count`` None: each once)."""
        if not quotient.size:
            return cls(bits, rest_bits, quotient, remainder, np.empty(0, np.int64))
        order = _order(quotient, remainder, bits, rest_bits)
        quotient, remainder = quotient[order], remainder[order]
        new = np.concatenate(([True], (quotient[1:] != quotient[:-1]) | (remainder[1:] != remainder[:-1])))
        start = np.flatnonzero(new)
        total = np.diff(np.append(start, new.size)) if count is None else np.add.reduceat(count[order], start)
        return cls(bits, rest_bits, quotient[start], remainder[start], total.astype(np.int64))

    @classmethod
    def merged(cls, filters: list[CountingFilter]) -> CountingFilter:
        """One filter of several with equal bits: their sorted entries merged, counts of equal entries added."""
        one = filters[0]
        return cls.of(*(np.concatenate([getattr(f, c) for f in filters]) for c in ("quotient", "remainder", "count")), one.bits, one.rest_bits)

    def split(self, bits: int) -> list[tuple[int, CountingFilter]]:
        """(leading ``bits`` bits, filter of the rest) of every part that has entries."""
        low = self.bits - bits
        lead = self.quotient >> np.uint64(low)
        edges = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1], [True]))) if lead.size else [0]
        inner = self.quotient & np.uint64((1 << low) - 1)
        return [
            (int(lead[a]), CountingFilter(low, self.rest_bits, inner[a:b], self.remainder[a:b], self.count[a:b]))
            for a, b in zip(edges, edges[1:])
        ]

    def pack(self) -> bytes:
        n = self.quotient.size
        slot_bits = min(self.bits, max(n.bit_length() - 1, 0))
        low = self.bits - slot_bits
        slots = np.bincount((self.quotient >> np.uint64(low)).astype(np.int64), minlength=1 << slot_bits)
        big_slot = np.flatnonzero(slots >= _ESCAPE)
        big_count = np.flatnonzero(self.count >= _ESCAPE)
        left = self.quotient & np.uint64((1 << low) - 1)
        return b"".join(
            (
                _HEAD.pack(self.bits, self.rest_bits, slot_bits, n, big_slot.size),
                np.minimum(slots, _ESCAPE).astype(np.uint8).tobytes(),
                slots[big_slot].astype(np.int64).tobytes(),
                _narrow(left, low),
                _narrow(self.remainder, self.rest_bits),
                np.minimum(self.count, _ESCAPE).astype(np.uint8).tobytes(),
                self.count[big_count].tobytes(),
            )
        )

    @classmethod
    def unpack(cls, data: bytes) -> CountingFilter:
        bits, rest_bits, slot_bits, n, big = _HEAD.unpack_from(data)
        at = _HEAD.size

        def take(kind: type, size: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, size, at)
            at += out.nbytes
            return out

        slots = take(np.uint8, 1 << slot_bits).astype(np.int64)
        slots[slots == _ESCAPE] = take(np.int64, big)
        low = bits - slot_bits
        left = _wide(take(np.uint8, n * -(-low // 8)), n)
        remainder = _wide(take(np.uint8, n * -(-rest_bits // 8)), n)
        count = take(np.uint8, n).astype(np.int64)
        escaped = count == _ESCAPE
        count[escaped] = take(np.int64, int(escaped.sum()))
        quotient = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), slots) << np.uint64(low) | left
        return cls(bits, rest_bits, quotient, remainder, count)


def _narrow(values: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _wide(data: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, : data.size // n] = data.reshape(n, -1)
    return out.reshape(-1).view("<u8")
