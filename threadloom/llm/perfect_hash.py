"""Minimal perfect hashing of a set of 64-bit keys, built shard by shard.

A shard's keys are hashed into a bit vector; those alone in their place keep
it, the others go on to the next level.  The number of set bits before a key's
place is its index; the key stored there verifies a lookup."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from threadloom.llm.textbuf import mix

_U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15
#: Places of a level for each of its keys.
ROOM = 1.5
MAX_LEVELS = 250


def hashed(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + _U64(0x51ED27))


def shard_hash(keys: np.ndarray) -> np.ndarray:
    """Non-negative; a key's shard is this modulo the number of shards."""
    return (hashed(keys) >> _U64(33)).astype(np.int64)


def _at(h: np.ndarray, level: int) -> np.ndarray:
    return mix(h + _U64((level + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))


def build_shard(keys: np.ndarray) -> tuple[np.ndarray, list[int], bytes]:
    """(keys in order of their indices, places of each level, packed bits) of distinct keys."""
    order, sizes, bits = [], [], []
    while len(keys):
        size = int(len(keys) * ROOM) + 1
        place = (_at(hashed(keys), len(sizes)) % _U64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        bits.append(alone)
        kept = alone[place]
        order.append(keys[kept][np.argsort(place[kept])])
        keys = keys[~kept]
        sizes.append(size)
        if len(sizes) > MAX_LEVELS:
            raise ValueError("keys repeat")
    packed = np.packbits(np.concatenate(bits), bitorder="little").tobytes() if bits else b""
    return np.concatenate(order) if order else np.zeros(0, np.int64), sizes, packed


@dataclass
class PairIndex:
    """Consecutive shards ``first`` and up of ``total``, ready for lookups."""

    first: int
    total: int
    keys: np.ndarray
    sizes: np.ndarray
    base: np.ndarray
    bits: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, first: int, total: int, shards: list[tuple[int, bytes, list[int], bytes]]) -> "PairIndex":
        """From (shard, keys, sizes, bits) rows in order of shards; absent shards are empty."""
        last = max([s for s, *_ in shards], default=first - 1)
        n = last - first + 1
        sizes = np.zeros((n, max([len(x[2]) for x in shards], default=0)), np.int64)
        base = np.zeros_like(sizes)
        at = 0
        for s, _, own, bits in shards:
            sizes[s - first, :len(own)] = own
            base[s - first, :len(own)] = 8 * at + np.cumsum(own) - own
            at += len(bits)
        bits = np.frombuffer(b"".join(x[3] for x in shards), np.uint8)
        keys = np.frombuffer(b"".join(x[1] for x in shards), np.int64)
        counts = np.bitwise_count(bits).astype(np.int64)
        return cls(first, total, keys, sizes, base, bits, np.cumsum(counts) - counts)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's index; -1 where it is not held."""
        out = np.full(len(keys), -1, np.int64)
        shard = shard_hash(keys) % self.total - self.first
        alive = np.flatnonzero((shard >= 0) & (shard < len(self.sizes)))
        h = hashed(keys)
        for level in range(self.sizes.shape[1]):
            size = self.sizes[shard[alive], level]
            alive, size = alive[size > 0], size[size > 0]
            if not len(alive):
                break
            place = self.base[shard[alive], level] + (_at(h[alive], level) % size.astype(np.uint64)).astype(np.int64)
            byte, bit = self.bits[place >> 3], (place & 7).astype(np.uint8)
            hit = (byte >> bit) & np.uint8(1) == 1
            below = np.bitwise_count(byte & ((np.uint8(1) << bit) - np.uint8(1)))
            out[alive[hit]] = (self.before[place >> 3] + below)[hit]
            alive = alive[~hit]
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != keys[found]]] = -1  # verified by the key itself
        return out
