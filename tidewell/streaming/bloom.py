"""A small Bloom filter over pairs of 64-bit hashes that Spark computed."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass
class Bloom:
    bits: np.ndarray
    probes: int

    @classmethod
    def sized(cls, expected: int, fpp: float) -> Bloom:
        n_bits = max(64, math.ceil(-expected * math.log(fpp) / math.log(2) ** 2))
        n_bytes = (n_bits + 7) // 8
        probes = max(1, round(n_bytes * 8 / expected * math.log(2)))
        return cls(np.zeros(n_bytes, np.uint8), probes)

    @classmethod
    def restored(cls, raw: bytes, expected: int, fpp: float) -> Bloom:
        fresh = cls.sized(expected, fpp)
        return cls(np.frombuffer(raw, np.uint8).copy(), fresh.probes)

    def dump(self) -> bytes:
        return self.bits.tobytes()

    def add(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Insert distinct pairs; true where a pair was certainly not there before."""
        size = np.uint64(len(self.bits) * 8)
        step = np.arange(1, self.probes + 1, dtype=np.uint64)
        spots = (h1.astype(np.uint64)[:, None] + step * (h2.astype(np.uint64) | np.uint64(1))[:, None]) % size
        byte, bit = spots >> np.uint64(3), np.uint8(1) << (spots & np.uint64(7)).astype(np.uint8)
        fresh = ((self.bits[byte] & bit) == 0).any(axis=1)
        np.bitwise_or.at(self.bits, byte, bit)
        return fresh


@dataclass
class BlockedBloom:
    """A Bloom filter cut into blocks: all bits of a key are in one block, so blocks can be kept apart."""

    BLOCK = 4096  # bytes; large enough that keys spread almost evenly over blocks
    ROOM = 1.1  # for blocks that get more than their share

    blocks: int
    probes: int

    @classmethod
    def sized(cls, expected: int, fpp: float) -> BlockedBloom:
        n_bits = -expected * math.log(fpp) / math.log(2) ** 2 * cls.ROOM
        blocks = max(1, math.ceil(n_bits / (8 * cls.BLOCK)))
        return cls(blocks, max(1, round(-math.log2(fpp))))

    def block_of(self, h1: np.ndarray) -> np.ndarray:
        # The upper half of the hash; shards are dealt by the lower bits.
        return ((h1.astype(np.uint64) >> np.uint64(32)) % np.uint64(self.blocks)).astype(np.int64)

    def add(self, block: bytes | None, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Insert distinct pairs into a block: which were certainly not there before, and the new block."""
        held = np.zeros(self.BLOCK, np.uint8) if block is None else np.frombuffer(block, np.uint8).copy()
        one = Bloom(held, self.probes)
        return one.add(h2, h1 ^ h2 >> np.int64(7)), one.dump()
