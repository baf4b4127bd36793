"""Elias-Fano coding of a sorted sequence of non-negative integers.

Each value is cut into low bits, packed side by side, and a high part, written
in unary as one bit vector: the one bit of the value with index ``k`` stands at
``high + k``. With ``n`` values below ``u`` this takes about
``n * (2 + log2(u / n))`` bits. A directory holds the number of one bits in
front of every block of 512 bits (a sixteenth of the bit vector more), so
``select`` finds the place of any one bit by a binary search over the blocks
and a look into one of them; no table of 64-bit offsets exists.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK_BYTES = 64
_HEAD = struct.Struct("<QQQB")  # values, bytes of the bit vector, bytes of the low bits, low bits a value
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(1, dtype=np.int64)
#: Place of the k-th one bit (from 0) in each byte, 8 if it has fewer.
_PLACE = np.stack([np.where((np.cumsum(_BITS, 1) > k).any(1), (np.cumsum(_BITS, 1) > k).argmax(1), 8) for k in range(8)], 1)


def encode(values: np.ndarray) -> bytes:
    """The code of ``values`` (ascending, unsigned 64-bit integers)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n and (values[1:] < values[:-1]).any():
        raise ValueError("the values must ascend")
    top = int(values[-1]) if n else 0
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(bits.astype(np.uint8), bitorder="little").tobytes() if low else b""
    size = (n + (top >> low) + 1 + 7) // 8
    size += -size % BLOCK_BYTES
    flags = np.zeros(size * 8, np.uint8)
    flags[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    high = np.packbits(flags, bitorder="little")
    blocks = _ONES[high.reshape(-1, BLOCK_BYTES)].sum(1)
    before = (np.cumsum(blocks) - blocks).astype("<u4")
    return _HEAD.pack(n, size, len(lows), low) + before.tobytes() + high.tobytes() + lows


class EliasFano:
    """Reads single values of a code without decoding the others."""

    def __init__(self, data: bytes):
        self.n, size, lows, self.low = _HEAD.unpack_from(data)
        at = _HEAD.size
        self.before = np.frombuffer(data, "<u4", size // BLOCK_BYTES, at).astype(np.int64)
        at += 4 * len(self.before)
        self.high = np.frombuffer(data, np.uint8, size, at).reshape(-1, BLOCK_BYTES)
        self.lows = np.concatenate([np.frombuffer(data, np.uint8, lows, at + size), np.zeros(16, np.uint8)])

    def __len__(self) -> int:
        return self.n

    def select(self, index: np.ndarray) -> np.ndarray:
        """Places of the one bits with these indices in the bit vector."""
        block = np.searchsorted(self.before, index, "right") - 1
        left = index - self.before[block]
        ones = np.cumsum(_ONES[self.high[block]], 1)
        byte = (ones <= left[:, None]).sum(1)
        rows = np.arange(len(index))
        left = left - np.where(byte > 0, ones[rows, byte - 1], 0)
        return (block * BLOCK_BYTES + byte) * 8 + _PLACE[self.high[block, byte], left]

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values with these indices (unsigned 64-bit integers)."""
        index = np.asarray(index, np.int64)
        high = (self.select(index) - index).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        bit = index * self.low
        near = self.lows[(bit >> 3)[:, None] + np.arange(9)]
        shift = (bit & 7).astype(np.uint64)
        word = np.ascontiguousarray(near[:, :8]).view("<u8")[:, 0] >> shift
        word |= np.where(shift > 0, near[:, 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, 1)), 0).astype(np.uint64)
        return high | (word & np.uint64((1 << self.low) - 1))
