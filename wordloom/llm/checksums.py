"""CRC-32C of many byte strings at once, and its masked form."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: The reversed Castagnoli polynomial, and the mask of length-delimited record files.
POLYNOMIAL, MASK_ADD, MASK_TURN = 0x82F63B78, 0xA282EAD8, 15
LANE_BITS = 6
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


BYTES = _byte_table()


def _apply(op: np.ndarray, x: np.ndarray) -> np.ndarray:
    return op[0][x & 255] ^ op[1][(x >> 8) & 255] ^ op[2][(x >> 16) & 255] ^ op[3][x >> 24]


@lru_cache(maxsize=64)
def _zeros(k: int) -> np.ndarray:
    """What 2 ** k zero bytes do to a register, as a table for each of its bytes."""
    each = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    if k == 0:
        return BYTES[each & 255] ^ (each >> 8)
    half = _zeros(k - 1)
    return _apply(half, _apply(half, each))


def crc32c(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32C of each ``data[start : start + length]``.

    Every string is cut from its end into lanes of 64 bytes, whose registers run side by side; neighbouring lanes are then folded in pairs,
    again from the end. Zeros before a string leave an empty register as it is, and the register's first value enters by linearity.
    """
    n = len(start)
    lanes = np.maximum(1, (length + (1 << LANE_BITS) - 1) >> LANE_BITS)
    last = np.cumsum(lanes)
    held = np.zeros((int(last[-1]) if n else 0) << LANE_BITS, dtype=np.uint8)
    for s, m, e in zip(start.tolist(), length.tolist(), (last << LANE_BITS).tolist()):
        held[e - m : e] = data[s : s + m]
    columns = np.ascontiguousarray(held.reshape(-1, 1 << LANE_BITS).T)
    state = np.zeros(columns.shape[1], dtype=np.uint32)
    for column in columns:
        state = BYTES[(state ^ column) & 255] ^ (state >> 8)
    k = LANE_BITS
    while len(state) > n:
        # Lanes are numbered from each string's end, so that the right one of a pair always has its full length.
        owner = np.repeat(np.arange(n), lanes)
        back = np.cumsum(lanes)[owner] - 1 - np.arange(len(state))
        right = np.flatnonzero(back % 2 == 0)
        folded = state[right]
        paired = (right > 0) & (owner[right - 1] == owner[right])
        folded[paired] ^= _apply(_zeros(k), state[right[paired] - 1])
        state, lanes, k = folded, (lanes + 1) // 2, k + 1
    first = np.full(n, _ONES)
    for k in range(int(length.max()).bit_length() if n else 0):
        on = (length >> k) & 1 == 1
        first[on] = _apply(_zeros(k), first[on])
    return state ^ first ^ _ONES


def masked(crc: np.ndarray) -> np.ndarray:
    """The checksum as stored beside data: turned right by 15 bits, plus a constant."""
    return ((crc >> MASK_TURN) | (crc << (32 - MASK_TURN))) + np.uint32(MASK_ADD)
