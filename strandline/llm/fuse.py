"""Static binary-fuse filters with 8-bit fingerprints, built and probed in numpy.

Graf and Lemire, "Binary fuse filters: fast and smaller than xor filters", 2022.
A filter of n keys takes about 9 bits a key, never misses a key it was built
from, and takes a foreign key for its own about once in 256 times.
"""

from __future__ import annotations

import math
import struct

import numpy as np

HEADER = struct.Struct("<QII")  # seed, segment length, segments


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    mask = np.uint64(length - 1)
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray, tries: int = 100) -> bytes:
    """The filter of the distinct ``keys`` (uint64); an empty filter holds nothing."""
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    if n == 0:
        return HEADER.pack(0, 0, 0)
    length = min(1 << 18, 1 << max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 2)))
    segments = max(1, math.ceil(round(n * factor) / length) - 2)
    for seed in range(1, tries + 1):
        h = _mixed(keys, seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
        slots = _slots(h, length, segments)
        order = _peeled(slots, (segments + 2) * length, n)
        if order is None:
            continue
        table = np.zeros((segments + 2) * length, np.uint8)
        prints = _prints(h)
        for key, own in reversed(order):
            three = slots[:, key]
            table[own] = prints[key] ^ table[three[0]] ^ table[three[1]] ^ table[three[2]] ^ table[own]
        return HEADER.pack(seed * 0x9E3779B97F4A7C15 & (2**64 - 1), length, segments) + table.tobytes()
    raise ValueError(f"no binary-fuse filter of {n} keys after {tries} seeds")


def _peeled(slots: np.ndarray, size: int, n: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each has to itself); None if some keys can't be peeled.

    The slots of a round hold one key each, so the keys of a round are
    independent and a round is one vector operation.
    """
    count = np.bincount(slots.ravel(), minlength=size)
    total = np.zeros(size, np.int64)
    for row in slots:
        np.add.at(total, row, np.arange(n))
    alone = np.flatnonzero(count == 1)
    rounds, left = [], n
    while len(alone):
        key, at = np.unique(total[alone], return_index=True)
        rounds.append((key, alone[at]))
        left -= len(key)
        touched = slots[:, key]
        for row in touched:
            np.subtract.at(count, row, 1)
            np.subtract.at(total, row, key)
        alone = np.unique(touched)
        alone = alone[count[alone] == 1]
    return None if left else rounds


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; never false for a key of the build."""
    seed, length, segments = HEADER.unpack_from(blob)
    if not segments:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(blob, np.uint8, offset=HEADER.size)
    h = _mixed(np.asarray(keys, np.uint64), seed)
    first, second, third = _slots(h, length, segments)
    return (table[first] ^ table[second] ^ table[third]) == _prints(h)
