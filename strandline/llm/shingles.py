"""Word and shingle hashes of whole Arrow columns at once, in numpy.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A word's
64-bit hash is a polynomial over random byte codes, taken from prefix sums, so
a batch costs a few vector operations however many words it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; a longer text is taken alone.
SLICE = 1 << 20

_random = np.random.Generator(np.random.PCG64(20240229))
CODES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CODES[65:91] = CODES[97:123]  # lower case
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
ORDER = _random.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64; kept up to one slice."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        size = max(n, SLICE + 1)
        found = np.full(size, base, np.uint64)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if size <= 4 * SLICE:
            _powers[base] = found
    return found[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null texts are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None or not len(texts):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def parts(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes together; a longer row is alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


def word_hashes(offsets: np.ndarray, data: np.ndarray, space: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Hashes of all words and, for each row, where its words begin (one more entry at the end).

    ``space`` says which bytes part words. Further results are hashes of the
    words' first bytes, one for each length in ``prefixes``.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), *(np.zeros(0, np.uint64) for _ in prefixes)
    word = ~space[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    opens = word.copy()
    opens[1:] &= ~word[:-1] | first[1:n]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | first[1:n]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(CODES[data] * _power(BASE, n), out=sums[1:])
    back = _power(INVERSE, n + 1)[starts]

    def upto(stop: np.ndarray) -> np.ndarray:
        return mixed((sums[stop] - sums[starts]) * back + (stop - starts).astype(np.uint64))

    return upto(ends), np.searchsorted(starts, offsets), *(upto(np.minimum(ends, starts + k)) for k in prefixes)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row; a row of fewer words has one, of all its words."""
    all_offsets, all_data = buffers(texts)
    for a, b in parts(all_offsets):
        offsets = all_offsets[a : b + 1]
        hashes, bounds = word_hashes(offsets - offsets[0], all_data[offsets[0] : offsets[-1]])
        n = len(hashes) - width + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for k in range(width):
            if n > 0:
                rolled += hashes[k : k + n] * ORDER[k]
        rolled = mixed(rolled)
        for start, end in zip(bounds[:-1], bounds[1:]):
            if end - start >= width:
                own = np.sort(rolled[start : end - width + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif end > start:
                yield mixed((hashes[start:end] * ORDER[: end - start]).sum(keepdims=True) + np.uint64(end - start))
            else:
                yield np.zeros(0, np.uint64)
