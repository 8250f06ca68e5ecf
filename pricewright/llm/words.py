"""Words of a whole Arrow batch at once: spans and 64-bit hashes without a Python object per word.

A word is a run of bytes that a ``Rule`` calls word bytes; rules look at single
bytes, which is enough for classes that treat all code points past 0x7F alike.
The hash of a word is a polynomial over its bytes with random coefficients per
byte value, so prefix sums over the buffer give all words of a piece in a few
array operations. Pieces are cut between words, which bounds the memory however
long a text is.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


class Rule(NamedTuple):
    """Which bytes belong to words, and what each byte counts as."""

    inside: np.ndarray
    folded: np.ndarray


def rule(outside: bytes, fold_case: bool = True) -> Rule:
    """Words are runs of bytes not in ``outside``; A-Z count as a-z if ``fold_case``."""
    inside = np.ones(256, dtype=bool)
    inside[list(outside)] = False
    folded = np.arange(256, dtype=np.uint8)
    if fold_case:
        folded[65:91] += 32
    return Rule(inside, folded)


SPACED = rule(b" \t\n\x0b\x0c\r")
ALNUM = rule(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LETTERS = rule(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


class Words(NamedTuple):
    """``bounds[d]:bounds[d+1]`` are the words of text d; starts and ends are positions in ``data``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def text_of(self, word: int, fold: np.ndarray) -> bytes:
        return fold[self.data[self.starts[word]:self.ends[word]]].tobytes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column end to end, and where each text starts; null is empty."""
    column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _cut(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, low: int) -> int:
    """End of the piece that starts at ``low``: a text's end or a byte outside words."""
    at = low + PIECE
    if at >= len(data):
        return len(data)
    stop = int(bounds[np.searchsorted(bounds, at)])
    while at < stop:
        part = inside[data[at:min(stop, at + 65536)]]
        gap = int(part.argmin())
        if not part[gap]:
            return at + gap
        at += len(part)
    return stop


def words(column: pa.Array, by: Rule) -> Words:
    """Spans and hashes of all words of a binary column."""
    data, bounds = flat(column)
    starts, ends, hashes = [], [], []
    low = 0
    while low < len(data):
        high = _cut(data, bounds, by.inside, low)
        piece = data[low:high]
        inside = by.inside[piece]
        edge = np.zeros(high - low + 1, dtype=bool)
        edge[0] = edge[-1] = True
        edge[bounds[np.searchsorted(bounds, low):np.searchsorted(bounds, high, "right")] - low] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        start = np.flatnonzero(after & (edge | ~before))
        end = np.flatnonzero(before & (edge | ~after))
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        coded = _BYTE[by.folded[piece]]
        coded *= _power(_BASE, len(piece))[:len(piece)]
        np.cumsum(coded, out=sums[1:])
        hashes.append(mixed((sums[end] - sums[start]) * _power(_INVERSE, len(piece) + 1)[start]))
        starts.append(start + low)
        ends.append(end + low)
        low = high
    joined = [np.concatenate(x) if x else np.empty(0, kind)
              for x, kind in ((starts, np.int64), (ends, np.int64), (hashes, np.uint64))]
    return Words(data, *joined, np.searchsorted(joined[0], bounds))


def slices(column: pa.Array, limit: int = 1 << 23):
    """Row ranges of a binary column of about ``limit`` bytes, one row at least."""
    _, bounds = flat(column)
    low, n = 0, len(bounds) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
        yield low, high
        low = high


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by its first word; runs may cross texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total += hashes[k:k + n] * (_STEP[k % 64] + np.uint64(2 * (k // 64)))
    return mixed(total)


def shingles(found: Words, size: int):
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one has none."""
    runs = windows(found.hashes, size)
    for low, high in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        if high - low >= size:
            yield np.unique(runs[low:high - size + 1])
        else:
            yield windows(found.hashes[low:high], high - low) if high > low else runs[:0]
