"""Words, word hashes and shingles of whole Arrow text columns, without a Python loop over words."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
# 1: ASCII letters and digits, 2: ASCII signs but the apostrophe, 0: all else.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = 2
_KIND[39] = 0
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    _KIND[_lo:_hi] = 1
_BYTE = np.random.default_rng(20240711).integers(1, 1 << 63, 256, dtype=np.uint64)


class Words(NamedTuple):
    """The words of some texts: byte range and hash of each, and where each text's words begin (one more than texts).

    ``sums`` are the running sums that hash any byte range (see ``ranges``).
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    sums: np.ndarray


def process_state(name: str) -> dict:
    """A dictionary that lives as long as this process: functions reach tasks by value, and so do their module's globals."""
    return sys.__dict__.setdefault("_tickwise_state", {}).setdefault(name, {})


def _power(n: int, base: int, name: str) -> np.ndarray:
    powers = process_state("powers")
    have = powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 65_536)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 4 * SLICE_BYTES:
            powers[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array without nulls; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each, or of one row if that is longer."""
    ends = offsets(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi
    # Python workers are used again: what the batch needed goes back to the system.
    pa.default_memory_pool().release_unused()


def offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)


def _kind_changes(data: np.ndarray) -> np.ndarray:
    """Between which neighbouring bytes a letter or digit meets a sign; apostrophes and other scripts never count."""
    kind = _KIND[data]
    latin = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    kind[1:][latin] = 1
    kind[:-1][latin] = 1
    return (kind[1:] ^ kind[:-1]) == 3


def split(column: pa.Array, lower: bool = True, pieces: bool = False) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a string array.

    ``lower`` folds A-Z before hashing; ``pieces`` also parts words where Latin letters or digits meet ASCII signs.
    """
    at = offsets(column)
    begin, at = int(at[0]), at - at[0]
    buffer = column.buffers()[2] if len(column) else None
    data = np.frombuffer(buffer, np.uint8)[begin:begin + int(at[-1])] if buffer is not None else np.zeros(0, np.uint8)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none.astype(np.uint64), np.zeros(len(at), np.int64), np.zeros(1, np.uint64))
    space = _SPACE[data]
    border = np.zeros(n + 1, dtype=bool)
    border[at] = True
    if pieces:
        border[1:n] |= _kind_changes(data)
    starts = np.empty(n, dtype=bool)
    starts[0] = True
    np.logical_or(space[:-1], border[1:n], out=starts[1:])
    starts &= ~space
    ends = np.empty(n, dtype=bool)
    ends[-1] = True
    np.logical_or(space[1:], border[1:n], out=ends[:-1])
    ends &= ~space
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    values = _BYTE[_LOWER[data] if lower else data] * _power(n, _BASE, "up")
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return Words(data, starts, ends, ranges(total, starts, ends), np.searchsorted(starts, at), total)


def ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges; equal for equal bytes, wherever they lie. The ranges must not be empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    at_base = (sums[ends] - sums[starts]) * _power(len(sums) - 1, _BASE_INVERSE, "down")[starts]
    return mix(at_base + (ends - starts).astype(np.uint64))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text in order, and where each text's runs begin.

    A text of fewer words, but at least one, has its whole sequence as its one shingle.
    """
    count = np.diff(words.first)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    if first[-1] == 0:
        return np.zeros(0, np.uint64), first
    short = np.flatnonzero((count > 0) & (count < size))
    whole = np.full(max(len(words.hashes) - size + 1, 1), size, np.uint64)
    if len(words.hashes) >= size:
        for k in range(size):
            whole = mix(whole * np.uint64(0x9FB21C651E98DF25) + words.hashes[k:k + len(whole)])
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], runs)
    out = whole[np.minimum(at, len(whole) - 1)]
    if len(short):
        # Beyond their end the places count as the words.
        begin, stop = words.first[:-1][short], words.first[1:][short]
        padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
        one = np.full(len(short), size, np.uint64)
        for k in range(size):
            here = begin + k
            one = mix(one * np.uint64(0x9FB21C651E98DF25) + np.where(here < stop, padded[here], np.uint64(k)))
        out[first[:-1][short]] = one
    return out, first
