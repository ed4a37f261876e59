"""Words of whole texts in Arrow batches, cut and hashed by array arithmetic.

All separators are ASCII, so cutting works on UTF-8 bytes: no byte of a longer
character is below 0x80. A word's hash is a polynomial in its bytes modulo 2^64,
taken from running sums, and then mixed; a shingle's hash chains the hashes of its
words. Equal words have equal hashes; two different ones collide with a chance of
about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# The separators of both kinds of words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NO_LETTERS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

# Texts are cut in pieces of about this size, so that the arrays stay small.
PIECE_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class Words(NamedTuple):
    """Words of the rows ``first ..``: hash, place in ``data``, and first word of
    each row (one more entry than rows)."""

    first: int
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    data: bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each stretch of bytes; equal stretches have equal ones."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverse = _scales(1 << (len(data) - 1).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (rows + 1) and all bytes. Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at, raw


def pieces(
    texts: pa.Array,
    separators: bytes,
    fold: bool = True,
    kinds: np.ndarray | None = None,
    limit: int | None = None,
) -> Iterator[Words]:
    """The words of a batch of texts, some rows at a time; A-Z in lower case if told to
    ``fold``. With ``kinds`` (a number for each byte) a word also ends between bytes of
    the kinds 1 and 2, in either order. ``limit`` is the size of a piece in bytes."""
    at, raw = text_buffers(texts)
    n = len(at) - 1
    is_word = np.ones(256, dtype=bool)
    is_word[np.frombuffer(separators, dtype=np.uint8)] = False
    lower = np.arange(256, dtype=np.uint8)
    if fold:
        lower[65:91] += 32
    row = 0
    powers = inverse = np.zeros(0, np.uint64)
    limit = limit or PIECE_BYTES
    while row < n:
        stop = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        data = lower[raw[at[row] : at[stop]]]
        edges = at[row : stop + 1] - at[row]
        inside = is_word[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        if kinds is not None:
            kind = kinds[data]
            first[1:] |= kind[1:] + kind[:-1] == 3
        cuts = edges[(edges < len(data))]
        first[cuts] = inside[cuts]
        starts = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        ends = np.flatnonzero(last) + 1
        if len(data) > len(powers):
            powers = _powers(_BASE, len(data))
            inverse = _powers(pow(_BASE, -1, 1 << 64), len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts]) if len(starts) else sums[:0]
        yield Words(
            row, hashes, starts, ends, np.searchsorted(starts, edges), data.tobytes()
        )
        row = stop


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position; shorter by ``size - 1``."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        out = mix(out * np.uint64(_BASE) + hashes[j : j + n])
    return out


def chained(hashes: np.ndarray) -> int:
    """Hash of a whole sequence of words, as ``shingle_hashes`` would give it."""
    return int(shingle_hashes(hashes, len(hashes))[0])
