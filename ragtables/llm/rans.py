"""Static range asymmetric numeral system over token ids, for one block.

A block holds ``n`` ids dealt to ``lanes`` interleaved coder states: id ``i`` belongs
to lane ``i % lanes``, and a step codes one id in each lane by array arithmetic.
States are kept in [2^31, 2^63) by moving 32-bit words in and out. Every
``SEGMENT_STEPS`` steps a checkpoint holds all states and the place in the words, so
that each segment decodes by itself; each segment has a checksum of its ids, the
block one of its bytes.

Layout, little-endian: header, then per segment word offset (u64) and crc32 of its
ids as u32 (u32), then the states of each segment (u64), the words (u32), and the
crc32 of all before (u32).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the format.
MAGIC = b"IDRS"
HEADER = "<4sIIIIII"  # magic, precision, lanes, ids, steps, segments, table
LOW = 1 << 31
WORD = 32
PRECISION = 20
MAX_LANES = 1024
SEGMENT_STEPS = 256


class Table:
    """Frequencies that sum to ``2^PRECISION``, shared by all blocks."""

    def __init__(self, frequencies: np.ndarray) -> None:
        self.frequencies = np.ascontiguousarray(frequencies, dtype=np.uint64)
        if int(self.frequencies.sum()) != 1 << PRECISION:
            raise ValueError("frequencies must sum to 2^PRECISION")
        self.starts = np.cumsum(self.frequencies) - self.frequencies
        self.crc = zlib.crc32(self.frequencies.astype("<u8").tobytes())

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> "Table":
        """Scaled counts; every id that occurs keeps a frequency of at least one."""
        counts = np.asarray(counts, dtype=np.int64)
        total, room = int(counts.sum()), 1 << PRECISION
        if not total:
            return cls(np.array([room]))
        if np.count_nonzero(counts) > room:
            raise ValueError("more different ids than the precision can tell apart")
        scaled = np.floor(counts * (room / total)).astype(np.int64)
        scaled = np.where(counts > 0, np.maximum(scaled, 1), 0)
        order = np.argsort(-scaled, kind="stable")
        excess = int(scaled.sum()) - room
        if excess < 0:
            scaled[order[0]] -= excess
        while excess > 0:  # take from the most frequent, never the last unit
            give = np.minimum(scaled[order] - 1, -(-excess // 64))
            give = np.minimum(give, np.maximum(0, excess - (np.cumsum(give) - give)))
            scaled[order] -= give
            excess -= int(give.sum())
        return cls(scaled)


def lanes_for(n: int) -> int:
    """A power of two, fewer lanes for few ids."""
    return max(1, min(MAX_LANES, 1 << max(0, (n // 64).bit_length() - 1)))


def encode(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = lanes_for(n)
    steps = -(-n // lanes)
    segments = -(-steps // SEGMENT_STEPS)
    f_all, c_all = table.frequencies[ids], table.starts[ids]
    if n and not f_all.all():
        raise ValueError("an id has no frequency in the table")
    limit = f_all << np.uint64(63 - PRECISION)
    state = np.full(lanes, LOW, np.uint64)
    states = np.zeros((segments, lanes), np.uint64)
    words: list[np.ndarray] = [np.zeros(0, np.uint32)] * steps
    bits, shift = np.uint64(WORD), np.uint64(PRECISION)
    for t in range(steps - 1, -1, -1):
        at = slice(t * lanes, min(n, (t + 1) * lanes))
        x = state[: at.stop - at.start]
        f = f_all[at]
        full = x >= limit[at]
        words[t] = x[full].astype(np.uint32)
        x = np.where(full, x >> bits, x)
        q = x // f
        state[: at.stop - at.start] = (q << shift) + (x - q * f) + c_all[at]
        if t % SEGMENT_STEPS == 0:
            states[t // SEGMENT_STEPS] = state
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.uint64)]).astype(np.uint64)
    raw = np.ascontiguousarray(ids, dtype="<u4")
    index = b"".join(
        struct.pack(
            "<QI",
            int(ends[s * SEGMENT_STEPS]),
            zlib.crc32(raw[s * SEGMENT_STEPS * lanes : (s + 1) * SEGMENT_STEPS * lanes].tobytes()),
        )
        for s in range(segments)
    )
    body = (
        struct.pack(HEADER, MAGIC, PRECISION, lanes, n, SEGMENT_STEPS, segments, table.crc)
        + index
        + states.astype("<u8").tobytes()
        + (np.concatenate(words) if words else np.zeros(0, np.uint32)).astype("<u4").tobytes()
    )
    return body + struct.pack("<I", zlib.crc32(body))


class Decoder:
    """Decodes blocks that share a table."""

    def __init__(self, table: Table) -> None:
        self.table = table
        self.symbols = np.repeat(
            np.arange(len(table.frequencies), dtype=np.uint32), table.frequencies.astype(np.int64)
        )

    def open(self, block: bytes) -> tuple[int, int, int, int]:
        """Checks a block; its lanes, ids, steps a segment, and segments."""
        if zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
            raise ValueError("a block's checksum does not match")
        magic, precision, lanes, n, steps, segments, crc = struct.unpack_from(HEADER, block)
        if magic != MAGIC or precision != PRECISION or crc != self.table.crc:
            raise ValueError("not a block of this table")
        return lanes, n, steps, segments

    def segment(self, block: bytes, number: int) -> np.ndarray:
        """The ids of one segment, from its checkpoint."""
        magic, _, lanes, n, seg_steps, segments, _ = struct.unpack_from(HEADER, block)
        index = struct.calcsize(HEADER)
        offset, crc = struct.unpack_from("<QI", block, index + 12 * number)
        index += 12 * segments
        x = np.frombuffer(block, "<u8", lanes, index + 8 * lanes * number).astype(np.uint64)
        first_word = index + 8 * lanes * segments
        words = np.frombuffer(block, "<u4", (len(block) - 4 - first_word) // 4, first_word)
        at = int(offset)
        start, stop = number * seg_steps * lanes, min(n, (number + 1) * seg_steps * lanes)
        out = np.zeros(stop - start, np.uint32)
        frequencies, starts = self.table.frequencies, self.table.starts
        mask, shift, bits = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION), np.uint64(WORD)
        for i in range(0, stop - start, lanes):
            own = x[: min(lanes, stop - start - i)]
            slot = own & mask
            found = self.symbols[slot]
            out[i : i + len(own)] = found
            own = frequencies[found] * (own >> shift) + slot - starts[found]
            low = np.flatnonzero(own < np.uint64(LOW))
            own[low] = (own[low] << bits) | words[at : at + len(low)]
            at += len(low)
            x[: len(own)] = own
        if zlib.crc32(out.astype("<u4").tobytes()) != crc:
            raise ValueError("a segment's checksum does not match")
        return out

    def decode(self, block: bytes) -> np.ndarray:
        _, _, _, segments = self.open(block)
        parts = [self.segment(block, s) for s in range(segments)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
