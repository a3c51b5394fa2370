"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from millrace.llm.tables import STEP_BYTES, in_batches

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: One fixed 64-bit value for each byte; never 0.
BYTE_VALUE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)


def separators(codes) -> np.ndarray:
    """Table of 256: the byte itself, or 0 where the byte separates words; a NUL in a word reads as 255."""
    keep = np.arange(256, dtype=np.uint8)
    keep[0] = 255  # no byte of UTF-8
    keep[list(codes)] = 0
    return keep


def lowered(byte_table: np.ndarray) -> np.ndarray:
    """The same table with A-Z read as a-z."""
    out = byte_table.copy()
    out[65:91] = np.where(byte_table[97:123] > 0, np.arange(97, 123), 0)
    return out


#: Words are runs of anything but space and the controls 9 to 13.
SPACE = separators([32, *range(9, 14)])
#: Words are runs of digits, lower-case letters and bytes beyond ASCII.
ALNUM = separators([0, *range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next call."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(max(n, STEP_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def steps(column: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo to hi of a string column with their bytes and offsets; nulls count as empty texts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


class Hasher:
    """Hash of any byte range of a text block: equal ranges have equal hashes wherever they are."""

    def __init__(self, data: np.ndarray, byte_value: np.ndarray = BYTE_VALUE):
        self.up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_value[data] * self.up[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


class Words:
    """Word ranges of a block of texts: ``starts``, ``ends``, and per text its first word in ``first``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, byte_table: np.ndarray):
        kept = byte_table[data]
        inside = kept > 0
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.kept, self.inside, self.offsets = kept, inside, offsets
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash for each word, of its bytes as the table maps them."""
        return Hasher(self.kept)(self.starts, self.ends)

    def texts(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the word each run starts at."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = mixed(out * BASE + hashes[k:n - size + 1 + k])
    at = np.arange(n - size + 1)
    last_of = np.repeat(first[1:], np.diff(first))[:len(at)]
    whole = at + size <= last_of
    return out[whole], at[whole]


def sums_between(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring edges, empty ranges included."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[edges])


#: Bits of a table that says which hashes may be in a set.
TABLE_BITS = 24


class BitTable:
    """A set of 64-bit hashes by their first bits: never denies one that is in it. 2 MB, whatever it holds."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> U(64 - TABLE_BITS)).astype(np.int64)
        return (self.packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def bit_table(frame, hashes_of) -> np.ndarray:
    """The packed table of all hashes in a frame; ``hashes_of`` gives those of a batch. Each task sends one table."""

    def run(batches):
        bits = np.zeros(1 << TABLE_BITS, bool)
        for batch in batches:
            bits[(hashes_of(batch) >> U(64 - TABLE_BITS)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    merged = np.zeros(1 << TABLE_BITS >> 3, np.uint8)
    for row in in_batches(frame, run, "bits binary").toLocalIterator():
        merged |= np.frombuffer(row["bits"], np.uint8)
    return merged
