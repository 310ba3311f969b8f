"""Vector work on the texts of an Arrow batch: word spans, hashes, sums per document.

A batch of texts is one array of UTF-8 bytes with row bounds, as Arrow holds it, so nothing here loops over
documents or words. There are two kinds of hash:

* ``spans``: of spans that do not overlap, such as words and lines. Each symbol is mixed with its place in the span,
  and the mixed numbers are summed modulo 2**64.
* ``Rolling``: of any spans, such as all windows. A Rabin-Karp polynomial modulo the prime 2**61 - 1 at one base, from
  prefix sums: two different spans of n symbols have one hash for n of 2**61 bases at most.

Within a slice ``distinct`` finds equal spans by their symbols. Memory in a task is about 150 bytes
for each text byte of a slice; a slice holds ``SLICE_BYTES``, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 3)  # odd
PLACE = U(0xD1B54A32D192ED03)
PRIME = U((1 << 61) - 1)
LOW30, LOW31 = U((1 << 30) - 1), U((1 << 31) - 1)
POINT = int(BASE) % int(PRIME)  # where the polynomials are taken
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the numbers over all others; a permutation of 64-bit numbers."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(29)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(32)
    return x


CODES = mix(np.arange(1, 257, dtype=U) * BASE)


def reduced(x: np.ndarray) -> np.ndarray:
    """The numbers modulo PRIME."""
    high = x >> U(61)
    high += x & PRIME
    high -= PRIME * (high >= PRIME)
    return high


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of numbers below PRIME modulo PRIME, from halves of 31 bits."""
    a1, a0, b1, b0 = a >> U(31), a & LOW31, b >> U(31), b & LOW31
    middle = a1 * b0
    middle += a0 * b1
    a1 *= b1
    a1 <<= U(1)
    a0 *= b0
    a1 += a0
    a1 += middle >> U(30)
    middle &= LOW30
    middle <<= U(31)
    a1 += middle
    return reduced(a1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """POINT**i and POINT**-i modulo PRIME for i below n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        made, size = [], max(n, 1 << 16)
        for base in (POINT, pow(POINT, -1, int(PRIME))):
            found = np.ones(size, U)
            done = 1
            while done < size:
                more = min(done, size - done)
                found[done:done + more] = times(found[:more], U(pow(base, done, int(PRIME))))
                done += more
            made.append(found)
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def _sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=out[1:])
    return out


class Rolling:
    """Hashes of any span of a symbol sequence, from one pass over it."""

    def __init__(self, codes: np.ndarray):
        up, self.down = powers(len(codes) + 1)
        terms = times(reduced(codes), up[:len(codes)])
        self.low, self.high = _sums(terms & LOW31), _sums(terms >> U(31))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        high = reduced(self.high[end] - self.high[start])
        total = reduced(reduced(self.low[end] - self.low[start]) + ((high & LOW30) << U(31)) + (high >> U(30)))
        return mix(times(total, self.down[start]) + (end - start).astype(U) * BASE)


def spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans that rise and do not overlap, each symbol mixed with its place."""
    if not len(starts):
        return np.zeros(0, U)
    first, last = starts[0], ends[-1]
    values = codes[first:last].astype(U)
    values *= BASE
    values += np.arange(last - first, dtype=U) * PLACE
    values -= np.repeat((starts - first).astype(U) * PLACE, np.diff(starts, append=last))
    sums = _sums(mix(values))
    return mix(sums[ends - first] - sums[starts - first] + (ends - starts).astype(U) * BASE)


def distinct(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The different ones of spans that rise and do not overlap, as an array of their bytes, and which each span is.

    They come in the order in which they stand first. Spans are compared by their symbols, whatever their hashes.
    """
    if not len(starts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    bounds = np.stack([starts, ends], 1).ravel() * symbols.dtype.itemsize  # spans and the gaps between them
    listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(symbols))])
    made = listed.take(pa.array(np.arange(0, len(bounds) - 1, 2))).dictionary_encode()
    return made.dictionary, made.indices.to_numpy().astype(np.int64)


def firsts(which: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` numbers stands first."""
    at = np.zeros(count, np.int64)
    at[which[::-1]] = np.arange(len(which))[::-1]
    return at


def unpacked(array: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of an array of large binaries one after another, and where each begins and the last one ends."""
    _, bounds, data = array.buffers()
    edges = np.frombuffer(bounds, np.int64)[array.offset:array.offset + len(array) + 1] // np.dtype(kind).itemsize if len(array) else np.zeros(1, np.int64)
    held = np.frombuffer(data, kind) if data is not None and data.size else np.zeros(0, kind)
    return held[edges[0]:edges[-1]], edges - edges[0]


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about ``limit`` bytes of the column ``text``, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class Texts:
    """The bytes of a text column with the bounds of each row; a null text is empty."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "").cast(pa.large_string())
        _, bounds, data = column.buffers()
        edges = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
        held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = held[edges[0]:edges[-1]]
        self.edges = edges - edges[0]
        self.rows = len(column)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flags, one for each byte, are set in each row."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.edges[1:]] - sums[self.edges[:-1]]

    def parts(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal spans of set flags that stay in a row: starts, ends, and where each row's first one is."""
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = self.edges[1:] > self.edges[:-1]
        at, to = self.edges[:-1][filled], self.edges[1:][filled] - 1
        first[at], last[to] = inside[at], inside[to]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.edges)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans of the words [^ \\t-\\r]+ and where each row's first word is."""
        return self.parts(~SPACE[self.data])


def owners(edges: np.ndarray) -> np.ndarray:
    """The row of each item, given where each row's items begin."""
    return np.repeat(np.arange(len(edges) - 1), np.diff(edges))


def windows(codes: np.ndarray, edges: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first item and row of each run of ``length`` items that stays in a row."""
    rows = owners(edges)
    starts = np.flatnonzero(np.arange(len(codes)) + length <= edges[1:][rows]) if len(codes) else np.zeros(0, np.int64)
    return Rolling(codes).spans(starts, starts + length), starts, rows[starts]
