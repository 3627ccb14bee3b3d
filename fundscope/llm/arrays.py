"""Text as flat numpy arrays, for the Arrow tasks of this package.

A task gets Arrow batches of whole texts.  ``chunks`` cuts a batch into runs of
documents of about ``CHUNK_BYTES`` (a longer document is a run of its own), so
the arrays of a task stay small whatever the batch size; ``Words`` finds and
hashes the words of such a run without a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10

U64 = np.uint64

# Word characters as byte classes.  Bytes from 0x80 on belong to
# characters beyond ASCII, which are word characters in both classes.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _spread(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE_VALUE = _spread(256, 11)
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)


_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, n of each at least; the longest so far are kept."""
    if len(_POWERS[0]) < n:
        size = 1 << int(n - 1).bit_length()
        _POWERS[:] = [np.concatenate([np.ones(1, U64), np.cumprod(np.full(size - 1, b, U64))]) for b in (BASE, BASE_INVERSE)]
    return _POWERS


class Sums:
    """Hashes of any slices of a sequence of 64-bit values, from prefix sums."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.prefix = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in the bytes); null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


class Words:
    """Maximal runs of word bytes; a run never crosses from one document to the next."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, part: np.ndarray | None = None):
        """``kind``: which bytes are word bytes.  ``part``: classes of bytes; a run also ends where class 1 meets class 2."""
        inside = kind[data]
        first, last = inside.copy(), inside.copy()
        if part is None:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
        else:
            classes = part[data]
            meet = classes[1:] + classes[:-1] == 3
            first[1:] &= ~inside[:-1] | meet
            last[:-1] &= ~inside[1:] | meet
        full = offsets[1:] > offsets[:-1]
        first[offsets[:-1][full]] = inside[offsets[:-1][full]]
        last[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
        self.data, self.start, self.end = data, np.flatnonzero(first), np.flatnonzero(last) + 1
        #: index of each document's first word, and the number of words as the last entry
        self.doc = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def hashes(self) -> np.ndarray:
        return Sums(BYTE_VALUE[self.data])(self.start, self.end)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc) - 1), self.counts)


def characters(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(one number for each UTF-8 character, offsets of the documents in them).

    The number is the character's bytes, packed.  ``lower`` folds A-Z and the
    capitals of Latin-1.  Stray continuation bytes join the character before.
    """
    if lower:
        data = LOWER[data]
    lead = (data & 0xC0) != 0x80
    full = offsets[1:] > offsets[:-1]
    lead[offsets[:-1][full]] = True
    at = np.flatnonzero(lead)
    value = data[at].astype(np.uint32)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    more = np.concatenate([~lead, np.zeros(3, bool)])
    going = np.flatnonzero(value >= 0x80)
    for k in (1, 2, 3):
        going = going[more[at[going] + k]]
        if not len(going):
            break
        value[going] |= padded[at[going] + k].astype(np.uint32) << np.uint32(8 * k)
    if lower:
        second = value >> np.uint32(8)
        capital = ((value & np.uint32(0xFF)) == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        value[capital] += np.uint32(0x2000)
    return value, np.searchsorted(at, offsets)


def sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the slices between bounds."""
    total = np.concatenate([np.zeros(1, np.int64 if values.dtype.kind in "biu" else np.float64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def heads(ordered: np.ndarray) -> np.ndarray:
    """Where a new value starts in a sorted array."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted.  (Sorting integers is many times faster than numpy's hashing unique.)"""
    ordered = np.sort(values)
    return ordered[heads(ordered)]


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count, count) + np.repeat(start, count)
