"""Whole texts as bytes in numpy: words, lines and any substring hashed without a Python loop.

A batch of texts is one array of bytes with the offset of each text. All hashes are of 64 bits and
depend on the bytes alone, so equal strings have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text worked on at a time; one longer text is a chunk of its own
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE2 = np.uint64(0xD1342543DE82EF95)
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x):
    """The finaliser of MurmurHash3: every bit of the result depends on every bit of x."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def inverse(base):
    """The inverse of an odd number modulo 2**64, by Newton's method."""
    b = int(base)
    x = b
    for _ in range(6):
        x = x * (2 - b * x) % (1 << 64)
    return np.uint64(x)


def spread(base):
    """A random-looking 64-bit value for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * base)


def is_space():
    lut = np.zeros(256, bool)
    lut[list(SPACES)] = True
    return lut


def lower():
    """Byte values with A-Z in lower case; bytes of other UTF-8 letters stay."""
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut


class Hasher:
    """Hashes of substrings by one running sum over the bytes."""

    def __init__(self, base=BASE):
        self.base, self.back, self.values = base, inverse(base), spread(base)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n):
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.back)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def load(self, data: np.ndarray):
        n = len(data)
        self._powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.down[:n], out=self.sums[1:])
        return self

    def of(self, start, end):
        """Hash of data[start:end], for arrays of starts and ends."""
        raw = (self.sums[end] - self.sums[start]) * self.up[start]
        return mix(raw + (end - start).astype(np.uint64) * self.base)


def texts(batches, column="text", chunk=CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each Arrow batch in chunks of bounded size: (rows, bytes, offsets of the rows in the bytes).

    Null counts as empty.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if col.null_count:
            col = col.fill_null("" if pa.types.is_string(col.type) else b"")
        if not len(col):
            continue
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        _, offsets, data = col.buffers()
        kind = np.int64 if wide else np.int32
        at = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(col):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + chunk, "right")) - 1)
            hi = min(hi, len(col))
            yield batch.slice(lo, hi - lo), data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            lo = hi


def words(data, offsets, spaces):
    """Starts, ends and row numbers of all words: runs of bytes that are not white space."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    gap = spaces[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = True
    after[offsets[1:][filled] - 1] = True
    start = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def runs(sorted_rows, n):
    """Where each of n rows begins in an ascending array of row numbers, and where the last ends."""
    return np.searchsorted(sorted_rows, np.arange(n + 1))


def shingles(data, offsets, size, hasher, spaces, fold):
    """Distinct word shingles of each row: (row numbers, hashes), by row and then by hash.

    A text with fewer words than `size` has all its words as its one shingle.
    """
    data = fold[data]
    start, end, row = words(data, offsets, spaces)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = hasher.load(data).of(start, end)
    rows, hashes = [], []
    bounds = runs(row, len(offsets) - 1)
    count = np.diff(bounds)
    h = np.zeros(len(w), np.uint64)
    for k in range(1, min(size, len(w)) + 1):
        m = len(w) - k + 1
        h[:m] = h[:m] * BASE2 + w[k - 1 :]
        at = (
            np.flatnonzero(row[:m] == row[k - 1 :]) if k == size
            else bounds[:-1][count == k]
        )
        if len(at):
            rows.append(row[at])
            hashes.append(mix(h[at] + np.uint64(k)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[keep], h[keep]


def set_hash(row, h, n):
    """One hash of each row's set of hashes, and the sizes of the sets. Empty sets have hash 0."""
    bounds = runs(row, n)
    size = np.diff(bounds)
    padded = np.concatenate([[np.uint64(0)], np.cumsum(mix(h * BASE2 + BASE))])
    total = padded[bounds[1:]] - padded[bounds[:-1]]
    out = mix(total + size.astype(np.uint64) * BASE)
    out[size == 0] = 0
    return out, size
