"""Vectorised text kernels over Arrow string columns: bytes, words, hashes, windows.

Words are maximal runs of characters other than U+0020 and U+0009 to U+000D. As these are
ASCII, words can be cut on UTF-8 bytes. A null text is an empty text.

Hashes are 64 bits wide and equal on every executor. Byte spans take eight bytes a round, each
mixed into what came before, so spans of one length up to eight bytes never collide and no
regular pattern cancels out; LONG_SPAN bytes and more go through BLAKE2b. Stretches of a sequence
of such hashes are polynomials modulo 2**64 read from prefix sums; that is sound for the short
stretches they name here (a polynomial over thousands of two alternating values is not). Who must be
right whatever the hash says compares bytes (`equal_spans`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEEDS = (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG_SPAN = 4096
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
BLOCK_BYTES = 2 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    found = _powers.get(base)
    if found is None or len(found[0]) <= n:
        size = max(n + 1, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        found = both[0], both[1]
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = found
    return found


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """The hash of each byte span; `which` chooses one of two independent ones."""
    view, left, seed = eights(data), end - start, np.uint64(SEEDS[which])
    h = mix(left.astype(np.uint64) * np.uint64(BASES[which]) + seed)
    long = np.flatnonzero(left >= LONG_SPAN)
    if len(long):
        left = left.copy()
        left[long] = 0
        for i in long.tolist():
            h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=b"%d" % which).digest(), "little")
    own, at = np.flatnonzero(left > 0), 0
    while len(own):
        c = view[start[own] + at] & MASKS[np.minimum(left[own] - at, 8)]
        h[own] = mix((h[own] ^ c) * np.uint64(BASES[which]))
        at += 8
        own = own[left[own] > at]
    return h


def equal_spans(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the `size` bytes of `a` from a_start are those of `b` from b_start."""
    x, y, out = eights(a), eights(b), np.ones(len(size), bool)
    own, at = np.flatnonzero(size > 0), 0
    while len(own):
        same = ((x[a_start[own] + at] ^ y[b_start[own] + at]) & MASKS[np.minimum(size[own] - at, 8)]) == 0
        out[own[~same]] = False
        at += 8
        own = own[same & (size[own] > at)]
    return out


class Prefix:
    """Prefix sums that give the hash of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        n = len(values)
        p, self.inverse = powers(base, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * p[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of stretches of whole rows of about `most` bytes."""
    data, offs = strings(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


class Words:
    """The words of a block: byte spans, and where each row's words start (`first`)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        n = len(data)
        self.data, self.offs = data, offs
        space = SPACE[data]
        cut = np.ones(n + 1, bool)  # a row or a space starts here or ended just before
        cut[1:n] = space[:-1] if n else space
        cut[offs] = True
        self.start = np.flatnonzero(~space & cut[:n])
        cut = np.ones(n + 1, bool)
        cut[:n] = space
        cut[offs] = True
        self.end = np.flatnonzero(~space & cut[1:]) + 1
        self.first = np.searchsorted(self.start, offs)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool = False, which: int = 0) -> np.ndarray:
        return span_hashes(LOWER[self.data] if lower else self.data, self.start, self.end, which)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.first))


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of `size` elements that stay within a row, and each one's row."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(row)) - before[row] + first[row], row


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of `size` elements, by block-wise prefix and suffix minima."""
    n = len(x)
    if n < size:
        return x[:0]
    pad = -n % size
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, size)
    ahead = np.minimum.accumulate(y, 1).ravel()
    behind = np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


def union_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals."""
    if not len(start):
        return start[:0], end[:0]
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(start)) - 1]


def batches(schema: pa.Schema, columns: list, rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
    whole = pa.RecordBatch.from_arrays(arrays, schema=schema)
    for at in range(0, whole.num_rows, rows):
        yield whole.slice(at, rows)
