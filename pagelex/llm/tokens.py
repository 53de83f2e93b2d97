"""Word and shingle hashes of whole texts with numpy, a few megabytes at a time.

A word's hash is a polynomial over its bytes modulo 2**64, taken as the difference of two
prefix sums, so that a block of documents needs a fixed number of array operations. Hashes
are 64 bits wide: two different words of one comparison are the same with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 256 << 10
U = np.uint64
INDEX_BITS = 20
_LOWER_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_P = U(0x9E3779B97F4A7C15)
_Q = U(0xD6E8FEB86659FD93)


def _inverse(odd: int) -> np.uint64:
    return U(pow(odd, -1, 1 << 64))


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, n of them; kept while they are short."""
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        got = np.ones(max(n, BLOCK_BYTES + 1), U)
        np.cumprod(np.full(len(got) - 1, base, U), out=got[1:])
        if n <= 4 * BLOCK_BYTES:
            _powers[int(base)] = got
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (a bijection)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def table(*members) -> np.ndarray:
    """A byte class: true at the given byte values."""
    out = np.zeros(256, bool)
    for m in members:
        out[m] = True
    return out


def not_space() -> np.ndarray:
    return ~table(32, slice(9, 14))


def letters() -> np.ndarray:
    """ASCII letters and every byte of a character beyond ASCII."""
    return table(slice(65, 91), slice(97, 123), slice(128, 256))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def blocks(batches, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text each (or one longer text),
    with the texts' bytes and their offsets. A null text is empty."""
    for batch in batches:
        col = batch.column(column)
        if not pa.types.is_string(col.type):
            col = col.cast(pa.string())
        col = pc.fill_null(col, "")
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        if len(col) == 0:
            continue
        _, offs, data = col.buffers()
        off = np.frombuffer(offs, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


class Runs:
    """Runs of bytes of one class: ``start`` and ``end`` of each, ``first`` run of each text
    (length + 1), and hashes of the runs or of their first bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        n = len(data)
        inside = member[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sum = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(_P, n), out=self._sum[1:])
        self._scale = powers(_inverse(int(_P)), n + 1)[self.start]

    def hashes(self, longest: int | None = None, which=slice(None)) -> np.ndarray:
        start, end = self.start[which], self.end[which]
        if longest is not None:
            end = np.minimum(end, start + longest)
        return mix((self._sum[end] - self._sum[start]) * self._scale[which] + (end - start).astype(U) * _Q)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, by whole-array steps on bytes."""
    return data | (((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))


def in_words(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word ``[^\\x20\\x09-\\x0D]+``."""
    return (data != 32) & ((data - np.uint8(9)) > 4)


def bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of bytes that are ``inside``; a run ends with its text."""
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(padded[1:] & (~padded[:-1] | edge))
    end = np.flatnonzero(padded[:-1] & (~padded[1:] | edge))
    return start, end


def bytes_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes, eight bytes at a time; most words have one such step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), padded.data, 0, (1,))  # from each byte on
    out = (end - start).astype(U) * _P
    which, at = slice(None), start
    while len(at):
        left = end[which] - at
        out[which] = mix(out[which] * _Q + (eight[at] & _LOWER_BYTES[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        which = more if isinstance(which, slice) else which[more]
        at = at[more] + 8
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z, and each text's first one."""
    runs = Runs(lower_ascii(data), offsets, not_space())
    return runs.hashes(), runs.first


def shingle_hashes(h: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows of each text, in order, and each text's first one. A text of
    fewer words has its whole sequence as one; a text without words has none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=out_first[1:])
    at = np.arange(out_first[-1]) + np.repeat(first[:-1] - out_first[:-1], count)
    size = np.repeat(np.minimum(n, k), count)
    out = np.zeros(len(at), U)
    padded = np.concatenate([h, np.zeros(k, U)])
    for j in range(k):
        out = out * _Q + np.where(j < size, padded[at + j], U(0))
    return mix(out + size.astype(U) * _P), out_first


def hash_index(h: np.ndarray) -> np.ndarray:
    """For sorted hashes: where each value of their top bits begins."""
    return np.searchsorted(h >> U(64 - INDEX_BITS), np.arange((1 << INDEX_BITS) + 1)).astype(np.int32)


def find(sorted_hashes: np.ndarray, top: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each hash among the sorted ones, or -1."""
    out = np.full(len(h), -1, np.int64)
    if not len(sorted_hashes):
        return out
    bucket = (h >> U(64 - INDEX_BITS)).astype(np.int64)
    at, end = top[bucket].astype(np.int64), top[bucket + 1]
    left = np.flatnonzero(at < end)
    while len(left):
        hit = sorted_hashes[at[left]] == h[left]
        out[left[hit]] = at[left[hit]]
        left = left[~hit]
        at[left] += 1
        left = left[at[left] < end[left]]
    return out
