"""Vectorised token streams: what the text operators of this subpackage share inside their Arrow tasks.

A *stream* is a batch of documents laid end to end: one 64-bit value for each token and the
offsets at which documents begin.  Tokens are words or bytes.

Hashes are trees of a two-to-one mixing step.  A word is read in blocks of 8 bytes (long ones in
chunks, whose hashes are hashed in turn).  A span of tokens is hashed from two spans of the largest
power of two of tokens that together cover it, as in a sparse table; those come from doubling.  No
step is a ring homomorphism, so there are no texts (such as Thue-Morse words) on which all hashes of
the family agree, as there are for polynomials modulo 2**64.  Lanes differ in all their constants.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step holds as arrays; a longer document is a step of its own.
STEP_BYTES = 1 << 19
#: Bytes of a word that are hashed in a row; longer words are hashed in chunks of this size.
CHUNK = 64
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_30, _27, _31, _32, _29 = (np.uint64(x) for x in (30, 27, 31, 32, 29))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finaliser)."""
    x = x ^ (x >> _30)
    x *= _M1
    x ^= x >> _27
    x *= _M2
    x ^= x >> _31
    return x


#: Start values and odd factors of the lanes, odd factors of the levels of doubling.
SEEDS = mix(np.array([101, 202], dtype=np.uint64))
FACTORS = mix(np.array([303, 404], dtype=np.uint64)) | np.uint64(1)
LEVELS = mix(np.arange(1000, 1128, dtype=np.uint64)) | np.uint64(1)


def separators(text: bytes) -> np.ndarray:
    """A table over byte values that is true for the given separators."""
    out = np.zeros(256, dtype=bool)
    out[list(text)] = True
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the n + 1 offsets of its rows."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `limit` bytes of text or one longer document."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ranges laid end to end."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Bytes:
    """Reads of up to 8 bytes at any place of an array, and hashes of its ranges."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self.blocks = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))

    def read(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """The n bytes (1 to 8) from each place as one integer."""
        return self.blocks[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.asarray(n).astype(np.uint64) * np.uint64(8)))

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
        n = ends - starts
        h = mix(n.astype(np.uint64) * FACTORS[lane] + SEEDS[lane])
        long = np.flatnonzero(n > CHUNK)
        if len(long):
            count = -(-n[long] // CHUNK)
            a = np.repeat(starts[long], count) + CHUNK * gather(np.zeros(len(long), np.int64), count)
            inner = self.hashes(a, np.minimum(a + CHUNK, np.repeat(ends[long], count)), lane)
            stops = 8 * np.cumsum(count)
            h[long] = mix(h[long] * FACTORS[lane] + Bytes(inner.view(np.uint8)).hashes(stops - 8 * count, stops, lane))
        some = np.flatnonzero((n > 0) & (n <= CHUNK))
        done = 0
        while len(some):
            h[some] = mix(h[some] * FACTORS[lane] + self.read(starts[some] + done, np.minimum(n[some] - done, 8)))
            done += 8
            some = some[n[some] > done]
        return h


class Words:
    """Word bounds and hashes of a batch: starts, ends (byte positions), off (first word of each row)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
        inside = ~sep[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.data, self.offsets = data, offsets
        self.off = np.searchsorted(self.starts, offsets)

    @cached_property
    def bytes(self) -> Bytes:
        return Bytes(self.data)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """A 64-bit value for each word; equal words have equal values in every batch."""
        return self.bytes.hashes(self.starts, self.ends, lane)


def _pair(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """One value for two: a bijection in each of them."""
    x = a * LEVELS[level]
    t = x >> _32
    x ^= t
    x += b
    x *= _M2
    np.right_shift(x, _29, out=t)
    x ^= t
    return x


class Grams:
    """Hashes of any token interval of a stream."""

    #: Level of the values in `tokens`: each stands for 2**first tokens from its place.
    first = 0
    #: Constants of this family among LEVELS.
    shift = 0

    def __init__(self, tokens: np.ndarray, off: np.ndarray):
        self.n, self.off, self.tokens = len(tokens), off, tokens

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))

    @cached_property
    def end(self) -> np.ndarray:
        return np.repeat(self.off[1:], np.diff(self.off))

    @cached_property
    def begin(self) -> np.ndarray:
        return np.repeat(self.off[:-1], np.diff(self.off))

    def _short(self, lo: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        raise NotImplementedError

    def span(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the tokens [lo, hi), at least one each."""
        length = hi - lo
        out = np.empty(len(lo), dtype=np.uint64)
        level = np.frexp(length.astype(np.float64))[1] - 1
        if self.first:
            own = np.flatnonzero(level < self.first)
            out[own] = self._short(lo[own], length[own])
        doubled, most = self.tokens, int(level.max()) if len(level) else -1
        for j in range(self.first, most + 1):
            own = np.flatnonzero(level == j)
            if len(own):
                out[own] = _pair(doubled[lo[own]], doubled[hi[own] - (1 << j)], 32 + j + self.shift)
            if j < most:
                doubled = _pair(doubled[: -(1 << j)], doubled[1 << j :], j + self.shift)
        return mix(out + length.astype(np.uint64))

    def whole(self, k: int) -> np.ndarray:
        """Whether the k tokens from each position are in one document."""
        return np.arange(self.n) + k <= self.end

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k tokens from each position, as `span` gives it; meaningless where these aren't in one document."""
        out = np.zeros(self.n, dtype=np.uint64)
        m = self.n - k + 1
        if m > 0 and k < 1 << self.first:
            out[:m] = mix(self._short(np.arange(m), k) + np.uint64(k))
        elif m > 0:
            doubled, j = self.tokens, self.first
            while 2 << j <= k:
                doubled = _pair(doubled[: -(1 << j)], doubled[1 << j :], j + self.shift)
                j += 1
            out[:m] = mix(_pair(doubled[:m], doubled[k - (1 << j) : k - (1 << j) + m], 32 + j + self.shift) + np.uint64(k))
        return out

    def all_windows(self, most: int) -> Iterator[np.ndarray]:
        """`windows(k)` for k from 1 to most, each only as long as whole windows of the stream reach."""
        doubled, j = self.tokens, 0
        for k in range(1, min(most, self.n) + 1):
            if 2 << j <= k:
                doubled = _pair(doubled[: -(1 << j)], doubled[1 << j :], j + self.shift)
                j += 1
            m = self.n - k + 1
            yield mix(_pair(doubled[:m], doubled[k - (1 << j) : k - (1 << j) + m], 32 + j + self.shift) + np.uint64(k))

    def context(self, at: np.ndarray, left: int, right: int) -> np.ndarray:
        """Hash of the tokens [at - left, at + right), cut at the document's ends, with the cuts."""
        lo, hi = np.maximum(at - left, self.begin[at]), np.minimum(at + right, self.end[at])
        return mix(self.span(lo, hi) + mix(((at - lo) << 20 | (hi - at)).astype(np.uint64)))


class ByteGrams(Grams):
    """A stream whose tokens are bytes: up to 8 of them are read as they are, which saves three levels."""

    first = 3

    def __init__(self, data: np.ndarray, off: np.ndarray, lane: int = 0):
        self.bytes, self.shift = Bytes(data), 64 * lane
        super().__init__(self.bytes.blocks[: len(data)].copy(), off)

    def _short(self, lo: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _pair(self.bytes.read(lo, length), np.uint64(0), self.shift)


def winnow(grams: np.ndarray, whole: np.ndarray, w: int) -> np.ndarray:
    """For each position that begins a whole window (w grams of one document), the position of the
    least of these grams (the last of equals), else -1.  Equal windows choose the same offset, whatever
    else the stream holds: grams are compared in full, their places carried along."""
    n = len(grams)
    out = np.full(n, -1)
    if n < w:
        return out
    least, at, step = grams, np.arange(n), 1
    while step < w:
        by = min(step, w - step)
        later = least[by:] <= least[: len(least) - by]
        least, at = np.where(later, least[by:], least[: len(least) - by]), np.where(later, at[by:], at[: len(at) - by])
        step += by
    out[: n - w + 1] = np.where(whole[: n - w + 1], at, -1)
    return out
