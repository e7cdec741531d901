"""Vectorised text primitives over Arrow string columns (numpy, no per-row Python).

All functions work on the raw UTF-8 bytes of a slice of a batch. Words are maximal runs of bytes other than
space and 0x09-0x0D, after A-Z have been lower-cased; both rules touch ASCII only, so they are the same on bytes
and on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(_BASE), -1, 1 << 64))
_pow = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..n."""
    if len(_pow[0]) <= n:
        size = (n // SLICE_BYTES + 1) * SLICE_BYTES + 1
        for k, step in enumerate((_BASE, _INV)):
            seq = np.full(size, step, dtype=U64)
            seq[0] = 1
            _pow[k] = np.multiply.accumulate(seq)
    return _pow[0], _pow[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the public splitmix64 one)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes: (first row, end row, bytes, offsets from 0).

    Null texts count as empty. A text longer than ``limit`` is a run of its own, whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_bounds(buf: np.ndarray, offs: np.ndarray, solid: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each document the index of its first word (one more entry at the end).

    ``solid`` tells for each byte whether it belongs to words."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    solid = solid[buf]
    edge = np.zeros(n + 1, dtype=bool)  # a document begins here
    edge[offs] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    fwd, back = _powers(len(low))
    run = np.empty(len(low) + 1, dtype=U64)
    run[0] = 0
    np.cumsum((low.astype(U64) + U64(1)) * fwd[: len(low)], out=run[1:])
    h = (run[ends] - run[starts]) * back[starts]
    h ^= (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(h + U64(salt))


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each lower-cased word, and the index of each document's first word."""
    starts, ends, first = word_bounds(buf, offs)
    return span_hashes(LOWER[buf], starts, ends), first


_MUL = [U64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x87C37B91114253D5, 0x4CF5AD432745937F)]


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one after the other, and where each document's begin.

    A document with fewer than ``size`` words, but at least one, has its whole sequence as its only shingle.
    """
    n_words = np.diff(first)
    n_docs = len(n_words)
    total = len(words)
    per = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    begin = np.zeros(n_docs + 1, np.int64)
    np.cumsum(per, out=begin[1:])
    out = np.empty(begin[-1], dtype=U64)
    if total >= size:
        acc = words[: total - size + 1] * _MUL[0]
        for k in range(1, size):
            acc = mix(acc + words[k : total - size + 1 + k]) * _MUL[k % 8]
        where = np.repeat(first[:-1] - begin[:-1], per) + np.arange(begin[-1])
        whole = np.repeat(n_words >= size, per)
        if whole.all():
            out[:] = mix(acc[where])
        else:
            out[whole] = mix(acc[where[whole]])
    for d in np.flatnonzero((n_words > 0) & (n_words < size)):
        acc = U64(int(n_words[d]) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        seq = words[first[d] : first[d + 1]]
        x = np.array([acc], dtype=U64)
        for k in range(len(seq)):
            x = mix(x + seq[k : k + 1]) * _MUL[k % 8]
        out[begin[d]] = mix(x)[0]
    for d in np.flatnonzero(per > 1):
        out[begin[d] : begin[d + 1]].sort()
    fresh = np.ones(len(out), dtype=bool)
    if len(out) > 1:
        fresh[1:] = out[1:] != out[:-1]
        fresh[begin[:-1][per > 0]] = True
    count = np.zeros(len(out) + 1, np.int64)
    np.cumsum(fresh, out=count[1:])
    return out[fresh], count[begin]


class HashIndex:
    """Static map from 64-bit hashes to row numbers: sorted keys, entered by their top bits."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        bits = max(1, int(np.ceil(np.log2(max(2, len(keys))))) + 1)
        self.shift = U64(64 - bits)
        top = (self.keys >> self.shift).astype(np.int64)
        self.start = np.searchsorted(top, np.arange((1 << bits) + 1)).astype(np.int32)

    def find(self, query: np.ndarray) -> np.ndarray:
        """Row number of each query hash in the given keys, -1 where there is none."""
        found = np.full(len(query), -1, np.int64)
        if not len(self.keys):
            return found
        bucket = (query >> self.shift).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        # most queries meet an empty bucket or are settled by the first key
        open_ = np.flatnonzero(at < end)
        at, end = at[open_], end[open_]
        while len(open_):
            hit = self.keys[at] == query[open_]
            found[open_[hit]] = self.order[at[hit]]
            at += 1
            more = ~hit & (at < end)
            open_, at, end = open_[more], at[more], end[more]
        return found
