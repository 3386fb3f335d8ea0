"""Vectorised word splitting and hashing of whole Arrow string batches (numpy).

Texts stay UTF-8 bytes: a batch is one byte array with document offsets, words
are [start, end) byte ranges, and a word's name is a 64-bit hash that is the same
in every task.  ``lanes=2`` gives two independent hashes (128 bits together).
Nothing is per row in Python, and a batch is cut into pieces of a bounded number
of bytes (one document at least).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: ASCII white space: 0x09-0x0D and 0x20.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACE
#: 0-9, A-Z, a-z and everything outside ASCII.
ALNUM = np.ones(256, bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x41] = ALNUM[0x5B:0x61] = ALNUM[0x7B:0x80] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

PIECE_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Two lanes: start value and odd multiplier of each.
_LANES = [(U(0x9E3779B97F4A7C15), U(0x2545F4914F6CDD1D)), (U(0xD1342543DE82EF95), U(0x5851F42D4C957F2D))]
_TAIL = np.array([(1 << (8 * i)) - 1 for i in range(9)], U)
_LONG_WORD = 2048


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def pieces(offs: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


class Words:
    """The words of consecutive documents: byte ranges, document numbers, counts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, keep: np.ndarray = NOT_SPACE, lower: bool = False):
        self.data, self.offs, self.n_docs = (LOWER[data] if lower else data), offs, len(offs) - 1
        inside = keep[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cuts = offs[:-1]
        before[cuts[cuts < len(data)]] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        cuts = offs[1:]
        after[cuts[cuts > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offs, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs) if self.n_docs else np.zeros(0, np.int64)
        #: first word number of each document, and the total
        self.first = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """Eight bytes at a time over all words at once; words past 2 KB by a digest."""
        if not len(self):
            return np.zeros(0, U)
        start, odd = _LANES[lane]
        lens = self.ends - self.starts
        eight = np.ndarray((len(self.data) + 1,), "<u8", buffer=np.concatenate([self.data, np.zeros(8, np.uint8)]), strides=(1,))
        h = lens.astype(U) * odd + start
        huge = lens > _LONG_WORD
        rest, at, left = None, self.starts, lens
        if huge.any():
            for i in np.flatnonzero(huge):
                h[i] = U(int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8, salt=bytes([lane])).digest(), "little"))
            rest = np.flatnonzero(~huge)
            at, left = at[rest], left[rest]
        while len(at):
            v = eight[at] & _TAIL[np.minimum(left, 8)]
            if rest is None:
                h = mix((h ^ v) * odd)
            else:
                h[rest] = mix((h[rest] ^ v) * odd)
            more = left > 8
            rest = np.flatnonzero(more) if rest is None else rest[more]
            at, left = at[more] + 8, left[more] - 8
        return h

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start numbers of all k-word windows inside one document, and their names."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    acc = np.full(n, U(k), U)
    for j in range(k):
        acc = acc * U(0xA0761D6478BD642F) + h[j : j + n]
        acc ^= acc >> U(29)
    return at, mix(acc[at])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
