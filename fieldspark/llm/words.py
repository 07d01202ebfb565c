"""Words and word windows of whole texts as numpy arrays, for use inside Arrow-batched tasks.

Works on the UTF-8 bytes of a batch: both word definitions only test bytes below 0x80, so that every byte of a longer
character belongs to a word, and only A-Z are lower-cased. A word's hash takes eight bytes a step through a mixing
bijection, a long one as a tree of pieces; no sum or product over all letters is involved, so that texts built to
collide under polynomials don't. Equal words have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one vector operation handles; a longer text is handled alone.
CHUNK = 1 << 19
U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
#: Bytes of a word that are hashed in a row; a longer one is cut into such pieces.
PIECE = 64
#: The bytes of a word's last eight that belong to it.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _mask(separators: Iterator[range]) -> np.ndarray:
    mask = np.ones(256, bool)
    for r in separators:
        mask[list(r)] = False
    return mask


#: [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
SPACED = _mask([range(0x20, 0x21), range(0x09, 0x0E)])
ALNUM = _mask([range(0x30), range(0x3A, 0x61), range(0x7B, 0x80)])
ALNUM[0x41:0x5B] = True
_folded = np.arange(256, dtype=U)
_folded[0x41:0x5B] += U(32)
FOLD = _folded.astype(np.uint8)

def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two spans side by side from theirs."""
    return mix(a * ODD + b)


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span data[start:end] of bytes."""
    size = end - start
    out = mix(size.astype(U) + ODD)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))  # the eight bytes from each place on
    at, step = np.flatnonzero(size <= PIECE), 0
    while len(at):
        left = size[at] - step
        out[at] = joined(out[at], eight[start[at] + step] & MASKS[np.minimum(left, 8)])
        step += 8
        at = at[left > 8]
    long = np.flatnonzero(size > PIECE)
    if len(long):
        pieces = -(-size[long] // PIECE)
        first = np.cumsum(pieces) - pieces
        own = np.repeat(np.arange(len(long)), pieces)
        begin = start[long][own] + (np.arange(len(own)) - first[own]) * PIECE
        parts = spans_hash(data, begin, np.minimum(begin + PIECE, end[long][own])).astype("<u8").view(np.uint8)
        out[long] = joined(out[long], spans_hash(parts, 8 * first, 8 * (first + pieces)))
    return out


def runs_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` of ``hashes``, put together from runs of powers of two."""
    out, done, power, size = None, 0, hashes, 1
    while True:
        if k & size:
            n = len(hashes) - done - size + 1
            out = power if out is None else joined(out[:n], power[done : done + n])
            done += size
        if done == k:
            return mix(out + U(k * int(ODD) % (1 << 64)))
        power, size = joined(power[:-size], power[size:]), 2 * size


@dataclass
class Words:
    """The words of some texts: byte bounds, hash, and the first word of each text in ``first`` (one longer)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def windows(self, k: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first word, text) of all windows of ``k`` words; with ``short``, texts of fewer words give one."""
        count = np.diff(self.first)
        text = np.repeat(np.arange(len(count)), count)
        at = np.flatnonzero(np.arange(len(text)) + k <= self.first[1:][text])
        hashes = runs_hash(self.hash, k)[at] if len(at) else np.zeros(0, U)
        if not short:
            return hashes, at, text[at]
        few = np.flatnonzero((count > 0) & (count < k))
        own = np.zeros(len(few), U)
        for n in range(1, k):
            same = np.flatnonzero(count[few] == n)
            if len(same):
                begin = self.first[few[same]]
                own[same] = runs_hash(self.hash[begin[:, None] + np.arange(n)].ravel(), n)[::n]
        at, text = np.concatenate([at, self.first[few]]), np.concatenate([text[at], few])
        order = np.argsort(at, kind="stable")
        return np.concatenate([hashes, own])[order], at[order], text[order]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    size = 8 if wide else 4
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * size).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes together, or one longer text alone."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray, fold: bool = True) -> Words:
    """The words of the texts data[bounds[i]:bounds[i+1]]; ``kind`` is SPACED or ALNUM. With ``fold``, hashes are those of
    words whose A-Z are lower-cased."""
    return runs_of(data, bounds, kind[data], fold)


def runs_of(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, fold: bool = True) -> Words:
    """As ``words``, of the bytes that are ``inside``."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, U), np.zeros(len(bounds), np.int64))
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = bounds[(bounds > 0) & (bounds < n)]
    begins[cut] |= inside[cut]
    ends[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, spans_hash(FOLD[data] if fold else data, start, end), np.searchsorted(start, bounds))


def spelled(w: Words, pick: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One text for each run pick[bounds[i]:bounds[i+1]] of word numbers: those words, unchanged, with a space between two."""
    size = (w.end - w.start)[pick]
    room = size + 1
    last = bounds[1:][np.diff(bounds) > 0] - 1
    room[last] -= 1  # no space after a text's last word
    ends = np.cumsum(room)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    step = CHUNK // 8
    for i in range(0, len(pick), step):
        n = size[i : i + step]
        own = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        out[(ends - room)[i : i + step][own] + inside] = w.data[w.start[pick[i : i + step]][own] + inside]
    offsets = np.concatenate([[0], ends])[bounds].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def folded(w: Words, i: int, j: int) -> bytes:
    """Words i to j as one lower-cased text with single spaces: what a window says, for exact comparison."""
    return b" ".join(FOLD[w.data[a:b]].tobytes() for a, b in zip(w.start[i:j], w.end[i:j]))


class SortedHashes:
    """Membership and places of 64-bit hashes in a sorted array; a bit table screens out most of those absent."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes.astype(U))
        bits = min(26, max(16, 4 + int(len(self.sorted)).bit_length()))
        self.shift = U(64 - bits)
        self.screen = np.zeros(1 << bits, bool)
        self.screen[self.sorted >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where in ``hashes``, place in the sorted array) of those present."""
        if not len(self.sorted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.screen[hashes >> self.shift])
        place = np.searchsorted(self.sorted, hashes[at])
        place[place == len(self.sorted)] = 0
        hit = self.sorted[place] == hashes[at]
        return at[hit], place[hit]
