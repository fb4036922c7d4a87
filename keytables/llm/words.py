"""Words, shingles and their hashes over whole Arrow columns of text, in numpy.

All functions work on the UTF-8 bytes of many texts at once. A word is a maximal run of bytes other
than 0x20 and 0x09-0x0D. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse modulo 2**64
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

# Texts are worked on in pieces of about so many bytes, whatever the Arrow batch holds. The arrays made of a piece take
# up to a hundred times as much.
PIECE_BYTES = 1024 * 1024


class Words(NamedTuple):
    """``data[start[i]:end[i]]`` is word i; text d has the words ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``max_bytes`` of text; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    return _split(texts, ~SPACES, lower)


def split_terms(texts: pa.Array) -> Words:
    """Terms in place of words: maximal runs of digits, letters and bytes from 0x80 on, A-Z in lower case."""
    return _split(texts, _TERM, lower=True)


def _split(texts: pa.Array, inner: np.ndarray, lower: bool) -> Words:
    data, at = text_bytes(texts)
    if lower:
        data = LOWER[data]
    word = inner[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], word[:-1])) & ~edge[:-1] if len(word) else word
    after = np.concatenate((word[1:], [False])) & ~edge[1:] if len(word) else word
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, at))


def spelled(words: Words) -> pa.Array:
    """The words' bytes as an Arrow array."""
    offsets = np.zeros(len(words.start) + 1, np.int64)
    np.cumsum(words.end - words.start, out=offsets[1:])
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[words.start] += 1  # no two words begin at one place, or end at one
    edge[words.end] -= 1  # where one text ends in a word the next may begin with one
    data = words.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    return pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of each 64-bit value; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _powers = (out[0], out[1])
    return _powers


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each byte range: a polynomial in the bytes' random values, modulo 2**64."""
    power, inverse = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    value = sums[1:]  # all in place: these are the largest arrays there are
    np.take(_BYTE, data, out=value)
    value *= power[: len(data)]
    np.cumsum(value, out=value)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    return range_hashes(words.data, words.start, words.end)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of words i to i + size - 1, for each i where so many follow, texts not regarded."""
    n = max(len(hashes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out *= _STEP
        out += hashes[j : j + n]
    return mix(out)


def inside(words: Words, size: int) -> np.ndarray:
    """Whether words i to i + size - 1 are of one text, for each i that ``shingle_hashes`` gives."""
    n = max(len(words.start) - size + 1, 0)
    last = np.repeat(words.first[1:], words.count)[:n]
    return np.arange(n) + size <= last


def join_kept(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each text joined by one space: all bytes, and where each text begins and ends."""
    count = np.zeros(len(words.start) + 1, np.int64)
    np.cumsum(kept, out=count[1:])
    start, end = words.start[kept], words.end[kept]
    first = count[words.first]
    lengths = end - start + 1  # with a space after each
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    out = np.full(at[-1], 0x20, np.uint8)
    if len(start):
        take = np.zeros(len(words.data) + 1, np.int8)
        take[start] += 1
        take[end] -= 1
        inner = np.ones(at[-1], bool)
        inner[at[1:] - 1] = False
        out[inner] = words.data[np.cumsum(take[:-1]).astype(bool)]
    begin = at[first[:-1]]
    stop = np.where(np.diff(first) > 0, at[first[1:]] - 1, begin)
    return out, np.stack([begin, stop], axis=1)


def take_lists(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``values[start[i]:start[i] + length[i]]`` for each i, one after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return values[np.repeat(start - before, length) + np.arange(total)]
