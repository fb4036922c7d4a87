"""Stretches of a text that repeat themselves: all runs of a period and at least four times its length.

A run of period q holds, for the power of two B with B <= q < 2B, two or more neighbouring blocks of B words
that stand at multiples of B and come again q words later. So at each such scale every block is compared with the
window of 2B words that begins B words after it: the sum of squared differences at each distance is a convolution,
taken by number-theoretic transforms modulo as many primes as keep it exact, and 0 means that the block occurs
there. The distances found are extended to both sides as far as words so far apart are equal.

Three things keep the work in proportion to the text, whatever it repeats; none loses a run:

- Blocks are left out that hold a word that does not come again within 2B words, that lie with their whole window in
  a run found at a smaller scale, or that have no such neighbour.
- Three or more distances of one block are in arithmetic progression, and their difference p is the block's period.
  A run of a larger period cannot go on for long in that p, so its distance is where the stretch of period p round
  the block, and that round the occurrences, both begin or both end; other distances are dropped.
- Neighbouring blocks of one distance are extended once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from keytables.llm.frames import extended, tidy
from keytables.llm.words import PIECE_BYTES, Words, join_kept, pieces, spelled, split_words

# Primes below 2**31 with a large power of two in p - 1, and a generator of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
EXPONENT = 4
# Transforms and comparisons are made of about so many numbers at a time.
CHUNK = 1 << 18

RUN = StructType([StructField(name, LongType(), False) for name in ("start", "length", "period")])


class Runs(NamedTuple):
    """Ascending by start, then period; ``start`` counts from the first word of all texts."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


@lru_cache(maxsize=256)
def _twiddles(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    """The powers of a root of unity of order ``2 * size``, ``size`` of them."""
    root = pow(generator, (prime - 1) // (2 * size), prime)
    if inverse:
        root = pow(root, -1, prime)
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * np.uint64(pow(root, done, prime)) % np.uint64(prime)
        done += more
    return out[:, None]


def _forward(a: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The transform of each column in place; values come in bit-reversed order."""
    p, (size, rows) = np.uint64(prime), a.shape
    half = size // 2
    while half:
        v = a.reshape(-1, 2, half, rows)
        total, apart = v[:, 0] + v[:, 1], v[:, 0] + (p - v[:, 1])
        np.minimum(total, total - p, out=v[:, 0])
        v[:, 1] = apart * _twiddles(half, prime, generator, False) % p
        half //= 2
    return a


def _backward(a: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Undoes ``_forward``."""
    p, (size, rows) = np.uint64(prime), a.shape
    half = 1
    while half < size:
        v = a.reshape(-1, 2, half, rows)
        turned = v[:, 1] * _twiddles(half, prime, generator, True) % p
        total, apart = v[:, 0] + turned, v[:, 0] + (p - turned)
        np.minimum(total, total - p, out=v[:, 0])
        np.minimum(apart, apart - p, out=v[:, 1])
        half *= 2
    a *= np.uint64(pow(size, -1, prime))
    a %= p
    return a


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether block i is ``windows[i, k:k + B]``, for each k below B; blocks have B columns, windows 2B.

    B is a power of two, and all values are non-negative. The sum of squared differences is taken modulo primes
    whose product is larger than it can be, so that it is 0 only where it is 0 modulo each.
    """
    rows, size = blocks.shape
    largest = int(max(blocks.max(initial=0), windows.max(initial=0)))
    found = np.ones((rows, size), bool)
    product = 1
    for prime, generator in PRIMES:
        if product > size * largest**2:
            break
        product *= prime
        p = np.uint64(prime)
        a, w = blocks.T.astype(np.uint64) % p, windows.T.astype(np.uint64) % p
        turned = np.zeros((2 * size, rows), np.uint64)
        turned[0] = a[0]
        turned[size + 1 :] = a[:0:-1]
        squares = np.zeros((2 * size + 1, rows), np.uint64)
        np.cumsum(w * w % p, axis=0, out=squares[1:])
        own = (a * a % p).sum(axis=0)
        both = _forward(turned, prime, generator)
        both *= _forward(w, prime, generator)
        both %= p
        crossed = _backward(both, prime, generator)[:size]
        found &= ((own + squares[size : 2 * size] - squares[:size]) % p == 2 * crossed % p).T
    if product <= size * largest**2:
        raise ValueError("the text has too many words for the primes at hand")
    return found


class _Text(NamedTuple):
    """The words of several texts as numbers: ``code`` within each text, ``again`` words on the same one comes next."""

    code: np.ndarray
    again: np.ndarray
    begin: np.ndarray  # of the word's text
    end: np.ndarray


def _numbered(words: Words) -> _Text:
    code = spelled(words).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(words.first) - 1), words.count)
    key = of * (int(code.max(initial=0)) + 1) + code
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    rank = np.concatenate(([0], np.cumsum(~same)))[: len(order)]
    again = np.full(len(order), np.iinfo(np.int64).max)
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    begin = words.first[of]
    code[order] = rank - rank[begin[order]]
    return _Text(code, again, begin, words.first[of + 1])


def _equal_for(text: _Text, at: np.ndarray, apart: np.ndarray, step: int, most: int) -> np.ndarray:
    """For how many steps, ``most`` at the most, words ``at + i * step`` and ``apart`` words on are equal in one text."""
    out = np.empty(len(at), np.int64)
    inside = np.minimum(at, len(text.code) - 1)
    # Places from ``at`` on belong to the text that the block beside it is in.
    home = np.minimum(inside if step > 0 else inside + 1, len(text.code) - 1)
    begin, end = text.begin[home], text.end[home]
    steps = np.arange(most) * step
    for i in range(0, len(at), max(1, CHUNK // most)):
        rows = slice(i, i + max(1, CHUNK // most))
        place = at[rows, None] + steps
        other = place + apart[rows, None]
        low, high = np.minimum(place, other), np.maximum(place, other)
        valid = (low >= begin[rows, None]) & (high < end[rows, None])
        last = len(text.code) - 1
        same = valid & (text.code[np.clip(place, 0, last)] == text.code[np.clip(other, 0, last)])
        out[rows] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return out


def _blocks(text: _Text, first: np.ndarray, size: int, reach: np.ndarray) -> np.ndarray:
    """Where the blocks of ``size`` words begin that may be part of a run of this scale."""
    n = np.diff(first)
    count = np.where(n >= EXPONENT * size, n // size - 1, 0)
    before = np.cumsum(count) - count
    at = np.repeat(first[:-1], count) + (np.arange(count.sum()) - np.repeat(before, count)) * size
    far = np.zeros(len(text.code) + 1, np.int64)
    np.cumsum(text.again >= 2 * size, out=far[1:])
    at = at[far[at + size] == far[at]]
    at = at[reach[at] < np.minimum(at + 3 * size - 1, text.end[at])]
    beside = np.diff(at) == size
    return at[np.concatenate(([False], beside)) | np.concatenate((beside, [False]))] if len(at) else at


def _distances(text: _Text, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and the distances, from ``size`` to ``2 * size - 1``, at which they come again and may lie in a run."""
    places, apart = [], []
    for i in range(0, len(at), max(1, CHUNK // size)):
        t = at[i : i + max(1, CHUNK // size)]
        place = t[:, None] + size + np.arange(2 * size)
        window = text.code[np.minimum(place, len(text.code) - 1)]
        block = text.code[t[:, None] + np.arange(size)]
        window[place >= text.end[t][:, None]] = block.max() + 1  # equal to no word of a block
        found = occurrences(block, window)
        hits = found.sum(axis=1)
        row, k = np.nonzero(found & (hits <= 2)[:, None])
        places.append(t[row])
        apart.append(k + size)
        many = np.flatnonzero(hits > 2)
        if len(many):
            t, found = t[many], found[many]
            lowest = found.argmax(axis=1)
            highest = size - 1 - found[:, ::-1].argmax(axis=1)
            rest = found.copy()
            rest[np.arange(len(t)), lowest] = False
            p = rest.argmax(axis=1) - lowest
            most = 3 * size
            left = t - _equal_for(text, t - 1, p, -1, most)
            right = t + size + _equal_for(text, t + size, -p, 1, most)
            low, high = t + size + lowest, t + size + highest
            left_there = low - _equal_for(text, low - 1, p, -1, most)
            right_there = high + size + _equal_for(text, high + size, -p, 1, most)
            for d in (left_there - left, right_there - right):
                good = (d >= size) & (d < 2 * size)
                good[good] = found[np.flatnonzero(good), d[good] - size]
                places.append(t[good])
                apart.append(d[good])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(apart), np.concatenate(places)], axis=1), axis=0)
    return pairs[:, 1], pairs[:, 0]


def _extended(text: _Text, at: np.ndarray, apart: np.ndarray, size: int) -> np.ndarray:
    """Stretches (start, length, period) round two or more neighbouring blocks of one distance."""
    if not len(at):
        return np.empty((0, 3), np.int64)
    cut = np.flatnonzero((np.diff(apart) != 0) | (np.diff(at) != size)) + 1
    begin, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    long = last > begin
    start, end, d = at[begin[long]], at[last[long]] + size, apart[begin[long]]
    if not len(start):
        return np.empty((0, 3), np.int64)
    before = _equal_for(text, start - 1, d, -1, size)
    after = _equal_for(text, end, d, 1, size)
    # A whole block more that was left out is no part of a run of this period.
    length = end - start + before + after + d
    good = (before < size) & (after < size) & (length >= EXPONENT * d)
    return np.stack([start - before, length, d], axis=1)[good]


def runs_of(words: Words) -> Runs:
    """All stretches that no word extends, of a smallest period q and at least 4 * q words, in each text."""
    if not len(words.start):
        return Runs(*(np.empty(0, np.int64) for _ in range(3)))
    text = _numbered(words)
    found = np.empty((0, 3), np.int64)
    longest, size = int(words.count.max()), 1
    while EXPONENT * size <= longest:
        reach = np.zeros(len(text.code), np.int64)
        np.maximum.at(reach, found[:, 0], found[:, 0] + found[:, 1])
        at = _blocks(text, words.first, size, np.maximum.accumulate(reach))
        new = _extended(text, *_distances(text, at, size), size)
        found = np.concatenate((found, new))
        size *= 2
    # A stretch of a period has all its multiples, too: the smallest one is its own.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return Runs(*found.T)


def _row_batch(batch: pa.RecordBatch, text: str, least_length: int, schema: pa.Schema) -> pa.RecordBatch:
    words = split_words(batch[text])
    runs = runs_of(words)
    long = runs.length >= least_length
    start, length, period = (x[long] for x in runs)
    dropped = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    data, at = join_kept(words, np.cumsum(dropped[:-1]) == 0)
    collapsed = pa.array([data[a:b].tobytes() for a, b in at.tolist()], pa.binary()).cast(pa.string())
    of = np.searchsorted(words.first, start, "right") - 1
    inner = pa.StructArray.from_arrays(
        [pa.array(x) for x in (start - words.first[of], length, period)], fields=list(schema.field(-2).type.value_type)
    )
    offsets = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(offsets), inner, type=schema.field(-2).type)
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(words.count.astype(np.int64)), listed, collapsed], schema=schema
    )


def find_runs(
    documents: DataFrame,
    text: str = "text",
    least_length: int = 6,
    n_words: str = "n_words",
    runs: str = "runs",
    collapsed: str = "collapsed",
) -> DataFrame:
    """Adds to each document how many words it has, its runs, and the text without their repetitions.

    Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, compared as they are. A run is a stretch of
    consecutive words whose smallest period is q (words q apart are the same), of at least ``least_length`` and 4 * q
    words, that no neighbouring word extends. ``runs`` lists them by start, then period, with word numbers from 0.
    ``collapsed`` holds the words, joined by one space, that no run contains after its first q words.

    A null or empty text has no words, an empty list and the empty text. Every row is worked on by itself,
    so repeated ids and rows do not matter; columns named as the new ones are replaced. Whole texts
    are taken, one task's memory holds about forty times its longest text.
    """
    documents = documents.drop(n_words, runs, collapsed)
    kinds = {n_words: LongType(), runs: ArrayType(RUN, False), collapsed: StringType()}
    out = extended(documents.schema, **kinds)

    @tidy
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out, prefers_large_types=False)
        for batch in batches:
            batch = batch.cast(pa.schema([schema.field(i) for i in range(batch.num_columns)]))
            for piece in pieces(batch, text, PIECE_BYTES):
                yield _row_batch(piece, text, least_length, schema)

    return documents.mapInArrow(found, out)


def longest_run(runs: str = "runs"):
    """The longest run as a struct: of equally long ones that of the smallest start, then period; null without any."""
    ranked = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    return F.when(
        ranked.isNotNull(),
        F.struct((-ranked["s"]).alias("start"), ranked["length"].alias("length"), (-ranked["p"]).alias("period")),
    )
