"""Token ids of a corpus as ORC files: written in document order, read stripe by stripe.

ORC packs the ids with its integer run-length encoding, keeps minima and maxima of ``doc_id`` for each
stripe and row group, and Bloom filters on it. A reader that asks for some documents skips files'
stripes and row groups by these; Spark reads the stripes of a file in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keytables.llm.frames import tidy
from keytables.llm.words import SPACES, pieces, range_hashes, take_lists, text_bytes

# Texts are encoded in pieces of about so many bytes.
PIECE_BYTES = 2 * 1024 * 1024


def _white_ends(data: np.ndarray) -> np.ndarray:
    """Whether a byte is the last of a character with Unicode's White_Space property."""
    ends = SPACES[data]
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    at = lead[lead + 1 < len(data)]
    second = data[at + 1]
    ends[at[(data[at] == 0xC2) & ((second == 0x85) | (second == 0xA0))] + 1] = True
    at = lead[lead + 2 < len(data)]
    three = data[at].astype(np.int64) << 16 | data[at + 1].astype(np.int64) << 8 | data[at + 2]
    # U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F and U+3000 in UTF-8.
    white = (three == 0xE19A80) | ((three >= 0xE28080) & (three <= 0xE2808A)) | np.isin(
        three, (0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080)
    )
    ends[at[white] + 2] = True
    return ends


def _white_begins(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a byte is the first of such a character; ``ends`` says which bytes are the last."""
    begins = SPACES[data]
    last = np.flatnonzero(ends & ~begins)
    begins[last - np.where(data[last - 1] == 0xC2, 1, 2)] = True
    return begins


class TextEncoder:
    """Encodes whole texts with a byte-level BPE tokenizer of the tokenizers library.

    Such a tokenizer cuts a text before a single space between two characters that are no white space,
    whatever else surrounds them. So texts are cut there, and each distinct part is encoded once.
    Parts are told apart by a 64-bit hash. The ids of up to ``remember`` parts are kept in flat arrays from one
    call to the next; then those seen only once are let go, or all, if they are few. That changes no result.
    """

    def __init__(self, tokenizer_file: str, remember: int = 1_000_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self.size = size = self._tokenizer.get_vocab_size()
        self._spaced = np.array([(self._tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self._remember = remember
        self._hashes = np.empty(0, np.uint64)  # sorted
        self._start = self._length = np.empty(0, np.int32)
        self._seen = np.empty(0, np.int8)
        self._ids = np.empty(0, np.int32)

    def _let_go(self) -> None:
        keep = np.flatnonzero(self._seen > 1)
        if len(keep) > self._remember // 2:
            keep = keep[:0]
        self._ids = take_lists(self._ids, self._start[keep], self._length[keep])
        self._hashes, self._length = self._hashes[keep], self._length[keep]
        self._start = (np.cumsum(self._length) - self._length).astype(np.int32)
        self._seen = np.ones(len(keep), np.int8)

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _learn(self, hashes: np.ndarray, parts: list[str], head: np.ndarray) -> None:
        """Add the ids of parts not known yet. ``head`` says which begin a text; the others follow a space.

        Many parts go through the tokenizer as one text: a token begins with a space if, and only if, it is
        the first of a part. Parts that hold a space themselves, and heads, go alone.
        """
        lone = np.array([h or " " in p for p, h in zip(parts, head.tolist())], bool)
        alone = np.flatnonzero(lone)
        ids = self._each([parts[i] if head[i] else f" {parts[i]}" for i in alone])
        lengths = [np.array([len(x) for x in ids], np.int64)]
        rest = np.flatnonzero(~lone)
        for i in range(0, len(rest), 10_000):
            some = rest[i : i + 10_000].tolist()
            found = self._each([" " + " ".join([parts[j] for j in some])])[0]
            begin = np.flatnonzero(self._spaced[found])
            if len(begin) != len(some):
                raise ValueError("this tokenizer joins words or cuts within them at spaces")
            ids.append(found)
            lengths.append(np.diff(begin, append=len(found)))
        length = np.concatenate(lengths)
        start = np.cumsum(length) - length + len(self._ids)
        added = hashes[np.concatenate([alone, rest])]
        order = np.argsort(added)
        added = added[order]
        at = np.searchsorted(self._hashes, added)
        self._hashes = np.insert(self._hashes, at, added)
        self._start = np.insert(self._start, at, start[order].astype(np.int32))
        self._length = np.insert(self._length, at, length[order].astype(np.int32))
        self._seen = np.insert(self._seen, at, np.int8(0))
        self._ids = np.concatenate([self._ids, *ids])

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has; null is empty.

        ``end_id`` is appended to each text.
        """
        data, at = text_bytes(texts)
        ends = _white_ends(data)
        begins = _white_begins(data, ends)
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        inner = np.flatnonzero(data == 0x20)
        inner = inner[(inner > 0) & (inner < len(data) - 1) & ~edge[inner] & ~edge[inner + 1]]
        cut = inner[~ends[inner - 1] & ~begins[inner + 1]]
        texts_n = len(at) - 1
        start = np.concatenate([at[:-1], cut + 1])
        order = np.argsort(start, kind="stable")
        start, head = start[order], order < texts_n
        # A part ends before the space of the next one, a text's last part where the text ends.
        stop = np.append(start[1:] - ~head[1:], len(data))[: len(start)]
        hashes = range_hashes(data, start, stop)
        hashes[head] ^= np.uint64(0x5555555555555555)
        distinct, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._hashes) > self._remember:
            self._let_go()
        new = np.flatnonzero(~np.isin(distinct, self._hashes, assume_unique=True))
        raw, where = data.tobytes(), first[new]
        parts = [raw[a:b].decode() for a, b in zip(start[where].tolist(), stop[where].tolist())]
        self._learn(distinct[new], parts, head[where])
        known = np.searchsorted(self._hashes, distinct)
        self._seen[known] = np.minimum(self._seen[known], 100) + 1
        begin, length = (x[known[codes]].astype(np.int64) for x in (self._start, self._length))
        values = self._ids
        firsts = np.flatnonzero(head)
        if end_id is not None:
            lasts = np.append(firsts[1:], len(start))[:texts_n]
            begin = np.insert(begin, lasts, len(values))
            length = np.insert(length, lasts, 1)
            values = np.append(values, np.int32(end_id))
            firsts = firsts + np.arange(texts_n)
        counts = np.add.reduceat(length, firsts) if texts_n else np.empty(0, np.int64)
        return take_lists(values, begin, length), counts


@lru_cache(maxsize=4)
def text_encoder(tokenizer_file: str) -> TextEncoder:
    return TextEncoder(tokenizer_file)


def id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow array of lists, the next ``counts`` ids each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def write_token_files(
    documents: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int | None = 2,
    stripe_bytes: int = 16 * 1024 * 1024,
    index_rows: int = 1000,
    bloom_fpp: float = 0.01,
) -> None:
    """Encode ``documents`` (``doc_id, text``) and write the ids to ``path`` as ORC, by ascending ``doc_id``.

    Columns: ``doc_id``; ``part``, the number of the file in document order; ``at``, the ids before the
    document in its file; ``n_tokens``; ``ids``. ``end_id`` is appended to each document. A null text is an
    empty one. Documents with a null ``doc_id`` come first; rows that share one are ordered by a
    hash of their text, and each is written. Other columns are not read. The texts are dealt out by ranges of
    ``doc_id`` and sorted before they are encoded, so that ids are never shuffled.
    """
    key = dict(documents.dtypes)["doc_id"]
    tie = F.xxhash64("text")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_file)
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                ids, counts = encoder.encode(piece["text"], end_id)
                before = at + np.cumsum(counts) - counts
                at += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece["doc_id"],
                        pa.array(np.full(piece.num_rows, part, np.int32)),
                        pa.array(before),
                        pa.array(counts),
                        id_lists(ids, counts),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "ids"],
                )

    (
        documents.select("doc_id", "text")
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
        .mapInArrow(tidy(encode, every=10), f"doc_id {key}, part int, at long, n_tokens long, ids array<int>")
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", bloom_fpp)
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The files' rows; with ``doc_ids``, of these documents, by the files' indexes and Bloom filters."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def token_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before, to rows with ``part, at``.

    ``files`` are the rows of the token files, of which only ``part`` and ``n_tokens`` are read here. The running
    sum goes over one row per file, whatever the files hold.
    """
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))
    return rows.join(firsts, on="part").withColumn("start", F.col("first") + F.col("at")).drop("first")


def token_digests(rows: DataFrame) -> DataFrame:
    """``doc_id, part, at, n_tokens, ids_crc32`` of rows with ``ids``, which are read once."""
    key = dict(rows.dtypes)["doc_id"]

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            ends = ids.offsets.to_numpy()
            raw = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4").view(np.uint8).data
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            counts = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], batch["at"], counts, pa.array(sums, pa.int64())],
                ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
            )

    return rows.select("doc_id", "part", "at", "ids").mapInArrow(
        tidy(digest), f"doc_id {key}, part int, at long, n_tokens long, ids_crc32 long"
    )
