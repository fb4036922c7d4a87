"""SentencePiece models of the merge type: exact encoding by backtracking, and decoding.

A token sequence is what merging gives if, and only if, merging each two neighbours' text again gives
those two tokens. The encoder therefore goes through a text once: it takes the longest token that begins at a
place, as the Aho-Corasick automaton found it, and is compatible with the token before. Where none is, it goes back
and takes a shorter one; a bitfield holds the places from which no way leads on.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType

from keytables.llm.frames import extended, tidy
from keytables.llm.token_files import id_lists
from keytables.llm.words import pieces

# Fixed values of the format: the sign for a space, and what the unknown token is decoded to.
SPACE_SIGN, UNKNOWN_TEXT = "▁", " ⁇ "
_SEGMENT = re.compile(f"{SPACE_SIGN}+[^{SPACE_SIGN}]*")
# A process remembers at most so many words' ids and so many pairs; longer words are not remembered.
REMEMBERED, PAIRS, LONGEST = 500_000, 1_000_000, 48


class PieceEncoder:
    """Encodes and decodes with the pieces and scores of a model file.

    The model must be of the merge type with byte fallback, leave texts as they are but for a space put in
    front, and hold no piece with a space after another character; else this raises ValueError.
    """

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.end_id = model.eos_id()
        self._pieces = [model.id_to_piece(i) for i in range(size)]
        skip = {i for i in range(size) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self._bytes = {int(self._pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self._is_byte = set(self._bytes.values())
        # The score is the negative place in the order of merges; a higher one is merged first.
        self._rank = {self._pieces[i]: (-model.get_score(i), i) for i in range(size) if i not in skip}
        letters = {c for p in self._rank for c in p}
        if len(self._bytes) != 256 or any(c not in self._rank for c in letters):
            raise ValueError("the model lacks byte pieces or the pieces of single characters")
        if any(SPACE_SIGN in p.lstrip(SPACE_SIGN) for p in self._rank):
            raise ValueError("the model has pieces that go on after a space")
        if model.encode(" AÀ ①") != self._plain_ids(model, " AÀ ①"):
            raise ValueError("the model changes texts before it encodes them")
        automaton = ahocorasick.Automaton()
        for piece, (_, i) in self._rank.items():
            if len(piece) == 1 or self.merge(piece) == [piece]:
                automaton.add_word(piece, (i, len(piece)))
        automaton.make_automaton()
        self._matches = automaton
        self._compatible: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        spelled = [p.replace(SPACE_SIGN, " ").encode() for p in self._pieces]
        for byte, i in self._bytes.items():
            spelled[i] = bytes([byte])
        for i in range(size):
            if model.is_control(i):
                spelled[i] = b""
            elif model.is_unknown(i):
                spelled[i] = UNKNOWN_TEXT.encode()
        self._spelled = spelled
        self._numbers = [str(i) for i in range(size)]

    def _plain_ids(self, model, text: str) -> list[int]:
        """By plain merging, to compare with the library's result once."""
        out: list[int] = []
        for piece in self.merge(SPACE_SIGN + text.replace(" ", SPACE_SIGN)):
            out += [self._rank[piece][1]] if piece in self._rank else [self._bytes[b] for b in piece.encode()]
        return out

    def merge(self, text: str) -> list[str]:
        """Merging as defined: the best-scored pair of neighbours first, the leftmost of equals."""
        parts, rank = list(text), self._rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = rank.get(parts[i] + parts[i + 1])
                if found and (best is None or found[0] < best):
                    best, at = found[0], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= PAIRS:
                self._compatible.clear()
            left, right = self._pieces[a], self._pieces[b]
            known = self._compatible[key] = self.merge(left + right) == [left, right]
        return known

    def segment_ids(self, text: str) -> list[int]:
        """The ids of a text in which spaces are already signs."""
        begin: list[list[tuple[int, int]]] = [[] for _ in range(len(text) + 1)]
        for end, (i, n) in self._matches.iter(text):
            begin[end - n + 1].append((i, n))  # by rising length
        out: list[int] = []
        path: list[tuple[int, int, int]] = []  # token, where it begins, its place in begin
        failed, at, size, fit = 0, 0, len(text), self._compatible
        k = len(begin[0]) - 1
        while at < size:
            if not path and k < 0:  # a character that no piece holds parts what is before from what is after
                out += [self._bytes[b] for b in text[at].encode()]
                at += 1
                k = len(begin[at]) - 1
                continue
            last = path[-1][0] if path else -1
            choices = begin[at]
            while k >= 0:
                i, n = choices[k]
                if not (failed and failed >> (at + n) & 1):
                    if last < 0:
                        break
                    good = fit.get(last << 32 | i)
                    if good if good is not None else self._fit(last, i):
                        break
                k -= 1
            if k >= 0:
                path.append((i, at, k))
                at += n
                k = len(begin[at]) - 1
                if at < size and k < 0:
                    out += [p[0] for p in path]
                    path.clear()
            else:
                failed |= 1 << at
                _, at, k = path.pop()
                k -= 1
        return out + [p[0] for p in path]

    def encode(self, texts: Sequence[str | None], end: bool = True) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; null is empty, empty has no ids but the end's."""
        stop = array("i", [self.end_id]).tobytes() if end else b""
        known, out = self._known, []
        for text in texts:
            if not text:
                out.append(stop)
                continue
            if len(known) > REMEMBERED:
                known.clear()
            words = text.split(" ")
            if SPACE_SIGN in text or "" in words:
                words = [s[1:] for s in _SEGMENT.findall(SPACE_SIGN + text.replace(" ", SPACE_SIGN))]
            ids = list(map(known.get, words))
            if None in ids:
                for j, found in enumerate(ids):
                    if found is None:
                        word = words[j]
                        found = known.get(word)
                        if found is None:
                            found = array("i", self.segment_ids(SPACE_SIGN + word)).tobytes()
                            if len(word) <= LONGEST:
                                known[word] = found
                        ids[j] = found
            out.append(b"".join(ids) + stop)
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids: no sign for the space in front, and U+FFFD for each byte that fits no character."""
        raw = b"".join(map(self._spelled.__getitem__, ids))
        first = next((i for i in ids if self._spelled[i]), None)
        if first is not None and self._pieces[first].startswith(SPACE_SIGN):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids, skip_space=first is not None and self._pieces[first].startswith(SPACE_SIGN))

    def _decode_broken(self, ids: Sequence[int], skip_space: bool) -> str:
        out: list[str] = []
        run = bytearray()

        def flush() -> None:
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:n]).decode())
                        del run[:n]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    del run[0]

        for i in ids:
            if i in self._is_byte:
                run += self._spelled[i]
            else:
                flush()
                out.append(self._spelled[i].decode())
        flush()
        text = "".join(out)
        return text[1:] if skip_space else text

    def id_text(self, ids: Sequence[int]) -> str:
        """The ids in decimal, joined by one space."""
        return " ".join(map(self._numbers.__getitem__, ids))


@lru_cache(maxsize=4)
def piece_encoder(model_file: str) -> PieceEncoder:
    return PieceEncoder(model_file)


def encode_documents(documents: DataFrame, model_file: str, column: str = "text", into: str = "ids") -> DataFrame:
    """``documents`` with ``into``, the ids of each whole text and an end id.

    A null or empty text has the end id alone. Every row is encoded, repeated ones too. A column
    named as ``into`` is replaced; all others are kept.
    """
    rows = documents.drop(into)
    names = rows.columns

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_file)
        for batch in batches:
            for piece in pieces(batch, column):
                raw = encoder.encode(piece[column].to_pylist())
                ids = id_lists(np.frombuffer(b"".join(raw), "<i4"), np.array([len(x) // 4 for x in raw], np.int64))
                yield pa.RecordBatch.from_arrays([*piece.columns, ids], [*names, into])

    schema = extended(rows.schema, **{into: ArrayType(IntegerType())})
    return rows.mapInArrow(tidy(encode), schema)


def decode_documents(encoded: DataFrame, model_file: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with ``into``, the text of the ids; null where they are. Control ids give no text."""
    rows = encoded.drop(into)
    names = rows.columns

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_file)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch[column].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, into])

    return rows.mapInArrow(tidy(decode), extended(rows.schema, **{into: StringType()}))


def round_trip_digests(documents: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each whole text, encoded and decoded in one go.

    The ids are digested in decimal, joined by one space; both digests are lowercase hex. Null
    texts count as empty; every row gives a row.
    """
    key = dict(documents.dtypes)["doc_id"]

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_file)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            for piece in pieces(batch, "text"):
                counts, ids_sha, text_sha = [], [], []
                for raw in encoder.encode(piece["text"].to_pylist()):
                    ids = np.frombuffer(raw, "<i4").tolist()
                    counts.append(len(ids))
                    ids_sha.append(sha(encoder.id_text(ids)))
                    text_sha.append(sha(encoder.decode(ids)))
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        tidy(digest), f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
