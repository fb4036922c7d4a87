"""Language identification: averaged embeddings of hashed subwords under a linear softmax.

The embeddings and the softmax are trained together by stochastic gradient descent in numpy, on a bounded sample. A
temperature fitted on a part of the sample that was not trained on calibrates the probabilities, and the least
probability at which an answer is accepted is read off that part, too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from keytables.llm.frames import extended, tidy
from keytables.llm.sampling import drawn
from keytables.llm.words import LOWER, SPACES, pieces, text_bytes

BUCKETS, WIDTH = 1 << 15, 16
SUBWORDS = (2, 3, 4)
# At most so many documents are trained on (twice as many at the very most, being drawn by hash).
MAX_ROWS = 2_000
UNDETERMINED = "und"


class Model(NamedTuple):
    """``logits`` of each bucket and ``bias`` by language, both divided by the temperature already."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    least: float


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all subwords of each text, one text after the other, and which text each is of.

    Subwords are runs of 2 to 4 bytes of the text, A-Z lower-cased, with at most its first or last byte between words.
    """
    data, at = text_bytes(texts)
    space = SPACES[data]
    data = np.where(space, np.uint8(0x20), LOWER[data]).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    out, of = [], []
    for n in SUBWORDS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        inner = np.zeros(m, bool)
        for j in range(n):
            h = h * np.uint32(0x01000193) + data[j : j + m] + np.uint32(1)
            if 0 < j < n - 1:
                inner |= space[j : j + m]
        h *= np.uint32(0x9E3779B1)
        good = ~inner & (owner[:m] == owner[n - 1 : n - 1 + m]) & ~(space[:m] & space[n - 1 : n - 1 + m])
        out.append((h >> np.uint32(17))[good])
        of.append(owner[:m][good])
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out).astype(np.int64), np.concatenate(of)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 12, rate: float = 0.5) -> Model:
    """``bags`` are the buckets of each document and their counts. Every fifth document calibrates."""
    languages, y = np.unique(np.array(labels, dtype=object).astype(str), return_inverse=True)
    rng = np.random.default_rng(3)
    embedding = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    softmax, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    every = np.arange(len(bags))
    held = every % 5 == 4 if len(bags) >= 20 else np.zeros(len(bags), bool)
    shares = [c / max(c.sum(), 1) for _, c in bags]
    train = every[~held]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            b, share = bags[i][0], shares[i]
            if not len(b):
                continue
            mean = share @ embedding[b]
            p = _softmax((mean @ softmax + bias)[None, :])[0]
            p[y[i]] -= 1
            back = softmax @ p
            softmax -= step * np.outer(mean, p)
            bias -= step * p
            embedding[b] -= step * 20 * share[:, None] * back[None, :]
    logits = embedding @ softmax
    check = every[held] if held.any() else every
    raw = np.array([shares[i] @ logits[bags[i][0]] + bias for i in check]).reshape(len(check), len(languages))
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(_softmax(raw / t)[np.arange(len(check)), y[check]], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(raw / temperature)
    return Model(languages.tolist(), logits / temperature, bias / temperature, _least(p, y[check]))


def _least(p: np.ndarray, y: np.ndarray, wanted: float = 0.99) -> float:
    """The least probability such that answers of that much or more are right in ``wanted`` of the cases."""
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top)
    good = np.flatnonzero(np.cumsum(right[order]) >= wanted * np.arange(1, len(order) + 1))
    return float(top[order[good[-1]]]) if len(good) else 1.0


def train(documents: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Train on ``text`` and non-null ``lang`` of ``documents``, drawn by a hash of ``doc_id`` and ``text`` if there are more."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", "lang", F.xxhash64("text").alias("content")
    )
    total = rows.count()
    if total > max_rows:
        rows = rows.where(drawn(max_rows, total, "doc_id", "content", F.lit("lang")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                buckets, of = subwords(piece["text"])
                keys, counts = np.unique(of * BUCKETS + buckets, return_counts=True)
                ends = np.concatenate(([0], np.cumsum(np.bincount(keys // BUCKETS, minlength=piece.num_rows)))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (keys % BUCKETS, counts)]
                columns = [piece["doc_id"], piece["content"], piece["lang"], *lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "lang", "buckets", "counts"])

    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, content long, lang string, buckets array<int>, counts array<int>"
    found = rows.mapInArrow(tidy(run), schema).limit(2 * max_rows).toArrow()
    found = found.sort_by([(c, "ascending") for c in ("doc_id", "content", "lang")])
    if not found.num_rows:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    bags = [(np.array(b), np.array(c)) for b, c in zip(found["buckets"].to_pylist(), found["counts"].to_pylist())]
    return fit(bags, found["lang"].to_pylist())


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``lang_pred, score, accepted``.

    Only ``text`` is looked at, all of it. ``score`` is the calibrated probability of ``lang_pred``; ``accepted`` says
    whether it reaches what the model asks for. A text that is null or has no letter is ``und``, with a score of 0 and
    not accepted; so is every text if the model knows no language. Repeated rows get equal answers; ties go to the
    first language by name. Columns with these names are replaced.
    """
    own = ["lang_pred", "score", "accepted"]
    documents = documents.drop(*own, "__letters")
    names = documents.columns
    logits = documents.sparkSession.sparkContext.broadcast(model.logits.astype(np.float32))
    languages, bias, least = model.languages, model.bias, model.least

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                n = piece.num_rows
                known = piece["__letters"].to_numpy(zero_copy_only=False).astype(bool) & bool(languages)
                best, score = np.zeros(n, int), np.zeros(n)
                if known.any():
                    buckets, of = subwords(piece["text"])
                    total = np.maximum(np.bincount(of, minlength=n), 1)
                    table = logits.value
                    sums = np.stack([np.bincount(of, table[buckets, k], minlength=n) for k in range(len(languages))], axis=1)
                    p = _softmax(sums / total[:, None] + bias)
                    best, score = p.argmax(axis=1), p.max(axis=1)
                answers = [languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, score, 0.0)
                columns = [piece[c] for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(answers, pa.string()), pa.array(score), pa.array(known & (score >= least))], [*names, *own]
                )

    schema = extended(documents.schema, lang_pred=StringType(), score=DoubleType(), accepted=BooleanType())
    return documents.withColumn("__letters", has_letter(F.col("text"))).mapInArrow(tidy(run), schema)
