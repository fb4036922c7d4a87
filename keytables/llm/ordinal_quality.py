"""Document quality by ordinal regression: one score of hashed text features, ordered thresholds between grades.

The cumulative-link model says P(grade > k) = sigmoid(score - threshold[k]) with a score that all grades
share. It is fitted in numpy on a bounded sample of the rated documents; all documents are graded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from keytables.llm.frames import extended, tidy
from keytables.llm.sampling import drawn
from keytables.llm.words import LOWER, Words, mix, pieces, range_hashes, split_words

BUCKETS = 1 << 18
# At most so many rated documents are fitted on (twice as many at the very most, being drawn by hash).
MAX_ROWS = 12_000
# Bytes of a word's beginning that are a feature of their own.
STEM = 4
# A bucket that fewer documents of the sample have says nothing.
LEAST_DOCUMENTS = 6
# Nor one whose mean rating is within so many standard errors of the mean of all.
LEAST_Z = 4.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# The form of a word: one sign for each run of lower-case letters, capitals, digits; other signs as they are.
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91], _FORM[97:123], _FORM[128:256], _FORM[48:58] = 1, 2, 2, 3
_SHARES = np.array([0.02, 0.1, 0.3, 0.6])


class Model(NamedTuple):
    """``weights`` by bucket, the ``thresholds`` between neighbouring grades, and the rising ``grades``."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray


def _cores(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word without the signs around it; words of signs alone are left out."""
    letters = np.flatnonzero(_LETTER[words.data])
    if not len(letters):
        none = np.empty(0, np.int64)
        return none, none, none
    first = np.searchsorted(letters, words.start)
    last = np.searchsorted(letters, words.end) - 1
    some = np.flatnonzero(last >= first)
    return some, letters[first[some]], letters[last[some]] + 1


def _forms(words: Words) -> np.ndarray:
    """A hash of each word's form."""
    form = _FORM[words.data]
    keep = np.ones(len(form), bool)
    keep[1:] = form[1:] != form[:-1]
    keep[words.start] = True
    at = np.concatenate(([0], np.cumsum(keep)))
    return range_hashes(form[keep], at[words.start], at[words.end])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text, one text after the other, and how many each has.

    A text has the words in it and their first bytes, lower-cased and without signs around them; which forms its words have, and
    roughly how large a share each has; and how often words repeat, roughly.
    """
    words = split_words(texts)
    owner = np.repeat(np.arange(len(texts)), words.count)
    some, begin, end = _cores(words)
    lower = LOWER[words.data]
    bucket = (range_hashes(lower, begin, end) >> np.uint64(46)).astype(np.int64)
    core_keys = np.unique(owner[some] * BUCKETS + bucket)
    # Words are built from stems, so their beginnings count as well.
    long = end - begin > STEM
    stems = mix(range_hashes(lower, begin[long], begin[long] + STEM) + np.uint64(STEM))
    stem_keys = np.unique(owner[some[long]] * BUCKETS + (stems >> np.uint64(46)).astype(np.int64))

    form = (mix(_forms(words) + np.uint64(1)) >> np.uint64(46)).astype(np.int64)
    form_keys, seen = np.unique(owner * BUCKETS + form, return_counts=True)
    of = form_keys // BUCKETS
    share = np.searchsorted(_SHARES, seen / words.count[of], "right")
    shared = (mix((form_keys % BUCKETS * 8 + share + 1).astype(np.uint64)) >> np.uint64(46)).astype(np.int64)
    form_keys = of * BUCKETS + shared

    distinct = np.bincount(core_keys // BUCKETS, minlength=len(texts))
    total = np.maximum(np.bincount(owner[some], minlength=len(texts)), 1)
    level = (np.minimum(distinct / total, 1) * 10).astype(np.uint64) * np.uint64(20) + np.log2(total + 1).astype(np.uint64)
    repeat = (mix(level + np.uint64(10**6)) >> np.uint64(46)).astype(np.int64)
    keys = np.unique(np.concatenate([core_keys, stem_keys, form_keys, np.arange(len(texts)) * BUCKETS + repeat]))
    return keys % BUCKETS, np.bincount(keys // BUCKETS, minlength=len(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def telling(buckets: np.ndarray, owner: np.ndarray, ratings: np.ndarray) -> np.ndarray:
    """The buckets whose documents' mean rating is clearly not that of all; copies of a document count once."""
    sums = np.zeros(len(ratings), np.uint64)
    np.add.at(sums, owner, mix(buckets.astype(np.uint64) + np.uint64(1)))
    _, one = np.unique(sums, return_index=True)
    once = np.zeros(len(ratings), bool)
    once[one] = True
    use = once[owner]
    n, around = len(one), ratings - ratings[one].mean()
    documents = np.bincount(buckets[use], minlength=BUCKETS)
    total = np.bincount(buckets[use], around[owner[use]], minlength=BUCKETS)
    spread = np.sqrt(documents * (1 - documents / n) * around[one].var()) if n else documents
    least = min(LEAST_DOCUMENTS, max(1, n // 20))
    return np.flatnonzero((documents >= least) & (np.abs(total) > LEAST_Z * spread))


def fit(buckets: np.ndarray, counts: np.ndarray, ratings: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> Model:
    """Fit by full gradients with Adam. ``ratings`` are any numbers; the distinct ones are the grades."""
    grades, y = np.unique(ratings, return_inverse=True)
    owner = np.repeat(np.arange(len(counts)), counts)
    known = telling(buckets, owner, grades[y])
    column = np.full(BUCKETS, -1)
    column[known] = np.arange(len(known))
    use = column[buckets] >= 0
    owner, column = owner[use], column[buckets][use]
    steps = len(grades) - 1
    share = np.array([(y > k).mean() for k in range(steps)])
    start = -np.log(share / (1 - share)) if steps else np.empty(0)
    # Thresholds are the first one and the logarithms of the gaps, so that they stay in order.
    p = np.concatenate([np.zeros(len(known)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = max(len(y), 1)
    for t in range(1, rounds + 1 if steps else 1):
        w, tail = p[: len(known)], p[len(known) :]
        cuts = tail[0] + np.concatenate([[0], np.cumsum(np.exp(tail[1:]))])
        score = np.bincount(owner, w[column], minlength=n)
        above = _sigmoid(score[:, None] - cuts[None, :])  # P(grade > k)
        edge = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = edge * (1 - edge)
        rows = np.arange(n)
        mass = np.maximum(edge[rows, y] - edge[rows, y + 1], 1e-12)
        by_score = -(slope[rows, y] - slope[rows, y + 1]) / mass
        by_cut = np.zeros((n, steps + 2))
        by_cut[rows, y] += slope[rows, y] / mass
        by_cut[rows, y + 1] -= slope[rows, y + 1] / mass
        cut_sum = by_cut[:, 1:-1].sum(axis=0)
        after = cut_sum[::-1].cumsum()[::-1]
        gradient = np.concatenate(
            [np.bincount(column, by_score[owner], minlength=len(known)) / n + decay * w, after[:1] / n, np.exp(tail[1:]) * after[1:] / n]
        )
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[known] = p[: len(known)]
    tail = p[len(known) :]
    cuts = tail[0] + np.concatenate([[0], np.cumsum(np.exp(tail[1:]))]) if steps else np.empty(0)
    return Model(weights, cuts, grades.astype(float))


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades from 0 to 2: one for good quality, one for not being toxic; null where either is."""
    grade = F.col("quality").cast("double") + F.when(F.col("toxic") == 0, 1.0).when(F.col("toxic").isNotNull(), 0.0)
    return labels.select("doc_id", grade.alias("rating"))


def train(documents: DataFrame, ratings: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on the texts of ``documents`` whose ``doc_id`` is in ``ratings`` (``doc_id, rating``).

    If there are more than ``max_rows`` ratings, they are drawn by a hash of the id; so are, by id, text and rating, the
    pairs of a document and a rating, of which there are more where ids repeat. At most twice ``max_rows`` pairs
    are taken in any case. Null ratings are left out. A document rated more than once counts each time, and a
    rating goes to every document of its id. Without ratings the model has no grade.
    """
    ratings = ratings.where(F.col("rating").isNotNull()).select("doc_id", F.col("rating").cast("double").alias("rating"))
    total = ratings.count()
    if total > max_rows:
        ratings = ratings.where(drawn(max_rows, total, "doc_id", F.lit("rated")))
    ratings = ratings.limit(2 * max_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                buckets, counts = features(piece["text"])
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(buckets.astype(np.int32)))
                columns = [piece["doc_id"], piece["content"], piece["rating"], lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "rating", "buckets"])

    # The drawn ratings are at most 2 * max_rows, so they can go to every task.
    ratings = F.broadcast(ratings)
    pairs = documents.select("doc_id").join(ratings, on="doc_id").count()
    rated = documents.select("doc_id", "text", F.xxhash64("text").alias("content")).join(ratings, on="doc_id")
    if pairs > max_rows:
        rated = rated.where(drawn(max_rows, pairs, "doc_id", "content", "rating", F.lit("pair"))).limit(2 * max_rows)
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, content long, rating double, buckets array<int>"
    found = rated.mapInArrow(tidy(run), schema).toArrow().sort_by([(c, "ascending") for c in ("doc_id", "content", "rating")])
    if not found.num_rows:
        return Model(np.zeros(BUCKETS), np.empty(0), np.empty(0))
    lists = found["buckets"].combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    return fit(lists.flatten().to_numpy().astype(np.int64), counts, found["rating"].to_numpy())


def grade(documents: DataFrame, model: Model, least_grade: float | None = None, least_probability: float = 0.5) -> DataFrame:
    """``documents`` with ``expected_grade, tail_probability, selected``.

    ``tail_probability`` is that of ``least_grade`` (the highest by default) or more; those are selected
    for which it is ``least_probability`` or more. Every row is graded by its whole text. A null or empty text has
    no words, and the model's grade for that. Without any grade in the model, everything is selected, with null
    figures; with a single one, everything has it. Columns with these names are replaced.
    """
    own = ["expected_grade", "tail_probability", "selected"]
    documents = documents.drop(*own)
    names = documents.columns
    weights = documents.sparkSession.sparkContext.broadcast(model.weights.astype(np.float32))
    thresholds, grades = model.thresholds, model.grades
    rank = len(grades) - 1 if least_grade is None else int(np.searchsorted(grades, least_grade))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                n = piece.num_rows
                if not len(grades):
                    null = pa.nulls(n, pa.float64())
                    yield pa.RecordBatch.from_arrays([*piece.columns, null, null, pa.array(np.ones(n, bool))], [*names, *own])
                    continue
                buckets, counts = features(piece["text"])
                score = np.bincount(np.repeat(np.arange(n), counts), w[buckets], minlength=n)
                above = _sigmoid(score[:, None] - thresholds[None, :])
                expected = grades[0] + above @ np.diff(grades)
                tail = np.ones(n) if rank <= 0 else np.zeros(n) if rank > len(thresholds) else above[:, rank - 1]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(expected), pa.array(tail), pa.array(tail >= least_probability)], [*names, *own]
                )

    schema = extended(
        documents.schema, expected_grade=DoubleType(), tail_probability=DoubleType(), selected=BooleanType()
    )
    return documents.mapInArrow(tidy(run), schema)
