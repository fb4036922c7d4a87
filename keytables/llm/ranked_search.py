"""Ranked lexical search: the documents with the largest inner product of term impacts, for each query of a set.

A document is a vector of its terms' impacts, a query one of its terms' weights, and the score their inner product.
Each coordinate is shared out evenly: the vectors compared hold the root of the weight on both sides. Within each
task documents come by falling length of their vectors, and are cut into buckets of similar length. By the
Cauchy-Schwarz inequality no document of a bucket scores more than the product of the query's length and the
longest of the bucket; where that is below the k-th best score found, the query is done with the bucket and all
later ones. Inside a bucket the query's heaviest coordinates are multiplied out, and the same inequality over the rest
bounds each document. What is left is scored exactly, in 64-bit integers.

Documents are never shuffled: a task sends on the k best for each query alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from keytables.llm.frames import tidy
from keytables.llm.words import Words, pieces, spelled, split_terms, take_lists
from keytables.sources.scratch import remove_scratch, scratch_path

# Queries are searched together in blocks of at most so many, and of so much text; a longer one comes alone.
BLOCK_QUERIES, BLOCK_BYTES = 4096, 8 * 1024 * 1024
BUCKET_ROWS = 2048
# So many of a query's heaviest coordinates are multiplied out for the bounds inside a bucket.
FOCUS = 4
# Bounds are rounded numbers, scores are whole.
_SLACK = 1 + 1e-9
_TASKS = 64


class QueryBlock(NamedTuple):
    """Queries by number: ``terms`` holds the distinct terms of all, ``of[first[q]:first[q + 1]]`` those of query q."""

    ids: list
    terms: pa.Array
    of: np.ndarray
    first: np.ndarray


def _document_terms(words: Words, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term number, occurrences) of the given terms, by text, then term."""
    number = pc.index_in(spelled(words), value_set=terms)
    known = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
    of = np.repeat(np.arange(len(words.first) - 1), words.count)[known]
    width = max(len(terms), 1)
    key, times = np.unique(
        of * width + pc.fill_null(number, 0).to_numpy(zero_copy_only=False)[known].astype(np.int64), return_counts=True
    )
    return key // width, key % width, times


def _query_blocks(queries: DataFrame, key: str, text: str) -> Iterator[QueryBlock]:
    held: list[Row] = []
    size = 0
    # Queries without a text have no terms.
    for row in queries.where(F.col(text).isNotNull()).select(key, text).orderBy(key, text).toLocalIterator():
        more = len(row[text].encode())
        if held and (len(held) == BLOCK_QUERIES or size + more > BLOCK_BYTES):
            yield _query_block(held, text, key)
            held, size = [], 0
        held.append(row)
        size += more
    if held:
        yield _query_block(held, text, key)


def _query_block(rows: list[Row], text: str, key: str) -> QueryBlock:
    words = split_terms(pa.array([r[text] for r in rows]))
    terms = pc.unique(spelled(words))
    of, term, _ = _document_terms(words, terms)
    return QueryBlock([r[key] for r in rows], terms, term, np.searchsorted(of, np.arange(len(rows) + 1)))


def _count_terms(documents: DataFrame, terms: pa.Array, key: str, text: str) -> DataFrame:
    """How many terms each document has, and how often each of ``terms``; documents without any term are left out."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(terms.to_pylist())

    @tidy
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            for piece in pieces(batch, text):
                words = split_terms(piece[text])
                of, term, times = _document_terms(words, wanted)
                offsets = pa.array(np.searchsorted(of, np.arange(piece.num_rows + 1)).astype(np.int32))
                out = pa.RecordBatch.from_arrays(
                    [
                        piece[key],
                        pa.array(words.count.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
                    ],
                    ["id", "n", "terms", "times"],
                )
                yield out.filter(pc.greater(out["n"], 0))

    chosen = documents.select(F.col(key).cast("long").alias(key), text)
    return chosen.mapInArrow(count, "id long, n long, terms array<int>, times array<long>")


def impacts(times: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What ``times`` occurrences in a document of ``n`` terms count, by the numbers of all documents and terms."""
    if len(n) and int(n.max()) * 90 * documents >= 2**63:
        m = np.array([10 + 90 * int(x) * documents // terms for x in n])
    else:
        m = 10 + (90 * n * documents) // terms
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class _Best:
    """The best documents of one query so far: the highest scores, of equal ones the smallest ids, null last."""

    def __init__(self, k: int):
        self._k = k
        self.score, self.id, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.least = 1  # what a score must reach

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[: self._k]
        self.score, self.id, self.null = score[order], ids[order], null[order]
        if len(order) == self._k:
            self.least = max(1, int(self.score[-1]))


class _Bucket:
    """Documents of similar length, their impacts listed by term."""

    def __init__(self, rows: pa.Table, root: np.ndarray):
        rows = rows.combine_chunks()
        ids = rows["id"].combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        self.length = rows["length"].to_numpy()
        listed = rows["terms"].combine_chunks()
        term = listed.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        self.row = np.repeat(np.arange(len(listed)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))[order]
        self.impact = rows["impacts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)[order]
        self.x = self.impact * root[term[order]]
        self.first = np.searchsorted(term[order], np.arange(len(root) + 1))

    def search(self, terms: np.ndarray, weight: np.ndarray, root: np.ndarray, best: _Best) -> None:
        """``terms`` come by falling ``weight``."""
        total = np.zeros(len(self.length))
        known = np.zeros(len(self.length))
        for t in terms[:FOCUS]:
            at = slice(self.first[t], self.first[t + 1])
            rows, x = self.row[at], self.x[at]
            total[rows] += root[t] * x
            known[rows] += x * x
        rest = float(weight[terms[FOCUS:]].sum())
        bound = total + np.sqrt(rest * np.maximum(self.length**2 * _SLACK - known, 0))
        left = bound * _SLACK >= best.least
        if not left.any():
            return
        begin = self.first[terms]
        many = self.first[terms + 1] - begin
        rows = take_lists(self.row, begin, many)
        gain = take_lists(self.impact, begin, many) * np.repeat(weight[terms], many)
        chosen = left[rows]
        score = np.zeros(len(left), np.int64)
        np.add.at(score, rows[chosen], gain[chosen])
        found = np.flatnonzero(score >= best.least)
        if len(found):
            best.add(score[found], self.id[found], self.null[found])


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, BUCKET_ROWS - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == BUCKET_ROWS:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _search_block(counted: DataFrame, block: QueryBlock, documents: int, terms: int, k: int, key_type: str) -> DataFrame:
    spark = counted.sparkSession
    # One row for each term of the block at the most.
    holding = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([term_weight(documents, holding.get(t, 0)) for t in range(len(block.terms))], np.int64)
    shared = spark.sparkContext.broadcast((weights, block.of, block.first))

    @tidy
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value[0].astype(float)
        for batch in batches:
            many = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False)
            n = batch["n"].to_numpy()
            times = batch["times"].flatten().to_numpy(zero_copy_only=False)
            term = batch["terms"].flatten().to_numpy(zero_copy_only=False)
            value = impacts(times, np.repeat(n, many), documents, terms)
            row = np.repeat(np.arange(len(many)), many)
            length = np.sqrt(np.bincount(row, weight[term] * value.astype(float) ** 2, len(many)))
            offsets = pa.array(np.concatenate(([0], np.cumsum(many))).astype(np.int32))
            listed = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (term, value)]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(length), *listed], ["id", "length", "terms", "impacts"])

    @tidy
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, of, first = shared.value
        root = np.sqrt(weight)
        wanted = []
        for q in range(len(first) - 1):
            own = of[first[q] : first[q + 1]]
            own = own[weight[own] > 0]
            if len(own):
                own = own[np.argsort(-weight[own], kind="stable")]
                wanted.append((q, own, math.sqrt(weight[own].sum()), _Best(k)))
        active = wanted
        for rows in _buckets(batches):
            longest = rows["length"][0].as_py() * _SLACK
            active = [w for w in active if w[2] * longest * _SLACK >= w[3].least]
            if not active:
                break
            bucket = _Bucket(rows, root)
            for _, own, _, best in active:
                bucket.search(own, weight, root, best)
        for _ in batches:  # so that the worker is left in order
            pass
        number = np.concatenate([np.empty(0, np.int64), *(np.full(len(b.score), q) for q, _, _, b in wanted)])
        score = np.concatenate([np.empty(0, np.int64), *(b.score for *_, b in wanted)])
        ids = np.concatenate([np.empty(0, np.int64), *(b.id for *_, b in wanted)])
        null = np.concatenate([np.empty(0, bool), *(b.null for *_, b in wanted)])
        columns = [pa.array(number.astype(np.int32)), pa.array(ids, mask=null), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    vectors = counted.where(F.size("terms") > 0).mapInArrow(
        weigh, "id long, length double, terms array<int>, impacts array<long>"
    )
    found = vectors.sortWithinPartitions(F.desc("length")).mapInArrow(search, "query int, id long, score long")
    # The tasks' best are brought together in two steps, so that no query's grow with the number of tasks.
    order = [F.desc("score"), F.asc_nulls_last("id")]
    near = Window.partitionBy("query", "part").orderBy(*order)
    found = found.withColumn("part", F.spark_partition_id() % _TASKS)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    names = spark.createDataFrame(list(enumerate(block.ids)), f"query int, item {key_type}")
    return ranked.where(F.col("rank") <= k).join(F.broadcast(names), "query").select("item", "rank", "id", "score")


def search(
    documents: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    rank: str = "rank",
    score: str = "score",
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each query: its key, ``rank`` from 1, ``key``, ``score``.

    Terms are maximal runs of ASCII digits and letters and of bytes from 0x80 on, with A-Z in lower case. With N
    documents that have a term, L terms in all, and df documents that hold a term, its weight is
    floor(1000 * ln((2 * N + 2) / (2 * df + 1))); in a document of n terms, m = 10 + 90 * n * N div L, and a term that
    occurs tf times has the impact 1000000000 * tf div (1000 * tf + 8 * m). A score sums weight times impact over the
    query's distinct terms. Equal scores come by ascending ``key``, null last.

    Each row of ``queries`` is a query of its own, also where keys repeat, and so is each row of ``documents`` a
    document. Null and empty texts have no terms: such queries have no result, such documents are in none.
    ``key`` is taken as a long; other columns are not looked at. Queries pass through the driver in blocks
    of at most ``BLOCK_QUERIES`` or ``BLOCK_BYTES`` of text, each searched against all documents in one go; the
    result, at most k rows for each query, is a written table.
    """
    spark = documents.sparkSession
    key_type = queries.schema[query_key].dataType.simpleString()
    results: list[str] = []
    for block in _query_blocks(queries, query_key, query_text):
        path = scratch_path(spark, "search-terms")
        try:
            _count_terms(documents, block.terms, key, text).write.parquet(path)
            counted = spark.read.parquet(path)
            n, terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
            if n:
                results.append(scratch_path(spark, "search-best"))
                _search_block(counted, block, n, terms, k, key_type).write.parquet(results[-1])
        finally:
            remove_scratch(spark, path)
    schema = f"item {key_type}, rank int, id long, score long"
    found = spark.read.schema(schema).parquet(*results) if results else spark.createDataFrame([], schema)
    return found.toDF(query_key, rank, key, score)
