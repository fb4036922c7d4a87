"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its nearest pivots in order. It is posted, with the ranks of these pivots, in the
inverted files of the first few. A query reads the files of its own nearest pivots, ranks what is in them by the
Spearman footrule between the orders, and reranks the best by their distance. A vector that several of these files hold
is ranked in the first of them alone, so a query ranks no vector twice and can never do more than a scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keytables.llm import vectors as V
from keytables.llm.frames import sorted_runs, tidy
from keytables.sources.scratch import write_scratch


class Settings(NamedTuple):
    """``pivots`` vectors of a sample; ``order`` nearest pivots represent a vector; ``post`` files hold it and ``visit``
    are read for a query; of what is new in each ``block`` of a file, against so many queries (``ask_block``) in one go, the share ``rerank``
    with the least footrule is measured, and whatever ties with its last. Recall, not the answer's form, depends on them."""

    pivots: int = 64
    order: int = 64
    post: int = 4
    visit: int = 20
    rerank: float = 0.3
    least_rerank: int = 64
    block: int = 4096
    ask_block: int = 1024


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` different vectors of the sample, spread out: each the one that is farthest from those before
    among a few drawn."""
    distinct = np.unique(sample, axis=0) if len(sample) else sample
    if len(distinct) <= n:
        return distinct
    rng = np.random.default_rng(5)
    chosen = [int(rng.integers(len(distinct)))]
    nearest = ((distinct - distinct[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n:
        drawn = rng.choice(len(distinct), 4, replace=False)
        best = int(drawn[nearest[drawn].argmax()])
        chosen.append(best)
        nearest = np.minimum(nearest, ((distinct - distinct[best]) ** 2).sum(axis=1))
    return distinct[chosen]


def pivot_orders(x: np.ndarray, pivots: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` nearest pivots of each vector, nearest first, ties to the first pivot."""
    distance = (pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.argsort(distance, axis=1, kind="stable")[:, :order].astype(np.int32)


def ranks(orders: np.ndarray, pivots: int) -> np.ndarray:
    """The rank of each pivot in each order; those not in it come after all that are."""
    out = np.full((len(orders), pivots), orders.shape[1], np.int16)
    np.put_along_axis(out, orders, np.arange(orders.shape[1], dtype=np.int16)[None, :], axis=1)
    return out


def footrules(query: np.ndarray, candidates: np.ndarray, query_order: np.ndarray) -> np.ndarray:
    """How far the query's pivots are from their places in the candidates' orders, all told."""
    places = candidates[:, query_order]
    return np.abs(places - query[query_order][None, :]).sum(axis=1, dtype=np.int32)


def pivot_sets(orders: Sequence[np.ndarray] | np.ndarray, pivots: int) -> np.ndarray:
    """A row of bits for each list of pivots, as 64-bit words."""
    out = np.zeros((len(orders), -(-pivots // 64)), np.uint64)
    for row, order in zip(out, orders):
        np.bitwise_or.at(row, order // 64, np.uint64(1) << (order % 64).astype(np.uint64))
    return out


def nearest(query: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
    """The ``k`` nearest, ties to the smaller id, the query's own row left out."""
    distance = np.sqrt(((x - query) ** 2).sum(axis=1))
    keep = ids != own
    distance, ids = distance[keep], ids[keep]
    order = np.lexsort((ids, distance))[:k]
    return list(zip(ids[order].tolist(), distance[order].tolist()))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    settings: Settings = Settings(),
    key: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` nearest vectors found but itself.

    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the smaller id. All
    vectors are indexed; only the pivots come from a sample. Vectors that are null, zero, hold null or
    non-finite components, or have another number of components than most take no part, as queries either. A
    query that finds fewer than ``k`` in its files is compared with all vectors, so it gets all if there
    are fewer. Ids are integers; rows that share an id are one candidate, at its least distance. Other columns
    are not read.
    """
    columns = [F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")]
    rows = vectors.select(*columns)
    dim = V.dimension(rows, "x")
    rows = V.comparable(rows, dim, "x")
    asked = V.comparable(queries.select(*columns), dim, "x")
    pivots = choose_pivots(V.sample_matrix(rows, 20 * settings.pivots, "vec_id", "x"), settings.pivots)
    order, post, visit = (min(n, len(pivots)) for n in (settings.order, settings.post, settings.visit))

    def ordered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pivot_orders(V.matrix(batch["x"]), pivots, order)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), order).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "x", "near"])

    schema = "vec_id long, x array<double>, near array<int>"
    posts = rows.mapInArrow(tidy(ordered), schema).withColumn("pivot", F.explode(F.slice("near", 1, post)))
    posts = write_scratch(posts, "permutation-posts")
    visits = asked.mapInArrow(tidy(ordered), schema).withColumn("pivot", F.explode(F.slice("near", 1, visit)))
    visits = write_scratch(visits, "permutation-visits")
    # Long files are cut into blocks, as are the queries to one file; every block meets every other.
    rows_of = posts.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / settings.block).cast("int").alias("blocks"))
    asks_of = visits.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / settings.ask_block).cast("int").alias("ask_blocks"))
    # One row per pivot, so of a proven size.
    sizes = F.broadcast(write_scratch(rows_of.join(asks_of, on="pivot"), "permutation-sizes"))

    def dealt(df: DataFrame, own: str, other: str, names: tuple[str, str], asks: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", "pivot"), F.col(own)).cast("int").alias(names[0])
        others = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(names[1])
        found = df.join(sizes, on="pivot").select("pivot", mine, others, "vec_id", "x", "near", F.lit(asks).alias("asks"))
        return found.select("pivot", "block", "ask_block", "vec_id", "x", "near", "asks")

    held = dealt(posts, "blocks", "ask_blocks", ("block", "ask_block"), False)
    visits = dealt(visits, "ask_blocks", "blocks", ("ask_block", "block"), True)
    meet = ["pivot", "block", "ask_block"]

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, meet):
            asks = group["asks"].to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, x, near = group["vec_id"].to_numpy(), V.matrix(group["x"]), V.matrix(group["near"], np.int32)
            mine, places, queries_in = ~asks, ranks(near, len(pivots)), np.flatnonzero(asks)
            ids_in, x_in, places_in = ids[mine], x[mine], places[mine]
            posted = pivot_sets(near[mine, :post], len(pivots))
            # The files that each query reads before this one.
            earlier = pivot_sets([near[q][: places[q, group["pivot"][0].as_py()]] for q in queries_in], len(pivots))
            out = []
            for q, before in zip(queries_in, earlier):
                new = np.flatnonzero(~(posted & before).any(axis=1))
                if not len(new):
                    continue
                share = min(len(new), max(settings.least_rerank, int(settings.rerank * len(new))))
                far = footrules(places[q], places_in[new], near[q])
                best = new[far <= np.partition(far, share - 1)[share - 1]]
                out += [(ids[q], *f) for f in nearest(x[q], x_in[best], ids_in[best], ids[q], k)]
            yield _found(out)

    results = "query_id long, vec_id long, score double"
    found = (
        held.unionByName(visits)
        .repartition(*meet)
        .sortWithinPartitions(*meet)
        .mapInArrow(tidy(ask), results)
    )
    best = write_scratch(_best(found, k), "permutation-found")
    short = asked.join(
        best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")), on="vec_id", how="left_anti"
    )
    short = write_scratch(short, "permutation-short")
    full = best.join(short.select(F.col("vec_id").alias("query_id")).distinct(), on="query_id", how="left_anti")
    if short.isEmpty():
        return full
    return full.unionByName(_best(_compare_all(rows, short, k, results), k))


def _found(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
    query, vec, score = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"]
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; Spark keeps the best of each task before it shuffles them."""
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return one.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _compare_all(rows: DataFrame, short: DataFrame, k: int, schema: str) -> DataFrame:
    """Each query of ``short`` against every row, in blocks of both."""
    queries_per, rows_per = 256, 4096
    q_blocks = max(1, -(-short.count() // queries_per))
    r_blocks = max(1, -(-rows.count() // rows_per))
    a = short.select("vec_id", "x", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).alias("i"), F.lit(True).alias("asks"))
    b = rows.select("vec_id", "x", F.pmod(F.xxhash64("vec_id", "x"), F.lit(r_blocks)).alias("j"), F.lit(False).alias("asks"))
    a = a.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(r_blocks - 1).cast("long"))))
    b = b.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_runs(batches, ["i", "j"]):
            asks, ids, x = group["asks"].to_numpy(), group["vec_id"].to_numpy(), V.matrix(group["x"])
            out = []
            for q in np.flatnonzero(asks):
                out += [(ids[q], *f) for f in nearest(x[q], x[~asks], ids[~asks], ids[q], k)]
            yield _found(out)

    return a.unionByName(b).repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(tidy(compare), schema)
