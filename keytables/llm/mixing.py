"""Mixing sources to target weights: each document repeated a Poisson number of times, then shuffled.

Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A hash is 48 bits of an MD5, which every engine gives alike.
HASH_BITS = 48
# So many repeated rows are broadcast by their digests, of 32 bytes; more are joined by a shuffle.
BROADCAST_REPEATED = 100_000
# Poisson terms of less than this part of the largest are left out.
_NOTHING = 1e-30


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on ``seed`` and ``key`` alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long") / float(2**HASH_BITS)


def poisson_steps(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... up to the last value below 1 that a 48-bit number can exceed."""
    first, steps = _steps(rate)
    return [0.0] * first + steps


def _steps(rate: float) -> tuple[int, list[float]]:
    """P(X <= k) for k = first, first + 1, ...; those before are less than a 48-bit number tells from 0.

    Terms are taken relative to that of the mode, from there outwards, so none under- or overflows; they are summed
    from either end, so that both tails keep their digits.
    """
    mode = math.floor(rate)
    below, above = [], [1.0]
    term = 1.0
    for k in range(mode, 0, -1):
        term *= k / rate
        if term < _NOTHING:
            break
        below.append(term)
    term = 1.0
    while term >= _NOTHING:
        term *= rate / (mode + len(above))
        above.append(term)
    first = mode - len(below)
    terms = below[::-1] + above
    total = math.fsum(terms)
    up = list(accumulate(terms))
    # What is left above k.
    down = [0.0, *accumulate(reversed(terms))][-2::-1]
    steps = [u / total if 2 * u < total else 1 - d / total for u, d in zip(up, down)]
    skipped = sum(s < 2.0 ** -(HASH_BITS + 1) for s in steps)
    return first + skipped, [s for s in steps[skipped:] if s <= 1 - 2.0**-HASH_BITS]


def repetition_rates(
    documents: DataFrame, by: str, weights: Mapping[str, float], epochs: float = 1.0, size: Column | None = None
) -> dict[str, float]:
    """For each source in ``weights``, how often its documents must be repeated on average so that the
    sources' shares of the result are as the weights, at ``epochs`` times the size of the sources taken.

    ``size`` measures a document (1 by default); null counts as 0. Only one row per weighted source
    reaches the driver. A source without rows, or of size 0, gets no rate.
    """
    size = F.lit(1) if size is None else F.coalesce(size, F.lit(0))
    rows = documents.where(F.col(by).isin(list(weights))).groupBy(by).agg(F.sum(size).alias("size")).collect()
    sizes = {r[by]: float(r["size"]) for r in rows if r["size"]}
    share = sum(weights[s] for s in sizes)
    total = sum(sizes.values())
    return {s: epochs * total * weights[s] / share / n for s, n in sorted(sizes.items())} if share else {}


def mix_sources(
    documents: DataFrame,
    by: str,
    rates: Mapping[str, float],
    seed: str = "mix",
    key: str = "doc_id",
    default_rate: float = 0.0,
    copy: str = "copy",
    position: str = "shuffle_key",
    text: str = "text",
) -> DataFrame:
    """Each document as often as a Poisson number with its source's rate says, in a random global order.

    A document's count is the inverse of the Poisson distribution at a hash of ``seed``, its ``key`` and its
    ``text`` (of the key alone, if there is no such column), so it does not change with the partitioning or when a
    task runs again. Documents that share a key, or have none, are so drawn each by itself. Rows equal in both
    are told apart by the place they are read from, which is the same when a task runs again, but not in another
    partitioning. A null source, or one not in ``rates``, has ``default_rate``. ``rates`` is a parameter of the
    caller's, one number per source; its steps are broadcast. Adds ``copy`` (from 0) and ``position``, a
    hash of the same values and the copy by which the rows are sorted over all partitions; columns of these names
    are replaced. The rows of a source, of a key or of a text, however many, are spread by that hash. Finding the rows
    that are equal runs a job over keys and digests.
    """
    documents = documents.drop(copy, position)
    names = documents.columns
    rows = _numbered(documents, key, text if text in names else None)
    rows = rows.withColumn("__mix_u", uniform(seed, F.col("__mix_id")))
    u = F.col("__mix_u")
    times = _count(u, default_rate)
    if rates:
        rows = rows.join(F.broadcast(_step_table(documents, rates)), F.col(by).cast("string") == F.col("__mix_source"), "left")
        listed = F.size(F.filter("__mix_steps", lambda s: s <= u)) + F.col("__mix_first")
        times = F.when(F.col("__mix_source").isNotNull(), listed).otherwise(times)
    return (
        rows.withColumn("__mix_times", times)
        .where(F.col("__mix_times") > 0)
        .select(*names, "__mix_id", F.explode(F.sequence(F.lit(0), F.col("__mix_times").cast("int") - 1)).alias(copy))
        .withColumn(position, uniform(f"{seed}-order", F.concat_ws(":", "__mix_id", F.col(copy))))
        .orderBy(position, "__mix_id", copy)
        .drop("__mix_id")
    )


def _numbered(documents: DataFrame, key: str, text: str | None) -> DataFrame:
    """``documents`` with ``__mix_id``: the key, a digest of the text, and a number that is 0 but for rows equal in both."""
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("null"))]
    if text is not None:
        parts.append(F.coalesce(F.md5(F.col(text).cast("string")), F.lit("null")))
    own = F.concat_ws(":", *parts)
    digests = documents.select(F.md5(own).alias("__mix_digest")).groupBy("__mix_digest").count()
    repeated = digests.where(F.col("count") > 1).select("__mix_digest")
    found = repeated.count()
    if not found:
        return documents.withColumn("__mix_id", F.concat_ws(":", own, F.lit("0")))
    if found <= BROADCAST_REPEATED:
        repeated = F.broadcast(repeated)
    rows = documents.withColumn("__mix_row", F.monotonically_increasing_id()).withColumn("__mix_own", own)
    joined = rows.join(repeated, F.md5("__mix_own") == F.col("__mix_digest"), "left")
    number = F.when(F.col("__mix_digest").isNull(), F.lit(0)).otherwise(F.col("__mix_row"))
    return joined.withColumn("__mix_id", F.concat_ws(":", "__mix_own", number.cast("string"))).drop("__mix_row", "__mix_own", "__mix_digest")


def _step_table(like: DataFrame, rates: Mapping[str, float]) -> DataFrame:
    """One row per source with a rate, made of a literal."""
    rows = []
    for source, rate in rates.items():
        first, steps = _steps(rate) if rate > 0 else (0, [])
        rows.append({"__mix_source": source, "__mix_first": first, "__mix_steps": steps})
    schema = "array<struct<__mix_source string, __mix_first long, __mix_steps array<double>>>"
    return like.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))


def _count(u: Column, rate: float) -> Column:
    """How many steps of the distribution lie at or below ``u``."""
    if rate <= 0:
        return F.lit(0).cast("long")
    first, steps = _steps(rate)
    return F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s <= u)) + F.lit(first).cast("long")
