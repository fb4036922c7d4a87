"""Projection, predicates, key-list filters and the derived hash column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytables.functions.columns import columns_of, named
from keytables.functions.keys import HASH_COLUMN, hash_key
from keytables.operators.prefilter import may_match
from keytables.operators.size import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_ROWS,
    left_to_spark,
    listed_as_small,
)

Conditions = str | Column | Sequence[str | Column] | None


def project(
    df: DataFrame,
    columns: Sequence[str | Column] | None = None,
    exprs: Sequence[str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Keep ``columns``, or compute ``exprs`` (Spark SQL select items); every column by default.

    Each item of ``exprs`` is parsed on its own, so an item may hold commas but no further clause
    such as FROM or WHERE. A window item without PARTITION BY runs in one task.
    """
    if columns and exprs:
        raise ValueError("give columns or exprs, not both")
    if exprs:
        df = df.selectExpr(*exprs)
    elif columns:
        df = df.select(*columns)
    return df.distinct() if distinct else df


def where(df: DataFrame, conditions: Conditions = None) -> DataFrame:
    """Keep the rows that meet every condition; no condition keeps them all."""
    if conditions is None:
        return df
    if isinstance(conditions, (str, Column)):
        conditions = [conditions]
    for condition in conditions:
        df = df.where(condition)
    return df


def key_filter(
    df: DataFrame,
    keys: Mapping[str, DataFrame] | Iterable[tuple[str, DataFrame]],
    multiplicity: str = "semi",
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    prefilter_bytes: int = 0,
) -> DataFrame:
    """Keep the rows whose column value is in the key table, for each (column, key table) pair.

    The key table holds a column of the same name. ``semi`` keeps a row once, as IN does. ``inner``
    repeats it for every repeat of its key. Null keys match nothing. The key comes first in the
    result.

    A list of Arrow files that are small by their listed size is counted and, if it fits the limits,
    broadcast, so that ``df`` is not shuffled: Spark knows no size of such files. Of any other list Spark
    knows a size, or finds it out at run time; no job runs for it here. Unless Spark is going to broadcast it
    anyhow, ``semi`` makes the keys distinct, with a partial aggregation before the shuffle. That leaves
    ``df`` as the only side that can be skewed, and adaptive execution splits that side of a semi join,
    or either side of an inner one. ``broadcast_max_rows=0`` counts nothing.

    ``prefilter_bytes`` is for lists too long to broadcast that few rows match: a filter of at most so many bytes leaves
    out most other rows of ``df`` before they are shuffled, see :func:`may_match`.
    """
    if multiplicity not in ("semi", "inner"):
        raise ValueError(f"multiplicity must be semi or inner, not {multiplicity!r}")
    how = "left_semi" if multiplicity == "semi" else "inner"
    for column, table in keys.items() if isinstance(keys, Mapping) else keys:
        values = table.select(named(column) if column in table.columns else column)
        if listed_as_small(table, values, broadcast_max_rows, broadcast_max_bytes):
            values = F.broadcast(values)
        elif not left_to_spark(values):
            if prefilter_bytes > 0:
                df = may_match(df, values, column, prefilter_bytes)
            if multiplicity == "semi":
                values = values.distinct()
        df = df.join(values, on=column, how=how)
    return df


def add_hash_column(
    df: DataFrame,
    columns: Sequence[str | Column],
    name: str = HASH_COLUMN,
    strict: bool = False,
) -> DataFrame:
    """Add the hash key of ``columns``; see :func:`keytables.functions.hash_key`."""
    return df.withColumn(name, hash_key(*columns_of(df, columns), strict=strict))
