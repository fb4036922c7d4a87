"""Global order, and writing in it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from keytables.functions.columns import columns_of
from keytables.operators.contracts import KeyContractError, check_key, checked_in_order, says_broken

T = TypeVar("T")

# Marks the task a row came from. It breaks ties only, and never reaches the result.
_ORIGIN = "__keytables_origin"
# Key types that Spark groups by as they are. It brings floating-point numbers into one form before it does, and would
# shuffle them by that.
_PLAIN_KEYS = (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)


def sort_table(
    df: DataFrame,
    columns: str | Sequence[str],
    ascending: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Global sort; nulls first when ascending, last when descending.

    The result's partitions are ranges of the key, in order, so files written from it are too.
    Equal keys cannot be told apart by a range boundary: a value held by a third of the rows would
    end up in one task. The task a row comes from therefore follows as last sort column. It lets
    boundaries fall between equal keys, keeps the order of the tasks they come from (not that within
    a task), and is the same when a lost task runs again.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    if not names:
        raise ValueError("sort_table needs at least one column")
    order = [c.asc() if ascending else c.desc() for c in columns_of(df, names)]
    if num_partitions is None:
        return df.sort(*order, F.spark_partition_id())
    marked = df.withColumn(_ORIGIN, F.spark_partition_id())
    order.append(F.col(_ORIGIN).asc())
    ranged = marked.repartitionByRange(num_partitions, *order)
    return ranged.sortWithinPartitions(*order).drop(_ORIGIN)


def write_sorted(
    df: DataFrame,
    key: str,
    sink: Callable[[DataFrame], T],
    num_partitions: int | None = None,
    check: bool = True,
) -> T:
    """Hand ``df`` to ``sink``, clustered on its primary key: each partition holds a range of it, sorted.

    ``key`` must be unique and not null, or :class:`KeyContractError` is raised and nothing is published. A sink
    that shows its table only once it is complete says so by an attribute ``publishes_whole``. For it the rule is checked in
    the sorted stream, and ``df`` is evaluated for the range boundaries and for the write. For any other sink, and
    for keys of floating-point or nested types, ``df`` is evaluated once more, for a check beforehand. Give a
    written table where its plan is costly, as ``psi_job`` does.

    A key that is repeated without end makes one range as large as its rows are many, which is sorted, by way of the
    disk, before the write fails.
    """
    streamed = check and getattr(sink, "publishes_whole", False)
    if not (streamed and isinstance(df.select(*columns_of(df, [key])).schema[0].dataType, _PLAIN_KEYS)):
        if check:
            check_key(df, key)
        return sink(sort_table(df, key, num_partitions=num_partitions))
    by_key = columns_of(df, [key])
    ranged = df.repartitionByRange(*([] if num_partitions is None else [num_partitions]), *by_key)
    try:
        return sink(checked_in_order(ranged, key))
    except PySparkException as error:
        if not says_broken(error):
            raise
        check_key(df, key)  # says how many
        raise KeyContractError(f"{key} is no primary key") from error
