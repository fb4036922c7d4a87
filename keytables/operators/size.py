"""How large a table is, and whether it is small enough to broadcast."""

from __future__ import annotations

import weakref
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from keytables.functions.columns import named

# Fixed value: a table below this many rows counts as small.
BROADCAST_MAX_ROWS = 1_000_000
# Rows can be long texts, so their size is bounded as well.
BROADCAST_MAX_BYTES = 128 * 1024 * 1024

_FIXED_WIDTH = (BooleanType, DateType, NumericType, TimestampNTZType, TimestampType)
_WIDEST = 16


# How large the files of a table are together, for tables of which Spark does not know it.
_listed: weakref.WeakKeyDictionary[DataFrame, Callable[[], int]] = weakref.WeakKeyDictionary()


def remember_listed_bytes(df: DataFrame, listed: Callable[[], int]) -> DataFrame:
    """Note how to find the size of the files ``df`` reads, without a job."""
    _listed[df] = listed
    return df


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size, from its plan alone; enormous where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def left_to_spark(df: DataFrame) -> bool:
    """Whether Spark is going to broadcast the table by its own estimate and setting."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return plan_bytes(df) <= limit


def weight(df: DataFrame) -> int:
    """The size of the files ``df`` reads where it is listed, else Spark's estimate; no job runs."""
    listed = _listed.get(df)
    return plan_bytes(df) if listed is None else listed()


def _held_by_driver(df: DataFrame) -> bool:
    """Whether the table is made of a list that the driver has handed out, whose size Spark does not know either."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return bool(found) and all(leaf.nodeName() == "LogicalRDD" and _handed_out(leaf.rdd()) for leaf in found)


def _handed_out(rdd) -> bool:
    """Whether Python takes the rows straight from a list in the driver, as ``createDataFrame`` does."""
    kinds = [rdd.getClass().getSimpleName()]
    while rdd.dependencies().size() == 1:
        rdd = rdd.dependencies().apply(0).rdd()
        kinds.append(rdd.getClass().getSimpleName())
    return kinds[-2:] == ["PythonRDD", "ParallelCollectionRDD"] and "PythonRDD" not in kinds[:-2]


def listed_as_small(
    table: DataFrame,
    needed: DataFrame | None = None,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Whether ``table`` consists of files whose listed sizes are within ``max_bytes``, or of rows that the driver
    holds, and fits the limits itself.

    Only such a table is counted, so that the work is bounded: ``needed`` is the part of it to count, the table by
    default. For any other, as for a ``max_rows`` of 0, this is False and runs no job.
    """
    if max_rows <= 0:
        return False
    listed = _listed.get(table)
    if listed is None and not _held_by_driver(table) or listed is not None and listed() > max_bytes:
        return False
    return fits_broadcast(table if needed is None else needed, max_rows, max_bytes)


def estimate_size(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``bytes``, the UTF-8 length of the rows printed with a bar between values.

    Nulls print as nothing, bar included. The text itself is never built: lengths are added up.
    """
    lengths = [F.octet_length(named(c).cast("string")) for c in df.columns]
    filled = [F.when(n.isNull(), 0).otherwise(1) for n in lengths]
    total = reduce(lambda a, b: a + b, [F.coalesce(n, F.lit(0)).cast("long") for n in lengths], F.lit(0))
    bars = F.greatest(reduce(lambda a, b: a + b, filled, F.lit(0)) - 1, F.lit(0))
    return df.agg(
        F.coalesce(F.sum(total + bars), F.lit(0)).cast("long").alias("bytes"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def fits_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Whether ``df`` has fewer than ``max_rows`` rows and at most ``max_bytes`` bytes of values.

    Runs a count, which reads no column of a Parquet table. The size is measured for a small table
    only, and not where the column types bound it. A ``max_rows`` of 0 runs nothing.
    """
    if max_rows <= 0 or df.count() >= max_rows:
        return False
    fixed = all(isinstance(f.dataType, _FIXED_WIDTH) for f in df.schema)
    if fixed and max_rows * _WIDEST * len(df.columns) <= max_bytes:
        return True
    return estimate_size(df).first()["bytes"] <= max_bytes
