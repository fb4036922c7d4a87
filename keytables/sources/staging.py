"""Tables kept where each task commits on its own, such as a database, read so that a task run twice counts once.

Spark may run a task again after its rows were committed, when an executor is lost or slow. In a staged table every row names the
task's partition and the run that wrote it, and a run's last row tells how many there are. A run is whole if it has
as many rows as it tells; of each partition, the whole run of the least number is kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keytables.functions.columns import named

PARTITION, RUN, TOLD = "stage_partition", "stage_run", "stage_rows"
STAGE_COLUMNS = (PARTITION, RUN, TOLD)


def stage_rows(df: DataFrame) -> DataFrame:
    """``df`` with the columns of a staged table. Write it as it is: no shuffle or coalesce may follow, as the columns
    tell of the task that computes them."""
    taken = {c.lower() for c in df.columns} & set(STAGE_COLUMNS)
    if taken:
        raise ValueError(f"the table holds {', '.join(sorted(taken))} already")
    schema = StructType([*df.schema.fields, *(StructField(c, LongType()) for c in STAGE_COLUMNS)])

    names = schema.names

    def staged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        place = (task.partitionId(), task.taskAttemptId())
        rows, held = 0, None
        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield _placed(held, names, *place, None)
                rows, held = rows + batch.num_rows, batch
        if held is not None:
            yield _placed(held, names, *place, rows)

    # Spark looks the columns up by name here, which fails for a name with a dot.
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(staged, schema)


def _placed(batch: pa.RecordBatch, names: list[str], partition: int, run: int, told: int | None) -> pa.RecordBatch:
    n = batch.num_rows
    columns = [pa.array([partition] * n, pa.int64()), pa.array([run] * n, pa.int64())]
    columns.append(pa.array([None] * (n - 1) + [told], pa.int64()))
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names)


def kept_rows(staged: DataFrame) -> DataFrame:
    """The rows of a staged table, each once, without its own columns.

    The table is read twice, once for these columns alone. One row per partition written,
    two numbers wide, is broadcast. Reading fails if a partition has
    rows, but no whole run: then the write did not end, or something else wrote to the table.
    """
    runs = staged.groupBy(PARTITION, RUN).agg(F.count(F.lit(1)).alias("n"), F.max(TOLD).alias("told"))
    least = F.min(F.when(F.col("n") == F.col("told"), F.col(RUN)))
    missing = F.raise_error(F.concat(F.lit("no whole run of partition "), F.col(PARTITION).cast("string"))).cast("long")
    kept = runs.groupBy(PARTITION).agg(least.alias("least")).select(PARTITION, F.coalesce("least", missing).alias(RUN))
    names = [c for c in staged.columns if c not in STAGE_COLUMNS]
    return staged.join(F.broadcast(kept), on=[PARTITION, RUN], how="left_semi").select(*(named(c) for c in names))


def kept_sql(table: str, columns: Sequence[str]) -> str:
    """The same as a query for the database, to make a view of or to insert from within one transaction. ``table`` and
    ``columns`` are spelled as the database wants them. A partition without a whole run is left out, so use
    :func:`kept_rows` to find one."""
    return (
        f"SELECT {', '.join(f's.{c}' for c in columns)} FROM {table} s JOIN ("
        f"SELECT {PARTITION}, MIN({RUN}) AS {RUN} FROM ("
        f"SELECT {PARTITION}, {RUN} FROM {table} GROUP BY {PARTITION}, {RUN} HAVING COUNT(*) = MAX({TOLD})"
        f") whole_runs GROUP BY {PARTITION}) kept"
        f" ON s.{PARTITION} = kept.{PARTITION} AND s.{RUN} = kept.{RUN}"
    )
