"""The eight jobs, each a composition of operators.

A source is a DataFrame (a table read over JDBC, Parquet, ...) or one or more paths of Arrow files. A
job gives its result as a DataFrame, to be written with ``write_arrow``, ``write_jdbc`` or any other
writer, unless writing is part of what it does. A failure is raised, never only logged.

A *saver* writes a table and returns a function that reads it back, whole or some columns of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytables.functions.keys import HASH_COLUMN
from keytables.operators.aggregate import count_rows, group_count
from keytables.operators.contracts import check_key
from keytables.operators.joins import join_tables, psi_join
from keytables.operators.order import sort_table, write_sorted
from keytables.operators.select import Conditions, add_hash_column, key_filter, project
from keytables.operators.size import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS
from keytables.sources.arrow_ipc import listed_rows, read_arrow, write_arrow
from keytables.sources.jdbc import (
    DEFAULT_SLICES,
    jdbc_column_types,
    read_jdbc_hashed,
    write_jdbc,
)
from keytables.sources.key_file import export_key_column
from keytables.sources.scratch import scratch_table, write_scratch
from keytables.sources.staging import kept_rows, stage_rows

Source = DataFrame | str | Sequence[str]
Reader = Callable[[Sequence[str] | None], DataFrame]
Saver = Callable[[DataFrame], Reader]


def load(spark: SparkSession, source: Source, columns: Sequence[str] | None = None) -> DataFrame:
    """The source's table, or its ``columns``; of Arrow files nothing else is read then."""
    if isinstance(source, DataFrame):
        return project(source, columns)
    return read_arrow(spark, source, columns)


def arrow_saver(path: str, mode: str = "overwrite") -> Saver:
    """Saves as a directory of Arrow files."""

    def save(df: DataFrame) -> Reader:
        write_arrow(df, path, mode)
        return lambda columns=None: read_arrow(df.sparkSession, path, columns)

    # The files of a write that fails never count.
    save.publishes_whole = True
    return save


def jdbc_saver(
    url: str,
    key: str,
    dialect: str | None = None,
    table: str | None = None,
    num_partitions: int = DEFAULT_SLICES,
    properties: Mapping[str, str] | None = None,
    column_types: Mapping[str, str] | None = None,
    check: bool = True,
    staged: bool = False,
) -> Saver:
    """Saves as a database table, to be read back in slices of ``key``.

    ``column_types`` declares columns of the table by Spark types, besides those whose length is known: a text
    column that is to be a primary key needs one such as ``VARCHAR(64)``. With ``check`` the rows written
    are counted against those of the table given, which a task that ran twice would have doubled; a difference
    raises ``RuntimeError``. That counts the given table again, so hand a written one over.

    ``staged`` makes repeated tasks harmless: the table has three more columns, by which what is read back holds each row
    once, and :func:`~keytables.sources.staging.kept_sql` is the query to make the database's own table with. The number of
    connections is that of ``df``'s partitions then.
    """
    if staged and "numPartitions" in (properties or {}):
        raise ValueError("a staged table is written by one task for each partition: repartition it instead")

    def save(df: DataFrame) -> Reader:
        # Of the table given, as the staged one need not keep the lengths of its columns.
        declared = {"column_types": {**jdbc_column_types(df), **(column_types or {})}} if column_types or staged else {}
        name = write_jdbc(stage_rows(df) if staged else df, url, table, properties=properties, **declared)
        saved = read_jdbc_hashed(df.sparkSession, url, name, key, num_partitions, dialect, properties)
        saved = kept_rows(saved) if staged else saved
        if check and (found := saved.count()) != (wanted := df.count()):
            raise RuntimeError(f"{name} has {found} rows, not the {wanted} written to it")
        return lambda columns=None: project(saved, columns)

    return save


def query_job(
    spark: SparkSession,
    source: Source,
    in_columns: Sequence[str] = (),
    in_sources: Sequence[Source] = (),
    columns: Sequence[str | Column] | None = None,
    exprs: Sequence[str] | None = None,
    distinct: bool = False,
    read_columns: Sequence[str] | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    prefilter_bytes: int = 0,
) -> DataFrame:
    """Rows whose ``in_columns`` values are in the respective key tables, projected.

    Of the Arrow files of a key table only the key is read; of the main ones ``read_columns``, by
    default all.
    """
    if len(in_columns) != len(in_sources):
        raise ValueError("in_columns and in_sources must be equally long")
    keys = [(c, load(spark, s, [c])) for c, s in zip(in_columns, in_sources, strict=True)]
    kept = key_filter(
        load(spark, source, read_columns),
        keys,
        broadcast_max_rows=broadcast_max_rows,
        broadcast_max_bytes=broadcast_max_bytes,
        prefilter_bytes=prefilter_bytes,
    )
    return project(kept, columns, exprs, distinct)


def copy_job(spark: SparkSession, source: Source, save: Saver) -> DataFrame:
    """The table, saved and read back."""
    return save(load(spark, source))(None)


def sort_job(spark: SparkSession, source: Source, columns: Sequence[str]) -> DataFrame:
    return sort_table(load(spark, source), columns)


def count_job(
    spark: SparkSession,
    source: Source,
    conditions: Conditions = None,
    read_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Of Arrow files all columns are read, unless ``read_columns`` names those the conditions use.

    Without conditions no file is opened whose table's manifest tells its rows; else one column is read.
    """
    if conditions is None and not isinstance(source, DataFrame):
        rows = listed_rows(source)
        if rows is not None:
            return spark.range(1).select(F.lit(rows).cast("long").alias("count"))
        read_columns = read_columns or read_arrow(spark, source).columns[:1]
    return count_rows(load(spark, source, read_columns), conditions)


def group_count_job(
    spark: SparkSession,
    source: Source,
    columns: Sequence[str],
    conditions: Conditions = None,
    read_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Of Arrow files only the group columns are read or, with conditions, ``read_columns``."""
    if read_columns is None and conditions is None:
        read_columns = columns
    return group_count(load(spark, source, read_columns), columns, conditions)


def join_job(
    spark: SparkSession,
    table: Source,
    source: Source,
    on: str | Sequence[str],
    how: str = "inner",
    suffix: str | None = None,
    strategy: str = "auto",
    num_partitions: int | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    prefilter_bytes: int = 0,
) -> DataFrame:
    return join_tables(
        load(spark, table),
        load(spark, source),
        on,
        how,
        strategy,
        suffix,
        num_partitions,
        broadcast_max_rows,
        broadcast_max_bytes,
        prefilter_bytes,
    )


def hash_job(
    spark: SparkSession,
    source: Source,
    columns: Sequence[str],
    save: Saver,
    key_path: str,
    strict: bool = False,
) -> DataFrame:
    """Save the table with its hash key and publish the keys; gives the saved table.

    The keys are read back from the saved table, so the source is read and hashed once, and the keys
    are those of the saved rows.
    """
    saved = save(add_hash_column(load(spark, source), columns, strict=strict))
    export_key_column(saved([HASH_COLUMN]), HASH_COLUMN, key_path)
    return saved(None)


def psi_job(
    spark: SparkSession,
    source: Source,
    keys: Source,
    on: str | Sequence[str],
    order_by: str,
    how: str = "inner",
    strategy: str = "auto",
    suffix: str | None = None,
    num_partitions: int | None = None,
    save: Saver | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    prefilter_bytes: int = 0,
) -> DataFrame:
    """The keyed table joined with the returned keys, in the order of its primary key ``order_by``.

    The joined rows are written to the shared folder first: checking the key, finding the range
    boundaries and sorting would each join again otherwise. The first of them reads one column. With ``save``
    they are removed in the end, also after a failure; without it the result still reads them.
    """
    joined = psi_join(
        load(spark, source),
        load(spark, keys),
        on,
        how,
        strategy=strategy,
        suffix=suffix,
        num_partitions=num_partitions,
        broadcast_max_rows=broadcast_max_rows,
        broadcast_max_bytes=broadcast_max_bytes,
        prefilter_bytes=prefilter_bytes,
    )
    if save is not None:
        with scratch_table(joined, "psi") as written:
            return write_sorted(written, order_by, save)(None)
    joined = write_scratch(joined, "psi")
    check_key(joined, order_by)
    return sort_table(joined, order_by)
