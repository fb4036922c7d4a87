"""Database tables through Spark's JDBC source.

Spark runs the reads and writes; what is added here is the slicing of a table without a numeric range
column, the connection options per database and the column types of a table to be created.

Spark commits each write task on its own. A task that is lost after its commit and runs again leaves
its rows twice, so check the written table with ``key_contract`` where this matters.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keytables.functions.columns import named

# URL prefix and driver class per database, and the numbers they also go by.
_DATABASES = {
    "mysql": ("jdbc:mysql", "com.mysql.cj.jdbc.Driver"),
    "kingbase": ("jdbc:kingbase8", "com.kingbase8.Driver"),
}
_DATABASE_NUMBERS = {"1": "mysql", "2": "kingbase"}
DEFAULT_SLICES = 10
# The databases' functions for a random number from 0 to 1.
_RANDOM = {"mysql": "RAND()", "kingbase": "RANDOM()"}

# Rows per round trip. Without a cursor MySQL's driver holds a whole slice in memory.
_FETCH = {"fetchsize": "10000"}
_FETCH_MYSQL = {"useCursorFetch": "true"}

_LENGTH_METADATA = "__CHAR_VARCHAR_TYPE_STRING"


def jdbc_options(
    dialect: str,
    host: str,
    port: int,
    database: str,
    user: str | None = None,
    password: str | None = None,
) -> tuple[str, dict[str, str]]:
    """URL and connection properties; credentials are in the properties only."""
    dialect = _DATABASE_NUMBERS.get(dialect, dialect)
    if dialect not in _DATABASES:
        raise ValueError(f"no such database: {dialect!r}; known are {', '.join(_DATABASES)}")
    prefix, driver = _DATABASES[dialect]
    properties = {"driver": driver, **_fetching(dialect)}
    if user:
        properties["user"] = user
    if password:
        properties["password"] = password
    return f"{prefix}://{host}:{port}/{database}", properties


def _fetching(dialect: str) -> dict[str, str]:
    return {**_FETCH, **(_FETCH_MYSQL if dialect == "mysql" else {})}


def _dialect(url: str, dialect: str | None) -> str:
    """The dialect given, or that of the URL."""
    if dialect is not None:
        return _DATABASE_NUMBERS.get(dialect, dialect)
    for name, (prefix, _) in _DATABASES.items():
        if url.startswith(prefix):
            return name
    raise ValueError(f"give a dialect for {url.split('//')[0]}")


def range_predicates(
    key: str, low: object, high: object, num_slices: int, dialect: str, nulls_by: str | None = None
) -> list[str]:
    """Conditions that cut a table into ``num_slices`` ranges of one integer, decimal or date column.

    Unlike a hash, a range can be served by an index on the column. ``low`` and ``high`` are its least and
    greatest value as far as known; values beyond them fall in the first and last slice, so no row is lost if the
    table has changed. Rows with a null key are a slice more or, with ``nulls_by``, as many slices as ranges, by the
    hash of that column, and one for those in which it is null as well.
    """
    if num_slices < 1:
        raise ValueError("num_slices must be at least 1")
    edges = _edges(low, high, num_slices) if low is not None and high is not None else []
    return edge_predicates(key, edges, dialect, nulls_by, num_slices)


def edge_predicates(
    key: str,
    edges: Sequence[object],
    dialect: str,
    nulls_by: str | None = None,
    null_slices: int = DEFAULT_SLICES,
) -> list[str]:
    """Conditions for the ranges that begin at each of the ascending ``edges``, the one before the first, and null
    keys: one slice, or ``null_slices`` by the hash of ``nulls_by`` and one for those in which it is null as well."""
    dialect = _DATABASE_NUMBERS.get(dialect, dialect)
    (name,) = _quoted([key], dialect)
    for edge in edges:
        _check_kind(edge)
    shown = [_literal(e) for e in edges]
    if not shown:
        slices = [f"{name} IS NOT NULL"]
    else:
        slices = [f"{name} < {shown[0]}"]
        slices += [f"{name} >= {a} AND {name} < {b}" for a, b in zip(shown, shown[1:])]
        slices.append(f"{name} >= {shown[-1]}")
    if nulls_by is None:
        return [*slices, f"{name} IS NULL"]
    return slices + [f"{name} IS NULL AND {p}" for p in slice_predicates(nulls_by, null_slices, dialect)]


def even_edges(sample: DataFrame, key: str, num_slices: int) -> list:
    """The values at which ranges of about equally many rows begin, by a bounded sample of the key column.

    All rows of a value fall in one range. A value of more than an even share has a range to itself, so there may be more
    than ``num_slices`` of them, but fewer than twice as many. Of the sample itself, no other range holds more than
    two even shares. The sample is put in order in one task.
    """
    if num_slices < 1:
        raise ValueError("num_slices must be at least 1")
    counts = sample.select(named(key).alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.orderBy("k")
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = counts.select(
        "k",
        "n",
        F.sum("n").over(every).alias("total"),
        F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
    )
    shares = sums.select(
        "k",
        F.floor(F.col("before") * num_slices / F.col("total")).alias("share"),
        (F.col("n") * num_slices > F.col("total")).alias("heavy"),
    )
    # The least value has none before it, and the first range begins there by itself.
    further = F.col("share") > F.coalesce(F.lag("share").over(in_order), F.lit(0))
    begins = F.col("share").isNotNull() & (F.col("heavy") | further)
    return [row.k for row in shares.select("k", begins.alias("begins")).where("begins").sort("k").collect()]


def _edges(low: object, high: object, n: int) -> list:
    """The distinct values at which slices after the first begin."""
    _check_kind(low)
    days = isinstance(low, datetime.date)
    a, b = (v.toordinal() if days else v for v in (low, high))
    exact = isinstance(a, int) and isinstance(b, int)
    found = sorted({a + ((b - a) * i // n if exact else (b - a) * i / n) for i in range(1, n)} - {a})
    return [datetime.date.fromordinal(v) for v in found] if days else found


def _check_kind(value: object) -> None:
    if isinstance(value, datetime.datetime) or not isinstance(value, (int, Decimal, datetime.date)):
        raise ValueError(f"ranges need an integer, decimal or date column, not {type(value).__name__}")


def _literal(value: object) -> str:
    return f"DATE '{value.isoformat()}'" if isinstance(value, datetime.date) else str(value)


def read_jdbc_ranged(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    num_partitions: int = DEFAULT_SLICES,
    dialect: str | None = None,
    properties: Mapping[str, str] | None = None,
    nulls_by: str | None = None,
    sample_rows: int = 0,
) -> DataFrame:
    """A whole table, read in ranges of an integer, decimal or date column.

    The database is asked for the column's least and greatest value first. Prefer this to
    :func:`read_jdbc_hashed` where the column has an index, which a hash cannot use: there every slice is a
    scan of the table. Ranges are of equal width, so unevenly spread values make uneven slices; with ``sample_rows`` they
    are of about equally many rows instead, by a random sample of about so many keys, which the database draws
    in a scan of the column. The sample decides where slices begin only, not which rows are read.
    """
    dialect = _dialect(url, dialect)
    (name,) = _quoted([key], dialect)
    if sample_rows > 0:
        if dialect not in _RANDOM:
            raise ValueError(f"a sample needs a dialect of {', '.join(_RANDOM)}, not {dialect!r}")
        total = read_jdbc_query(spark, url, f"SELECT COUNT({name}) AS n FROM {table}", properties).first()[0]
        drawn = f"SELECT {name} AS k FROM {table} WHERE {name} IS NOT NULL"
        if total > sample_rows:
            drawn += f" AND {_RANDOM[dialect]} < {sample_rows / total:.12f}"
        edges = even_edges(read_jdbc_query(spark, url, drawn, properties), "k", num_partitions)
        return spark.read.jdbc(
            url=url,
            table=table,
            predicates=edge_predicates(key, edges, dialect, nulls_by, num_partitions),
            properties={**_fetching(dialect), **(properties or {})},
        )
    ends = read_jdbc_query(spark, url, f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}", properties)
    low, high = ends.first()
    return spark.read.jdbc(
        url=url,
        table=table,
        predicates=range_predicates(key, low, high, num_partitions, dialect, nulls_by),
        properties={**_fetching(dialect), **(properties or {})},
    )


def slice_predicates(key: str | Sequence[str], num_slices: int, dialect: str) -> list[str]:
    """Conditions that cut a table into ``num_slices`` slices by the hash of its key, and one more for
    rows with a null key, which no hash condition selects.

    A value's rows all fall in one slice, so prefer a unique key. Of several columns the hash is over
    all of them. ``dialect`` is ``mysql``, ``kingbase`` or, for one integer column of any database,
    ``numeric``.
    """
    names = [key] if isinstance(key, str) else list(key)
    if num_slices < 1:
        raise ValueError("num_slices must be at least 1")
    if not names:
        raise ValueError("slice_predicates needs at least one key column")
    number = _slice_number(names, num_slices, _DATABASE_NUMBERS.get(dialect, dialect))
    quoted = _quoted(names, _DATABASE_NUMBERS.get(dialect, dialect))
    nulls = " AND ".join(f"{q} IS NULL" for q in quoted)
    return [f"{number} = {i}" for i in range(num_slices)] + [nulls]


def _quoted(names: Sequence[str], dialect: str) -> list[str]:
    mark = "`" if dialect == "mysql" else '"'
    return [mark + n.replace(mark, mark * 2) + mark for n in names]


def _slice_number(names: Sequence[str], n: int, dialect: str) -> str:
    quoted = _quoted(names, dialect)
    if dialect == "mysql":
        value = f"CRC32({_joined(quoted, quoted)})"
        return f"MOD(ABS({value}), {n})"
    if dialect == "kingbase":
        value = f"hashtext({_joined(quoted, [q + '::text' for q in quoted])})"
    elif dialect == "numeric":
        if len(names) != 1:
            raise ValueError("the numeric dialect slices by one integer column")
        value = quoted[0]
    else:
        raise ValueError(f"dialect must be mysql, kingbase or numeric, not {dialect!r}")
    # The remainder first: the smallest integer has no absolute value.
    return f"ABS(MOD({value}, {n}))"


def _joined(plain: Sequence[str], texts: Sequence[str]) -> str:
    """One column's text, or several joined such that only an all-null key gives null."""
    if len(texts) == 1:
        return texts[0]
    filled = " OR ".join(f"{p} IS NOT NULL" for p in plain)
    return f"CASE WHEN {filled} THEN CONCAT_WS('|', {', '.join(texts)}) END"


def read_jdbc_hashed(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | Sequence[str],
    num_partitions: int = DEFAULT_SLICES,
    dialect: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table, read in ``num_partitions`` slices of the key's hash and one of its nulls. The dialect is
    that of the URL unless given.

    Spark adds its own filters and column list to each slice's query. Size ``num_partitions`` such that
    a slice suits a task; the database serves as many at a time as there are free cores.
    """
    dialect = _dialect(url, dialect)
    return spark.read.jdbc(
        url=url,
        table=table,
        predicates=slice_predicates(key, num_partitions, dialect),
        properties={**_fetching(dialect), **(properties or {})},
    )


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    key: str | Sequence[str] | None = None,
    num_partitions: int = DEFAULT_SLICES,
    dialect: str | None = None,
) -> DataFrame:
    """The result of a query that the database runs.

    Without ``key`` it arrives in one task, which suits a small result. With it the result is read in
    slices as :func:`read_jdbc_hashed` does, and the database runs the query for each of them.
    """
    text = query.strip().rstrip(";")
    if key is not None:
        table = f"({text}) subquery"
        return read_jdbc_hashed(spark, url, table, key, num_partitions, dialect, properties)
    options = {**_FETCH, **(properties or {})}
    return spark.read.format("jdbc").options(url=url, query=text, **options).load()


def jdbc_column_types(df: DataFrame) -> dict[str, str]:
    """Spark types per column, with the length of a database's varchar and char columns."""
    return {f.name: f.metadata.get(_LENGTH_METADATA, f.dataType.simpleString()) for f in df.schema}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str | None = None,
    column_types: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
) -> str:
    """Write a table and return its name, ``result_<8 hex digits>`` unless given.

    ``column_types`` are Spark types, such as ``VARCHAR(40)``, for the table to be created; columns
    that ``df`` lacks are left out. By default lengths known from a database are kept. ``numPartitions``
    among the properties bounds the number of connections.
    """
    table = table or f"result_{uuid.uuid4().hex[:8]}"
    types = jdbc_column_types(df) if column_types is None else column_types
    declared = create_types(df, types)
    writer = df.write.mode(mode)
    if declared:
        writer = writer.option("createTableColumnTypes", declared)
    writer.jdbc(url, table, properties=dict(properties or {}))
    return table


def create_types(df: DataFrame, types: Mapping[str, str]) -> str:
    """The column list Spark expects. Plain strings are left to the database's own text type."""
    return ", ".join(
        f"`{name.replace('`', '``')}` {kind}"
        for name, kind in types.items()
        if name in df.columns and kind.lower() != "string"
    )
