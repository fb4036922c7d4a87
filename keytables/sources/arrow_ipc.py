"""Arrow IPC files as a Spark data source, for reading and writing.

``spark.read.format("arrow_ipc").load(path)`` takes a file, a directory, a glob or a list of these;
``df.write.format("arrow_ipc").mode("append" or "overwrite").save(path)`` writes a directory. Call
:func:`register` once per session, or use :func:`read_arrow` and :func:`write_arrow`.

Reading. The driver lists files and reads one footer, for the schema. Tasks are cut by file size: small
files share a task and a large file is divided by record batches, or by rows where it has few of them: on local or
mounted paths, and elsewhere if it is not compressed. A compressed batch is fetched as a whole there, so a large file of one
such batch is read by one task, with a warning. Every task compares its files' schema with the table's: a difference, like
an unreadable file, fails the read. Spark does not tell a Python source which columns a query needs;
name them with ``columns`` (or a schema), and only these are read from the files. Where the session
sets ``spark.sql.python.filterPushdown.enabled``, rows that a simple condition rules out are not handed
to Spark.

Writing. A task streams its batches to a file of a name no other attempt uses. The commit lists the
files of the successful attempts in ``_SUCCESS``, and a directory that has such a list is read by it.
Output of lost, repeated or speculative attempts therefore never counts, whenever it appears. An
overwrite removes the old files only after that. Two jobs must not write to one path at a time.

Paths without a scheme are local or mounted; others go through ``pyarrow.fs``. For an object store
with its own address set ``endpoint``, ``accessKey``, ``secretKey`` and ``scheme``.
"""

from __future__ import annotations

import datetime
import fnmatch
import itertools
import json
import posixpath
import sys
import uuid
import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from weakref import WeakSet

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegralType,
    StringType,
    StructField,
    StructType,
)

from keytables.operators.size import remember_listed_bytes
from keytables.sources.batch_ranges import RangedBatches

FORMAT = "arrow_ipc"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
MANIFEST = "_SUCCESS"
_SPLIT_BYTES = 128 * 1024 * 1024
_FILE_COST = 4 * 1024 * 1024
# A task that would fetch fewer bytes of a batch on a store leaves them to the one that reads all of it.
_LEAST_RANGE = 1 << 16
_ROWS_PER_BATCH = 10_000
_WILDCARDS = "*?["
_REQUESTS = 32
# Of so many columns, the first that can be compared, the manifest keeps each file's range; longer texts are cut.
_RANGED_COLUMNS, _RANGED_LETTERS = 16, 64

_known: WeakSet[SparkSession] = WeakSet()


class Slice(NamedTuple):
    """Part ``index`` of ``count`` equal parts of a file."""

    path: str  # on the store, without scheme
    index: int
    count: int


class Written(WriterCommitMessage):
    def __init__(self, index: int, name: str | None, statistics: dict | None = None):
        self.index = index
        self.name = name
        self.statistics = statistics


def register(spark: SparkSession) -> None:
    """Make the format known to the session. The source travels to the workers by value, so they need
    pyarrow but not this package."""
    if spark in _known:
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # Spark looks for the name in the active session, which a session becomes by making a table.
    spark.createDataFrame([], "active int")
    spark.dataSource.register(ArrowIpcDataSource)
    _known.add(spark)


def read_arrow(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    split_by: str = "size",
    between: Mapping[str, tuple] | None = None,
    **options: str,
) -> DataFrame:
    """The table held in ``paths``, or its ``columns``.

    ``between`` gives columns' least and largest wanted values, numbers or texts (None for no bound): only such rows come,
    and files that cannot hold any, by what their table's manifest says, are not opened. So are files that
    cannot meet a filter that Spark hands to the source. Files without such statistics are read.

    A task gets about 128 MiB, or what the option ``splitBytes`` says. ``split_by="batch"`` makes one
    task per record batch instead, for few files with costly rows: the driver then reads every footer.
    """
    register(spark)
    found = {"paths": json.dumps([paths] if isinstance(paths, str) else list(paths)), **options}
    reader = spark.read.format(FORMAT).option("splitBy", split_by).options(**options)
    reader = reader.option("minTasks", spark.sparkContext.defaultParallelism)
    # Spark refuses a source that takes filters while the setting is off.
    reader = reader.option("pushFilters", spark.conf.get(PUSHDOWN, "false"))
    if columns:
        reader = reader.option("columns", json.dumps([*columns, *(c for c in between or () if c not in columns)]))
    if between:
        reader = reader.option("between", json.dumps({c: list(ends) for c, ends in between.items()}))
    df = reader.load(paths) if isinstance(paths, str) else reader.option("paths", found["paths"]).load()
    for column, (low, high) in (between or {}).items():
        df = df if low is None else df.where(df[column] >= low)
        df = df if high is None else df.where(df[column] <= high)
    if between and columns:
        df = df.select(*(df[c] for c in columns))
    return remember_listed_bytes(df, lambda: sum(f.size for f in list_files(found)[1]))


def write_arrow(
    df: DataFrame,
    path: str,
    mode: str = "error",
    compression: str | None = None,
    **options: str,
) -> None:
    """Write one file per non-empty partition, in partition order.

    ``mode`` is error (if there are files already), append or overwrite; ``compression`` lz4 or zstd.
    """
    register(df.sparkSession)
    if mode == "error":
        store, base = open_store({k.lower(): v for k, v in options.items()}, path)
        if _data_files(store, base):
            raise FileExistsError(f"{path} holds files already")
        mode = "append"
    writer = df.write.format(FORMAT).mode(mode).options(**options)
    if compression:
        writer = writer.option("compression", compression)
    writer.save(path)


class ArrowIpcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        store, path = first_file(self.options)
        with store.open_input_file(path) as f:
            whole = spark_schema(ipc.open_file(f).schema)
        columns = self.options.get("columns")
        if columns:
            return StructType([_one_field(whole, c, path) for c in json.loads(columns)])
        # Kept with the source: the reader then holds every file to this very schema.
        self.whole = True
        return whole

    def reader(self, schema: StructType) -> DataSourceReader:
        pushes = self.options.get("pushFilters", "false") == "true"
        kind = FilteringReader if pushes else ArrowIpcReader
        return kind(dict(self.options), schema, getattr(self, "whole", False))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowIpcWriter(dict(self.options), schema, overwrite)


class ArrowIpcReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: StructType, whole: bool):
        self.options = {k.lower(): v for k, v in options.items()}
        self.schema = schema
        self.whole = whole

    def _files(self) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
        """The files that may hold rows wanted."""
        store, files = list_files(self.options)
        bounds = json.loads(self.options.get("between", "{}"))
        tests = [(c, sign, v) for c, ends in bounds.items() for sign, v in zip((">=", "<="), ends) if v is not None]
        tests += self._tests()
        if not tests:
            return store, files
        known = file_statistics(self.options)
        return store, [f for f in files if _may_hold(known.get(f.path), f.size, tests)]

    def _tests(self) -> list[tuple]:
        return []

    def partitions(self) -> list[InputPartition]:
        store, files = self._files()
        if self.options.get("splitby", "size") == "batch":

            def count_batches(file: fs.FileInfo) -> int:
                with store.open_input_file(file.path) as f:
                    return ipc.open_file(f).num_record_batches

            counts = _at_once(count_batches, files)
            slices = [
                [Slice(file.path, i, count)]
                for file, count in zip(files, counts, strict=True)
                for i in range(count)
            ]
        else:
            slices = cut_by_size(
                files,
                int(self.options.get("splitbytes", _SPLIT_BYTES)),
                int(self.options.get("mintasks", 1)),
            )
        return [InputPartition(s) for s in slices]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        # Spark asks for one task without a partition when there is none.
        for part in partition.value if partition is not None else []:
            yield from self._read_slice(part)

    def _read_slice(self, part: Slice) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        store, _ = open_store(self.options, _paths(self.options)[0])
        with store.open_input_file(part.path) as f:
            file = ipc.open_file(f)
            found = file.schema
            self._check(found, part.path)
            if found.names != target.names:
                wanted = [found.get_field_index(n) for n in target.names]
                file = ipc.open_file(f, options=ipc.IpcReadOptions(included_fields=wanted))
            by_rows, ranged = isinstance(store, fs.LocalFileSystem), None
            if not by_rows and file.num_record_batches < part.count:
                if f.size() // part.count >= _LEAST_RANGE:
                    ranged = RangedBatches.of(f, found, target.names, file.num_record_batches)
                if ranged is None and part.index == 0:
                    # pyarrow fetches a batch as a whole. Cutting it in several tasks would fetch it as often.
                    warnings.warn(
                        f"{part.path} has {file.num_record_batches} record batches for {part.count} tasks; write "
                        "files of more batches, or uncompressed ones, to read them in parallel",
                        stacklevel=2,
                    )
            for number, start, stop in slice_rows(part, file.num_record_batches, by_rows or ranged is not None):
                batch = file.get_batch(number) if ranged is None else None
                rows = ranged.rows(number) if batch is None else batch.num_rows
                low, high = (rows * edge // part.count for edge in (start, stop))
                wanted = ranged.fetch(number, low, high) if batch is None else batch.slice(low, high - low)
                for row in range(0, high - low, _ROWS_PER_BATCH):
                    yield self._kept(_converted(wanted.slice(row, _ROWS_PER_BATCH), target))

    def _kept(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch

    def _check(self, found: pa.Schema, path: str) -> None:
        given = spark_schema(found)
        if self.whole and given.names != self.schema.names:
            raise ValueError(f"{path} has columns {given.names}, the table {self.schema.names}")
        for field in self.schema:
            other = _one_field(given, field.name, path)
            if not _same_type(other.dataType, field.dataType):
                raise ValueError(
                    f"{path} holds {field.name} as {other.dataType.simpleString()}, "
                    f"the table as {field.dataType.simpleString()}"
                )


class FilteringReader(ArrowIpcReader):
    """Leaves out rows that cannot meet a pushed condition. Spark still tests the rows it gets."""

    filters: Sequence[Filter] = ()

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        self.filters = [f for f in filters if self._usable(f)]
        return filters

    def _usable(self, condition: Filter) -> bool:
        if isinstance(condition, (IsNull, IsNotNull)):
            return len(condition.attribute) == 1
        if not isinstance(condition, (*_COMPARISONS, In)) or len(condition.attribute) != 1:
            return False
        kind = self.schema[condition.attribute[0]].dataType
        if isinstance(condition, In) and isinstance(kind, (FloatType, DoubleType)):
            return False  # looking up values tells -0.0 from 0.0, which are equal in Spark
        if isinstance(kind, StringType):
            return kind == StringType()
        return isinstance(kind, (IntegralType, FractionalType, BooleanType, DateType))

    def _tests(self) -> list[tuple]:
        return [
            (f.attribute[0], _SIGNS[type(f)], None if isinstance(f, (IsNull, IsNotNull)) else f.value) for f in self.filters
        ]

    def _kept(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        for condition in self.filters:
            batch = batch.filter(_may_meet(condition, batch.column(condition.attribute[0])))
        return batch


class ArrowIpcWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str], schema: StructType, overwrite: bool):
        self.options = {k.lower(): v for k, v in options.items()}
        self.schema = schema
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        index = task.partitionId()
        batches = (b for b in iterator if b.num_rows)
        first = next(batches, None)
        if first is None:
            return Written(index, None)
        name = f"part-{index:05d}-{self.job}-{task.taskAttemptId()}.arrow"
        return Written(index, name, self._write_file(name, first, batches))

    def commit(self, messages: list[Written | None]) -> None:
        done = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.index)
        names = [m.name for m in done]
        store, base = self._store()
        before = [posixpath.relpath(f.path, base) for f in list_directory(store, base, strict=False)]
        kept = [] if self.overwrite else [n for n in before if self.job not in n]
        if not names and not kept:
            # An empty table still has a schema.
            names = [f"part-00000-{self.job}-0.arrow"]
            self._write_file(names[0])
        old = {} if self.overwrite else _read_manifest(store, base).get("statistics", {})
        known = {n: old[n] for n in kept if n in old} | {m.name: m.statistics for m in done if m.statistics}
        with store.open_output_stream(posixpath.join(base, MANIFEST)) as f:
            f.write(json.dumps({"files": kept + names} | ({"statistics": known} if known else {})).encode())
        present = {posixpath.relpath(f.path, base) for f in _data_files(store, base)}
        self._remove(n for n in present - set(kept + names) if self.overwrite or self.job in n)

    def abort(self, messages: list[Written | None]) -> None:
        store, base = self._store()
        self._remove(
            name
            for name in (posixpath.relpath(f.path, base) for f in _data_files(store, base))
            if self.job in name
        )

    def _store(self) -> tuple[fs.FileSystem, str]:
        paths = _paths(self.options)
        if len(paths) != 1:
            raise ValueError("give one path to write to")
        return open_store(self.options, paths[0])

    def _write_file(
        self, name: str, first: pa.RecordBatch | None = None, rest: Iterator[pa.RecordBatch] = iter(())
    ) -> dict:
        store, base = self._store()
        store.create_dir(base, recursive=True)
        schema = to_arrow_schema(self.schema)
        settings = ipc.IpcWriteOptions(compression=self.options.get("compression"))
        with (
            store.open_output_stream(posixpath.join(base, name)) as sink,
            ipc.new_file(sink, schema, options=settings) as writer,
        ):
            ranges = _Ranges(schema)
            for batch in rest if first is None else itertools.chain([first], rest):
                batch = _converted(batch, schema)
                writer.write_batch(batch)
                ranges.add(batch)
        size = store.get_file_info(posixpath.join(base, name)).size
        return {"rows": ranges.rows, "bytes": size, "columns": ranges.found()}

    def _remove(self, names: Iterator[str]) -> None:
        store, base = self._store()
        for name in names:
            store.delete_file(posixpath.join(base, name))


_COMPARISONS = {
    EqualTo: pc.equal,
    GreaterThan: pc.greater,
    GreaterThanOrEqual: pc.greater_equal,
    LessThan: pc.less,
    LessThanOrEqual: pc.less_equal,
}


_SIGNS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
    In: "in",
    IsNull: "null",
    IsNotNull: "not null",
}


class _Ranges:
    """The least and largest value and the number of nulls of columns that can be compared, batch by batch."""

    def __init__(self, schema: pa.Schema):
        kinds = pa.types
        compared = [
            f.name
            for f in schema
            if kinds.is_integer(f.type) or kinds.is_floating(f.type) or kinds.is_date32(f.type)
            or kinds.is_string(f.type) or kinds.is_large_string(f.type)
        ]
        self.rows = 0
        self._columns: dict[str, list] = {name: [None, None, 0] for name in compared[:_RANGED_COLUMNS]}

    def add(self, batch: pa.RecordBatch) -> None:
        self.rows += batch.num_rows
        for name, held in list(self._columns.items()):
            column = batch.column(name)
            if pa.types.is_floating(column.type) and pc.any(pc.is_nan(column)).as_py():
                del self._columns[name]  # Spark has NaN as the largest number and equal to itself
                continue
            ends = pc.min_max(column.cast(pa.int32()) if pa.types.is_date32(column.type) else column)
            low, high = ends["min"].as_py(), ends["max"].as_py()
            held[2] += column.null_count
            if low is not None:
                held[0] = low if held[0] is None else min(held[0], low)
                held[1] = high if held[1] is None else max(held[1], high)

    def found(self) -> dict[str, list]:
        """``[least, largest, nulls]``; a long text's beginning is a least value, but no largest one."""
        out = {}
        for name, (low, high, nulls) in self._columns.items():
            bounded = True
            if isinstance(low, str):
                bounded = len(high) <= _RANGED_LETTERS
                low = low[:_RANGED_LETTERS]
            out[name] = [low, high if bounded else None, nulls]
        return out


def _may_hold(known: dict | None, size: int, tests: Sequence[tuple]) -> bool:
    """Whether a file can hold a row that meets all ``tests`` (column, sign, value). A file that is not the one described may."""
    if known is None or known["bytes"] != size:
        return True
    for column, sign, value in tests:
        if column not in known["columns"]:
            continue
        low, high, nulls = known["columns"][column]
        if sign == "null":
            possible = nulls > 0
        elif nulls == known["rows"]:
            possible = False
        elif sign == "not null":
            possible = True
        else:
            possible = any(_in_range(low, high, "=" if sign == "in" else sign, v) for v in (value if sign == "in" else [value]))
        if not possible:
            return False
    return True


def _in_range(low, high, sign: str, value) -> bool:
    """Whether some value from ``low`` to ``high`` (None: no bound known) can be ``sign`` to ``value``."""
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        value = (value - datetime.date(1970, 1, 1)).days
    number = (int, float)
    if not (isinstance(value, str) and isinstance(low, str) or isinstance(value, number) and isinstance(low, number)):
        return True
    if value != value:
        return True
    above = high is None or (high > value if sign == ">" else high >= value)
    below = low < value if sign == "<" else low <= value
    return above if sign in (">", ">=") else below if sign in ("<", "<=") else above and below


def _may_meet(condition: Filter, column: pa.Array) -> pa.Array:
    if isinstance(condition, IsNull):
        return column.is_null()
    if isinstance(condition, IsNotNull):
        return column.is_valid()
    if isinstance(condition, In):
        met = pc.is_in(column, value_set=pa.array(list(condition.value), column.type))
    else:
        met = _COMPARISONS[type(condition)](column, pa.scalar(condition.value, column.type))
    # NaN equals itself and is the largest number in Spark; let Spark decide.
    return pc.or_kleene(met, pc.is_nan(column)) if pa.types.is_floating(column.type) else met


def cut_by_size(files: Sequence[fs.FileInfo], most: int, tasks: int) -> list[list[Slice]]:
    """File slices per task, in file order, of about ``most`` bytes or less."""
    total = sum(f.size + _FILE_COST for f in files)
    size = max(1, min(most, max(_FILE_COST, total // max(tasks, 1))))
    cut: list[list[Slice]] = []
    open_bytes = 0
    for file in files:
        count = -(-file.size // size)
        if count > 1:
            cut += [[Slice(file.path, i, count)] for i in range(count)]
            open_bytes = 0
            continue
        if not open_bytes or open_bytes + file.size > size:
            cut.append([])
            open_bytes = 0
        cut[-1].append(Slice(file.path, 0, 1))
        open_bytes += file.size + _FILE_COST
    return cut


def slice_rows(part: Slice, batches: int, by_rows: bool) -> Iterator[tuple[int, int, int]]:
    """(batch, start, stop) triples of a slice; start and stop count in ``part.count``-ths of the batch.

    A file with enough batches is cut between them. One with few is cut inside them where this costs
    no second read; elsewhere some slices stay empty.
    """
    low, high = part.index * batches, (part.index + 1) * batches
    for number in range(batches):
        if by_rows and batches < part.count:
            start = min(max(low - number * part.count, 0), part.count)
            stop = min(max(high - number * part.count, 0), part.count)
            if start < stop:
                yield number, start, stop
        elif low <= number * part.count < high:
            yield number, 0, part.count


def open_store(options: Mapping[str, str], path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it."""
    scheme, found, rest = path.partition(":")
    if not found or "/" in scheme:
        return fs.LocalFileSystem(use_mmap=True), path
    if scheme == "file":
        return fs.LocalFileSystem(use_mmap=True), "/" + rest.lstrip("/")
    if scheme in ("s3", "s3a", "s3n"):
        path = "s3:" + rest
        if options.get("endpoint"):
            return _addressed_store(options), rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def _addressed_store(options: Mapping[str, str]) -> fs.FileSystem:
    return fs.S3FileSystem(
        endpoint_override=options["endpoint"],
        access_key=options.get("accesskey"),
        secret_key=options.get("secretkey"),
        scheme=options.get("scheme", "https"),
    )


def first_file(options: Mapping[str, str]) -> tuple[fs.FileSystem, str]:
    """The file that gives the schema. A directory with a manifest is not walked for it."""
    options = {k.lower(): v for k, v in options.items()}
    for path in _paths(options)[:1]:
        store, base = open_store(options, path)
        info = _matches(store, base)[0]
        listed = _manifest(store, info.path) if info.type == fs.FileType.Directory else None
        if listed:
            return store, posixpath.join(info.path, listed[0])
    store, files = list_files(options)
    if not files:
        raise FileNotFoundError(f"no Arrow file at {_paths(options)}")
    return store, files[0].path


def list_files(options: Mapping[str, str]) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    """The store and the files of all paths, in the order given. All paths are on one store."""
    options = {k.lower(): v for k, v in options.items()}
    paths = _paths(options)
    if not paths:
        raise ValueError("no path given")
    store, _ = open_store(options, paths[0])

    def files_of(path: str) -> list[fs.FileInfo]:
        other, base = open_store(options, path)
        if not other.equals(store):
            raise ValueError(f"{path} is on another store than {paths[0]}")
        files = []
        for info in _matches(other, base):
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(f"no such path: {path}")
            is_table = info.type == fs.FileType.Directory
            files += list_directory(other, info.path) if is_table else [info]
        return files

    return store, [file for files in _at_once(files_of, paths) for file in files]


def _at_once(work: Callable, items: Sequence) -> list:
    """The results in order; the work mostly waits for the store."""
    with ThreadPoolExecutor(_REQUESTS) as pool:
        return list(pool.map(work, items))


def list_directory(store: fs.FileSystem, base: str, strict: bool = True) -> list[fs.FileInfo]:
    """Files of a directory: those its manifest lists, in that order, or all but hidden ones."""
    present = _data_files(store, base)
    listed = _manifest(store, base)
    if listed is None:
        return present
    by_name = {posixpath.relpath(f.path, base): f for f in present}
    lost = [n for n in listed if n not in by_name]
    if lost and strict:
        raise FileNotFoundError(f"{base} lists files that are gone: {', '.join(lost[:5])}")
    return [by_name[n] for n in listed if n in by_name]


def _data_files(store: fs.FileSystem, base: str) -> list[fs.FileInfo]:
    selector = fs.FileSelector(base, recursive=True, allow_not_found=True)
    found = (f for f in store.get_file_info(selector) if f.type == fs.FileType.File)
    shown = [
        f
        for f in found
        if not any(part[0] in "._" for part in posixpath.relpath(f.path, base).split("/"))
    ]
    return sorted(shown, key=lambda f: f.path)


def _read_manifest(store: fs.FileSystem, base: str) -> dict:
    info = store.get_file_info(posixpath.join(base, MANIFEST))
    if info.type != fs.FileType.File or not info.size:
        return {}
    with store.open_input_stream(info.path) as f:
        return json.loads(f.read())


def _manifest(store: fs.FileSystem, base: str) -> list[str] | None:
    return _read_manifest(store, base).get("files")


def file_statistics(options: Mapping[str, str]) -> dict[str, dict]:
    """What manifests say of the files of all paths, by the file's path: ``rows, bytes, columns``."""
    options = {k.lower(): v for k, v in options.items()}

    def of(path: str) -> dict[str, dict]:
        store, base = open_store(options, path)
        found = {}
        for info in _matches(store, base):
            if info.type == fs.FileType.Directory:
                known = _read_manifest(store, info.path).get("statistics", {})
                found |= {posixpath.join(info.path, name): x for name, x in known.items()}
        return found

    return {path: x for found in _at_once(of, _paths(options)) for path, x in found.items()}


def listed_rows(paths: str | Sequence[str], **options: str) -> int | None:
    """How many rows the files of ``paths`` hold by their manifests; None if any is not described, or has another size."""
    options = {"paths": json.dumps([paths] if isinstance(paths, str) else list(paths)), **options}
    _, files = list_files(options)
    known = file_statistics(options)
    if any(f.path not in known or known[f.path]["bytes"] != f.size for f in files):
        return None
    return sum(known[f.path]["rows"] for f in files)


def _matches(store: fs.FileSystem, pattern: str) -> list[fs.FileInfo]:
    """A path itself, or what a glob stands for."""
    if not any(c in pattern for c in _WILDCARDS):
        return [store.get_file_info(pattern)]
    found = [""]
    parts = pattern.split("/")
    for depth, part in enumerate(parts):
        if not any(c in part for c in _WILDCARDS):
            found = [f"{base}/{part}" if depth else part for base in found]
            continue
        found = [
            info.path
            for base in found
            for info in store.get_file_info(
                fs.FileSelector(base or ("/" if depth else "."), allow_not_found=True)
            )
            if fnmatch.fnmatchcase(info.base_name, part) and info.base_name[0] not in "._"
        ]
    infos = [i for i in (store.get_file_info(sorted(found)) if found else [])]
    kept = [i for i in infos if i.type != fs.FileType.NotFound]
    if not kept:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return kept


def _paths(options: Mapping[str, str]) -> list[str]:
    options = {k.lower(): v for k, v in options.items()}
    several = json.loads(options["paths"]) if options.get("paths") else []
    return several + ([options["path"]] if options.get("path") else [])


def spark_schema(schema: pa.Schema) -> StructType:
    """The exact Spark types; a timestamp without zone stays without."""
    return StructType(
        [StructField(f.name, from_arrow_type(_readable(f.type), True), True) for f in schema]
    )


def _readable(kind: pa.DataType) -> pa.DataType:
    """The type to read as, where Spark has no such type: the next wider signed integer, float, date
    or the dictionary's values."""
    wider = {
        pa.uint8(): pa.int16(),
        pa.uint16(): pa.int32(),
        pa.uint32(): pa.int64(),
        pa.uint64(): pa.int64(),
        pa.float16(): pa.float32(),
        pa.date64(): pa.date32(),
    }
    if pa.types.is_dictionary(kind):
        return _readable(kind.value_type)
    if pa.types.is_time(kind):
        return pa.time64("ns")
    return wider.get(kind, kind)


def _converted(batch: pa.RecordBatch, target: pa.Schema) -> pa.RecordBatch:
    columns = [_cast(batch.column(f.name), f.type) for f in target]
    return pa.RecordBatch.from_arrays(columns, schema=target)


def _cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
    if column.type == kind:
        return column
    return _whole_microseconds(column).cast(kind)


def _whole_microseconds(column: pa.Array) -> pa.Array:
    """Nanoseconds, also nested ones, rounded down to what Spark keeps. Whatever else is cast must fit."""
    kind = column.type
    if pa.types.is_timestamp(kind) and kind.unit == "ns":
        null = column.is_null()
        count = column.view(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False) // 1000
        whole = pa.array(count, mask=null.to_numpy(zero_copy_only=False))
        return whole.view(pa.timestamp("us", kind.tz))
    if not _holds_nanoseconds(kind):
        return column
    null = column.is_null()
    if pa.types.is_struct(kind):
        parts = [_whole_microseconds(column.field(i)) for i in range(kind.num_fields)]
        return pa.StructArray.from_arrays(parts, names=[f.name for f in kind], mask=null)
    if pa.types.is_map(kind):
        keys, items = _whole_microseconds(column.keys), _whole_microseconds(column.items)
        filled = pa.MapArray.from_arrays(column.offsets, keys, items)
        return pc.if_else(null, pa.scalar(None, filled.type), filled) if column.null_count else filled
    if pa.types.is_dictionary(kind):
        return _whole_microseconds(column.dictionary_decode())
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        make = pa.ListArray if pa.types.is_list(kind) else pa.LargeListArray
        values = _whole_microseconds(column.values)
        # A mask is not taken with offsets that begin elsewhere than at 0, so nulls are put in afterwards.
        filled = make.from_arrays(column.offsets, values)
        return pc.if_else(null, pa.scalar(None, filled.type), filled) if column.null_count else filled
    return column


def _holds_nanoseconds(kind: pa.DataType) -> bool:
    if pa.types.is_timestamp(kind):
        return kind.unit == "ns"
    if pa.types.is_dictionary(kind):
        return _holds_nanoseconds(kind.value_type)
    return any(_holds_nanoseconds(kind.field(i).type) for i in range(kind.num_fields))


def _one_field(schema: StructType, name: str, path: str) -> StructField:
    fields = [f for f in schema if f.name == name]
    if len(fields) != 1:
        raise ValueError(f"{path} holds {len(fields)} columns named {name}")
    return fields[0]


def _same_type(a, b) -> bool:
    """Equal but for whether nested values may be null."""
    return a.simpleString() == b.simpleString()
