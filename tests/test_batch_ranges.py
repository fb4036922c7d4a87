"""Ranges of rows of one record batch, on a store that is not local."""

import datetime
import decimal
import warnings

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs, ipc
from pyspark.sql.datasource import CaseInsensitiveDict

from keytables.sources import arrow_ipc, batch_ranges
from keytables.sources.arrow_ipc import ArrowIpcDataSource
from keytables.sources.batch_ranges import RangedBatches

N = 40_000


def some(value, i, every=7):
    return None if i % every == 0 else value


def table(n=N):
    day = datetime.date(2020, 1, 1)
    columns = {
        "whole": pa.array(range(n), pa.int64()),
        "small": pa.array([some(i % 100, i) for i in range(n)], pa.int8()),
        "flag": pa.array([some(i % 3 == 0, i, 5) for i in range(n)], pa.bool_()),
        "real": pa.array([some(i / 7, i, 11) for i in range(n)]),
        "day": pa.array([day + datetime.timedelta(i % 5000) for i in range(n)]),
        "time": pa.array([some(1_000_003 * i, i) for i in range(n)], pa.timestamp("us")),
        "nanos": pa.array([some(1_000_003 * i, i) for i in range(n)], pa.timestamp("ns")),
        "money": pa.array([some(decimal.Decimal(i) / 100, i) for i in range(n)], pa.decimal128(12, 2)),
        "text": pa.array([some("é" * (i % 9), i) for i in range(n)]),
        "bytes": pa.array([b"x" * (i % 4) for i in range(n)], pa.large_binary()),
        "list": pa.array([some([i] * (i % 4), i, 6) for i in range(n)], pa.list_(pa.int32())),
        "deep": pa.array([some([[str(i)] * (i % 3)] * (i % 2), i) for i in range(n)], pa.list_(pa.list_(pa.string()))),
        "pair": pa.array([some({"a": i, "b": some(f"b{i}", i, 3)}, i) for i in range(n)], pa.struct([("a", pa.int64()), ("b", pa.string())])),
        "map": pa.array([some([(f"k{j}", i + j) for j in range(i % 3)], i) for i in range(n)], pa.map_(pa.string(), pa.int64())),
        "nothing": pa.array([None] * n, pa.string()),
    }
    return pa.table(columns)


def save(path, data, batches=1, **options):
    with ipc.new_file(str(path), data.schema, options=ipc.IpcWriteOptions(**options)) as out:
        rows = -(-data.num_rows // batches)
        for i in range(batches):
            out.write_batch(data.slice(i * rows, rows).combine_chunks().to_batches()[0])
    return path.stat().st_size


@pytest.fixture(scope="module")
def whole():
    return table()


def open_ranged(path, data, columns=None, batches=1):
    file = fs.SubTreeFileSystem(str(path.parent), fs.LocalFileSystem()).open_input_file(path.name)
    return RangedBatches.of(file, data.schema, columns or data.column_names, batches)


@pytest.fixture(scope="module")
def ranged(tmp_path_factory, whole):
    path = tmp_path_factory.mktemp("ranges") / "t.arrow"
    save(path, whole)
    return open_ranged(path, whole)


@settings(deadline=None, max_examples=60)
@given(st.integers(0, N), st.integers(0, N))
@pytest.mark.filterwarnings("ignore")
def test_any_range_holds_its_rows(ranged, whole, one, other):
    low, high = min(one, other), min(max(one, other), min(one, other) + 300)
    got = ranged.fetch(0, low, high)
    got.validate(full=True)
    assert got.to_pydict() == whole.slice(low, high - low).to_pydict()


@pytest.mark.parametrize("batches", [1, 2])
@pytest.mark.parametrize("columns", [None, ["text", "whole"]])
def test_four_tasks_fetch_a_batch_once(tmp_path, monkeypatch, whole, batches, columns):
    size = save(tmp_path / "t.arrow", whole, batches)
    bucket = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(arrow_ipc, "open_store", lambda options, path: (bucket, path.removeprefix("s3a://")))
    monkeypatch.setattr(arrow_ipc, "_FILE_COST", 1)
    fetched, plain = [], batch_ranges._fill

    def counted(kind, buffers, start, stop, fill):
        def count(buffer, low, high):
            fetched.append(max(high - low, 0))
            fill(buffer, low, high)

        plain(kind, buffers, start, stop, count if fill.__name__ == "fill" else fill)

    monkeypatch.setattr(batch_ranges, "_fill", counted)
    options = {"path": "s3a://t.arrow", "splitBytes": str(-(-size // 4))}
    if columns:
        options["columns"] = '["text", "whole"]'
    source = ArrowIpcDataSource(CaseInsensitiveDict(options))
    reader = source.reader(source.schema())
    tasks = reader.partitions()
    assert len(tasks) == 4
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        found = [list(reader.read(p)) for p in tasks]
    rows = [sum(b.num_rows for b in batches_) for batches_ in found]
    assert max(rows) - min(rows) <= 2 and sum(rows) == N
    got = pa.Table.from_batches([b for batches_ in found for b in batches_]).drop_columns(["nanos"] if not columns else [])
    wanted = whole.select(columns) if columns else whole.drop_columns(["nanos"])
    assert got.to_pydict() == wanted.to_pydict()
    assert sum(fetched) < 1.05 * size if not columns else sum(fetched) < 0.3 * size


@pytest.mark.parametrize("kind", ["compressed", "compressed struct", "dictionary"])
def test_what_has_no_ranges_is_left_to_one_task(tmp_path, whole, kind):
    data = whole
    if kind == "compressed struct":
        data = whole.select(["pair"])
    if kind == "dictionary":
        data = pa.table({"a": pa.array(["x", "y"] * 500).dictionary_encode()})
    save(tmp_path / "t.arrow", data, **({"compression": "zstd"} if "compressed" in kind else {}))
    assert open_ranged(tmp_path / "t.arrow", data) is None


def test_an_empty_batch(tmp_path, whole):
    data = whole.slice(0, 0)
    with ipc.new_file(str(tmp_path / "t.arrow"), data.schema) as out:
        out.write_batch(pa.RecordBatch.from_pylist([], data.schema))
    found = open_ranged(tmp_path / "t.arrow", data)
    assert found.rows(0) == 0 and found.fetch(0, 0, 0).num_rows == 0
