"""Ranges and row counts in the manifest: what they leave out, and when they are not believed."""

import datetime
import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keytables.operators import write_sorted
from keytables.plans import jobs
from keytables.sources import read_arrow, write_arrow
from keytables.sources.arrow_ipc import MANIFEST, PUSHDOWN, _in_range, _may_hold, _Ranges, listed_rows


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """8 files of 1,000 keys each, one after the other."""
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    table = spark.range(8000).selectExpr("id AS k", "concat('key', lpad(id, 6, '0')) AS s", "CAST(id AS DOUBLE) / 2 AS x")
    write_sorted(table, "k", jobs.arrow_saver(path), num_partitions=8)
    return path


def files_opened(df):
    return df.rdd.getNumPartitions()


def wanted(path, spark, **between):
    return read_arrow(spark, path, split_by="batch", between=between)


def test_a_range_opens_only_the_files_that_can_hold_it(spark, clustered):
    whole = read_arrow(spark, clustered, split_by="batch")
    everything = files_opened(whole)
    some = wanted(clustered, spark, k=(10, 20))
    assert sorted(r.k for r in some.collect()) == list(range(10, 21))
    assert files_opened(some) <= everything / 4
    texts = wanted(clustered, spark, s=(None, "key000500"))
    assert texts.count() == 501 and files_opened(texts) <= everything / 4
    both = wanted(clustered, spark, k=(None, 100), x=(3000, None))
    assert both.count() == 0 and files_opened(both) <= 1
    assert wanted(clustered, spark, k=(None, None)).count() == 8000


def test_columns_of_a_range(spark, clustered):
    got = read_arrow(spark, clustered, columns=["x"], between={"k": (5, 6)})
    assert got.columns == ["x"] and sorted(r.x for r in got.collect()) == [2.5, 3.0]


def test_pushed_filters_leave_files_out(spark, clustered):
    spark.conf.set(PUSHDOWN, "true")
    try:
        whole = read_arrow(spark, clustered, split_by="batch")
        everything = files_opened(whole)
        for condition, rows in (("k = 77", 1), ("k > 7990", 9), ("s IN ('key000001', 'key000002')", 2), ("x < 1", 2), ("k IS NULL", 0)):
            df = whole.where(condition)
            assert df.count() == rows and files_opened(df) <= everything / 4, condition
    finally:
        spark.conf.set(PUSHDOWN, "false")


def test_counts_are_from_the_manifest(spark, clustered, tmp_path):
    assert listed_rows(clustered) == 8000
    count = jobs.count_job(spark, clustered)
    assert "arrow" not in count._jdf.queryExecution().executedPlan().toString().lower().replace("arrowevalpython", "")
    assert [tuple(r) for r in count.collect()] == [(8000,)]
    assert jobs.count_job(spark, clustered, "k < 10").first()[0] == 10
    path = str(tmp_path / "empty")
    write_arrow(spark.range(0).toDF("k"), path)
    assert jobs.count_job(spark, path).first()[0] == 0


def test_appended_files_keep_and_add_statistics(spark, tmp_path):
    path = str(tmp_path / "t")
    write_arrow(spark.range(10).toDF("k").coalesce(1), path)
    write_arrow(spark.range(100, 105).toDF("k").coalesce(1), path, "append")
    assert listed_rows(path) == 15
    assert files_opened(wanted(path, spark, k=(100, None))) == 1 and wanted(path, spark, k=(100, None)).count() == 5
    write_arrow(spark.range(3).toDF("k").coalesce(1), path, "overwrite")
    assert listed_rows(path) == 3


def test_files_without_or_with_other_statistics_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_arrow(spark.range(10).toDF("k").coalesce(1), path)
    manifest = os.path.join(path, MANIFEST)
    whole = json.loads(open(manifest).read())
    for change in ("none", "other file", "missing column"):
        known = json.loads(json.dumps(whole))
        (one,) = known["statistics"].values()
        one["rows"], one["columns"]["k"] = 99, [500, 600, 0]
        if change == "none":
            del known["statistics"]
        elif change == "other file":
            one["bytes"] += 1
        else:
            one["rows"], one["columns"] = 10, {}
        with open(manifest, "w") as f:
            f.write(json.dumps(known))
        assert wanted(path, spark, k=(3, 4)).count() == 2, change
        assert jobs.count_job(spark, path).first()[0] == 10, change
    # Single files and patterns have no manifest.
    assert listed_rows(f"{path}/part-*.arrow") is None
    assert jobs.count_job(spark, f"{path}/part-*.arrow").first()[0] == 10


def test_ranges_of_odd_values():
    long = "z" * 100
    batch = pa.record_batch(
        {
            "i": pa.array([None, 3, -2]),
            "zero": pa.array([-0.0, 0.0, None]),
            "nan": pa.array([1.0, float("nan"), 2.0]),
            "s": pa.array(["a", long, None]),
            "d": pa.array([datetime.date(1970, 1, 3), datetime.date(1969, 12, 31), None]),
            "none": pa.array([None, None, None], pa.int32()),
            "list": pa.array([[1], None, []]),
        }
    )
    ranges = _Ranges(batch.schema)
    for piece in (batch.slice(0, 1), batch.slice(1, 0), batch.slice(1)):
        ranges.add(piece)
    found = ranges.found()
    assert ranges.rows == 3 and set(found) == {"i", "zero", "s", "d", "none"}
    assert found["i"] == [-2, 3, 1] and found["d"] == [-1, 2, 1] and found["none"] == [None, None, 3]
    assert found["s"] == ["a", None, 1]  # the beginning of a long text is no largest value
    known = {"rows": 3, "bytes": 10, "columns": json.loads(json.dumps(found))}
    may = lambda *test: _may_hold(known, 10, [test])
    assert may("zero", "=", 0.0) and may("zero", "=", -0.0) and not may("zero", ">", 0.0)
    assert may("nan", "=", 50.0) and may("s", "=", long) and may("s", ">", "zzz") and not may("s", "<", "a")
    assert may("d", "=", datetime.date(1970, 1, 1)) and not may("d", "<", datetime.date(1969, 12, 31))
    assert may("none", "null", None) and not may("none", "not null", None) and not may("none", "=", 1)
    assert not may("i", "in", [7, 8]) and may("i", "in", [7, 3]) and may("i", "=", float("nan"))
    assert _may_hold(known, 11, [("i", "=", 99)]) and _may_hold(None, 10, [("i", "=", 99)])


@pytest.mark.parametrize("low, high", [(1, 4), (2, 2)])
def test_in_range_equals_a_search(low, high):
    import operator

    signs = {"=": operator.eq, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
    for sign, meets in signs.items():
        for value in range(0, 6):
            assert _in_range(low, high, sign, value) == any(meets(x, value) for x in range(low, high + 1)) or sign in "<>"


def test_skipping_changes_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(500).selectExpr(
        "IF(id % 7 = 0, NULL, pmod(hash(id), 50)) AS a", "IF(id % 11 = 0, double('nan'), id % 13) AS x", "repeat(char(97 + id % 5), 70) AS s"
    )
    write_arrow(table.repartitionByRange(6, "a"), path)
    for bounds in ({"a": (10, 20)}, {"x": (5, None)}, {"x": (None, 2)}, {"s": ("b", "c")}, {"a": (60, None)}):
        ((column, (low, high)),) = bounds.items()
        want = table
        want = want if low is None else want.where(F.col(column) >= low)
        want = want if high is None else want.where(F.col(column) <= high)
        got = read_arrow(spark, path, between=bounds)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), bounds
