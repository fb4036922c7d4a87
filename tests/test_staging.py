from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from keytables.plans import jobs
from keytables.sources import (
    kept_rows,
    kept_sql,
    scratch_path,
    scratch_scope,
    stage_rows,
    write_result,
    write_scratch,
)
from keytables.sources.staging import PARTITION, RUN, TOLD

STAGED = f"k long, v string, {PARTITION} long, {RUN} long, {TOLD} long"
# Partition 0 ran once; 1 twice; 2 was cut off, then whole; 3 whole twice, one run cut off between.
ROWS = [
    (1, "a", 0, 10, None), (1, "a", 0, 10, 2),
    (2, "b", 1, 12, 1), (2, "b", 1, 11, 1),
    (3, "c", 2, 13, None), (3, "c", 2, 20, None), (None, None, 2, 20, 2),
    (4, "d", 3, 14, 1), (4, "d", 3, 15, None), (4, "d", 3, 16, 1),
]
KEPT = Counter([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, None), (4, "d")])


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_each_partition_counts_once(spark):
    kept = kept_rows(spark.createDataFrame(ROWS, STAGED))
    assert kept.columns == ["k", "v"]
    assert rows(kept) == KEPT


def test_the_database_says_the_same():
    connection = duckdb.connect()  # in this process
    connection.execute(f"CREATE TABLE t (k BIGINT, v VARCHAR, {PARTITION} BIGINT, {RUN} BIGINT, {TOLD} BIGINT)")
    connection.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", ROWS)
    assert Counter(connection.execute(kept_sql("t", ["k", "v"])).fetchall()) == KEPT


def test_a_partition_without_a_whole_run_is_an_error(spark):
    staged = spark.createDataFrame([*ROWS, (5, "e", 4, 17, None)], STAGED)
    with pytest.raises(Exception, match="no whole run of partition 4"):
        kept_rows(staged).collect()


@pytest.mark.parametrize("partitions", [1, 5, 300])
def test_stage_and_keep(spark, tmp_path, partitions):
    """More partitions than rows, many batches in one, and columns with odd names."""
    n = 90 if partitions == 300 else 50_000
    table = spark.range(n).selectExpr("id % 7 AS `a.b`", "IF(id % 3 = 0, NULL, cast(id AS string)) AS v").repartition(partitions)
    for _ in range(2):
        stage_rows(table).write.mode("append").parquet(str(tmp_path / "t"))
    staged = spark.read.parquet(str(tmp_path / "t"))
    assert staged.count() == 2 * n
    assert staged.where(F.col(TOLD).isNotNull()).agg(F.sum(TOLD)).first()[0] == 2 * n
    kept = kept_rows(staged)
    assert kept.columns == table.columns
    assert rows(kept) == rows(table)


def test_an_empty_table(spark):
    staged = stage_rows(spark.range(0))
    assert staged.count() == 0 and kept_rows(staged).collect() == []


def test_clashing_names_are_refused(spark):
    with pytest.raises(ValueError, match="stage_run"):
        stage_rows(spark.createDataFrame([(1,)], "Stage_Run int"))


def test_a_staged_saver_reads_doubled_rows_once(spark, tmp_path, monkeypatch):
    written = []

    def write(df, url, table, column_types, properties):
        written.append(column_types)
        for _ in range(2):
            df.write.mode("append").parquet(str(tmp_path / "db"))
        return "t"

    monkeypatch.setattr(jobs, "write_jdbc", write)
    monkeypatch.setattr(jobs, "read_jdbc_hashed", lambda *a: spark.read.parquet(str(tmp_path / "db")))
    table = spark.range(1000).selectExpr("id AS k", "cast(id AS string) AS v").repartition(4)
    saved = jobs.jdbc_saver("jdbc:x", "k", column_types={"v": "VARCHAR(9)"}, staged=True)(table)
    assert rows(saved(None)) == rows(table)
    assert saved(["v"]).columns == ["v"]
    assert written == [{"k": "bigint", "v": "VARCHAR(9)"}]
    with pytest.raises(ValueError, match="repartition"):
        jobs.jdbc_saver("jdbc:x", "k", properties={"numPartitions": "2"}, staged=True)


def held(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_a_scope_leaves_nothing_but_results(spark):
    before = held(spark)
    with scratch_scope(spark):
        inner = write_scratch(spark.range(5), "scoped")
        result = write_result(spark, "inner-result", lambda: write_scratch(inner, "scoped-twice"))
        assert result.count() == 5
        assert not [n for n in held(spark) - before if n.startswith("scoped-twice")]
    assert held(spark) == before
    result = write_result(spark, "outer-result", lambda: write_scratch(spark.range(3), "scoped").selectExpr("id + 1 AS n"))
    assert sorted(r.n for r in result.collect()) == [1, 2, 3]
    assert [n.startswith("outer-result") for n in held(spark) - before] == [True]


def test_a_scope_is_cleared_after_a_failure(spark):
    before = held(spark)

    def fails():
        return write_scratch(spark.range(5), "scoped").selectExpr("raise_error('broken') AS x")

    with pytest.raises(Exception, match="broken"):
        write_result(spark, "failed", fails)
    with pytest.raises(KeyError):
        with scratch_scope(spark):
            write_scratch(spark.range(5), "scoped")
            raise KeyError
    assert held(spark) == before
    write_scratch(spark.range(1), "kept-outside")  # without a scope, left to the folder's keeper
    assert len(held(spark) - before) == 1
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
