"""Columns with dots and backticks in their names, in every operator that takes names."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keytables.functions import HASH_COLUMN, hash_key
from keytables.operators import (
    add_hash_column,
    check_key,
    estimate_size,
    group_count,
    key_contract,
    key_filter,
    key_violations,
    sort_table,
    write_sorted,
)
from keytables.sources import export_key_column


@pytest.fixture(scope="module", params=["a.b", "a`b", "a b.`c"])
def odd(spark, request):
    return request.param, spark.createDataFrame([(2, "x"), (1, "y"), (2, "z")], "k int, v string").toDF(request.param, "v")


def test_sort_and_write(odd):
    name, df = odd
    assert [r[0] for r in sort_table(df, name).collect()] == [1, 2, 2]
    assert [r[0] for r in sort_table(df, [name], ascending=False, num_partitions=2).collect()] == [2, 2, 1]
    assert write_sorted(df.dropDuplicates(["v"]), "v", lambda d: d.columns) == [name, "v"]


def test_contract(odd):
    name, df = odd
    assert tuple(key_contract(df, name).first()) == (3, 0, 2)
    assert [tuple(r) for r in key_violations(df, [name]).collect()] == [(2, 2)]
    check_key(df.where("v <> 'z'"), name)


def test_group_size_and_hash(odd):
    name, df = odd
    assert sorted(map(tuple, group_count(df, [name]).collect())) == [(1, 1), (2, 2)]
    assert estimate_size(df).first()["n_rows"] == 3
    got = {r[HASH_COLUMN] for r in add_hash_column(df, [name, "v"]).collect()}
    assert got == {r[0] for r in df.toDF("k", "v").select(hash_key("k", "v")).collect()}


@pytest.mark.parametrize("multiplicity", ["semi", "inner"])
def test_filter(spark, odd, multiplicity):
    name, df = odd
    keys = spark.createDataFrame([(2,), (None,)], "k int").toDF(name)
    got = key_filter(df, {name: keys}, multiplicity)
    assert got.columns == [name, "v"] and sorted(r.v for r in got.collect()) == ["x", "z"]


def test_export(odd, tmp_path):
    name, df = odd
    export_key_column(df, name, str(tmp_path / "k"))
    assert sorted(x for f in Path(tmp_path / "k").glob("part-*") for x in f.read_text().split()) == ["1", "2", "2"]


def test_a_struct_field_is_still_found(spark):
    df = spark.range(3).select(F.struct(F.col("id").alias("b")).alias("a"))
    assert [r.a.b for r in sort_table(df, "a.b", ascending=False).collect()] == [2, 1, 0]
    assert group_count(df, ["a.b"]).count() == 3
