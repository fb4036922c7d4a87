import pytest

from keytables.operators import (
    KeyContractError,
    check_key,
    count_rows,
    estimate_size,
    group_count,
    key_contract,
    key_violations,
)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "x"), (1, "yé"), (2, None), (None, "n"), (None, "m")]
    return spark.createDataFrame(rows, "k int, v string")


def test_count_is_one_row_of_bigint(table):
    got = count_rows(table, ["k = 1"])
    assert got.dtypes == [("count", "bigint")] and got.collect() == [(2,)]
    assert count_rows(table.where("false")).collect() == [(0,)]


def test_null_is_a_group(table):
    got = group_count(table, ["k"])
    assert got.dtypes == [("k", "int"), ("count", "bigint")]
    assert set(got.collect()) == {(1, 2), (2, 1), (None, 2)}
    assert set(group_count(table, ["k"], "v IS NOT NULL").collect()) == {(1, 2), (None, 2)}
    assert group_count(table.where("false"), ["k"]).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        group_count(table, [])


def test_groups_are_counted_before_the_shuffle(spark, table):
    text = group_count(table.repartition(8), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") == 2
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")


def test_size_is_that_of_the_printed_rows(table, spark):
    rows = ["1|x", "1|yé", "2", "n", "m"]
    want = (sum(len(r.encode()) for r in rows), 5)
    assert estimate_size(table).collect() == [want]
    assert estimate_size(table.where("false")).collect() == [(0, 0)]
    odd = spark.createDataFrame([([1, 2], "p")], "a array<int>, `b.c` string")
    assert estimate_size(odd).first()["bytes"] == len("[1, 2]|p")


def test_key_contract(table):
    assert key_contract(table, "k").collect() == [(5, 2, 2)]
    assert key_contract(table, ["k", "v"]).collect() == [(5, 3, 2)]
    assert key_contract(table.where("false"), "k").collect() == [(0, 0, 0)]


def test_key_contract_reads_the_key_only(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = key_contract(lines, "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_violations_are_repeated_and_null_keys(table):
    assert set(key_violations(table, "k").collect()) == {(1, 2), (None, 2)}
    single = table.where("k = 2 OR v = 'n'")
    assert key_violations(single, "k").collect() == [(None, 1)]
    assert key_violations(table.where("k = 2"), "k").count() == 0


def test_check_key(table):
    check_key(table.where("k = 2"), "k")
    check_key(table.where("false"), "k")
    with pytest.raises(KeyContractError, match="2 null and 1 repeated of 5"):
        check_key(table, "k")
