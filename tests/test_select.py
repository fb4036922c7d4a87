import hashlib

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from keytables.functions import HASH_COLUMN, hash_key
from keytables.operators import add_hash_column, key_filter, project, where


@pytest.fixture(scope="module")
def dup_keys(spark):
    return spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "x"), (2, "y"), (2, "z"), (3, "w"), (None, "n")]
    return spark.createDataFrame(rows, "k int, v string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_semi_keeps_a_row_once(table, dup_keys):
    got = key_filter(table, {"k": dup_keys})
    assert sorted(got.collect()) == [(1, "x"), (2, "y"), (2, "z")]


def test_inner_repeats_a_row_per_repeated_key(table, dup_keys):
    got = key_filter(table, {"k": dup_keys}, multiplicity="inner")
    assert sorted(got.collect()) == [(1, "x"), (1, "x"), (2, "y"), (2, "z")]


def test_key_comes_first_and_other_columns_of_the_list_are_dropped(spark, table):
    swapped = table.select("v", "k")
    keys = spark.createDataFrame([(1, "other")], "k int, note string")
    assert key_filter(swapped, {"k": keys}).columns == ["k", "v"]
    assert key_filter(swapped, [("k", keys)], "inner").columns == ["k", "v"]


def test_filters_in_turn_are_anded(spark, table):
    ks = spark.createDataFrame([(2,), (3,)], "k int")
    vs = spark.createDataFrame([("y",), ("x",)], "v string")
    assert key_filter(table, {"k": ks, "v": vs}).select("k", "v").collect() == [(2, "y")]


def test_a_small_key_list_is_broadcast(table, dup_keys):
    text = plan(key_filter(table, {"k": dup_keys}))
    assert "LeftSemi" in text and "BroadcastHashJoin" in text and "hashpartitioning" not in text


@pytest.mark.parametrize("multiplicity", ["semi", "inner"])
def test_a_large_key_list_is_not(spark, table, dup_keys, multiplicity):
    want = sorted(key_filter(table, {"k": dup_keys}, multiplicity).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = key_filter(table, {"k": dup_keys}, multiplicity, broadcast_max_rows=2)
        assert sorted(got.collect()) == want
        text = plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Broadcast" not in text and "SortMergeJoin" in text
    # Repeated keys are gone before the shuffle.
    assert ("HashAggregate" in text) == (multiplicity == "semi")


def test_no_more_rows_than_before(spark, table, dup_keys):
    assert key_filter(table, {"k": dup_keys.union(dup_keys)}).count() <= table.count()


def test_wrong_multiplicity(table, dup_keys):
    with pytest.raises(ValueError, match="multiplicity"):
        key_filter(table, {"k": dup_keys}, "outer")


def test_empty_key_list_and_empty_table(table, dup_keys):
    assert key_filter(table, {"k": dup_keys.where("false")}).count() == 0
    assert key_filter(table.where("false"), {"k": dup_keys}).count() == 0
    assert key_filter(table, {}).count() == table.count()


def test_project_defaults_to_every_column(table):
    assert project(table).columns == ["k", "v"]
    assert project(table, ["v"]).columns == ["v"]


def test_project_expressions_may_hold_commas(table):
    got = project(table, exprs=["concat_ws('-', k, v) AS tag"]).where("tag = '1-x'")
    assert got.count() == 1


def test_project_window_expression(table):
    exprs = ["k", "v", "row_number() OVER (PARTITION BY k ORDER BY v DESC) AS rn"]
    got = project(table, exprs=exprs).where("k = 2").collect()
    assert sorted(got) == [(2, "y", 2), (2, "z", 1)]


def test_pasted_clauses_are_refused(table):
    with pytest.raises(ParseException):
        project(table, exprs=["k FROM filtered_table WHERE k = 1"])
    with pytest.raises(AnalysisException):
        project(table, exprs=["DISTINCT k"])
    with pytest.raises(ValueError, match="not both"):
        project(table, ["k"], ["k"])


def test_distinct_flag(dup_keys):
    assert project(dup_keys, ["k"], distinct=True).count() == 3


def test_where_takes_text_column_or_list(table):
    assert where(table, "k = 2").count() == 2
    assert where(table, F.col("k") == 2).count() == 2
    assert where(table, ["k = 2", F.col("v") == "y"]).count() == 1
    assert where(table).count() == where(table, []).count() == 5


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def test_hash_key_values(spark):
    df = spark.createDataFrame([(7, "ä")], "a int, b string")
    assert add_hash_column(df, ["a", "b"]).first()[HASH_COLUMN] == sha("7|ä")


def test_nulls_vanish_unless_strict(spark):
    rows = [("a", None, "b"), ("a", "b", None), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    plain = [r[0] for r in df.select(hash_key("a", "b", "c")).collect()]
    assert plain == [sha("a|b"), sha("a|b"), sha("")]
    strict = [r[0] for r in df.select(hash_key("a", "b", "c", strict=True)).collect()]
    assert strict == [sha("1:a|-|1:b"), sha("1:a|1:b|-"), sha("-|-|-")]


def test_bars_are_ambiguous_unless_strict(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "a string, b string")
    assert df.select(hash_key("a", "b")).distinct().count() == 1
    assert df.select(hash_key("a", "b", strict=True)).distinct().count() == 2


def test_hash_key_types_matter(spark):
    df = spark.sql("SELECT CAST(1.50 AS DECIMAL(5, 2)) AS d, CAST(1.5 AS DOUBLE) AS x")
    assert df.select(hash_key("d"), hash_key("x")).first() == (sha("1.50"), sha("1.5"))


def test_hash_key_needs_a_column():
    with pytest.raises(ValueError, match="at least one"):
        hash_key()


def test_hash_stays_in_the_jvm(table):
    text = plan(add_hash_column(table, ["k", "v"]))
    assert "Python" not in text and "sha2" in text
