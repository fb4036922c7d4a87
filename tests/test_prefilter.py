from collections import Counter

import pytest
from pyspark.sql import functions as F

from keytables.operators import join_tables, key_filter, may_match
from keytables.operators.joins import JOIN_TYPES

SMALL = "/root/testdata/sf0.01"


def rows(df):
    return Counter(map(str, df.collect()))


def dearest_orders(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    return orders.where("o_totalprice >= 495000").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")


def test_few_rows_pass_and_none_is_missing(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    keys = dearest_orders(spark)
    passed = may_match(lines, keys, "l_orderkey")
    wanted = lines.join(keys, "l_orderkey", "left_semi")
    assert 0 < wanted.count() < 0.03 * lines.count()
    assert passed.count() < 0.05 * lines.count()
    assert wanted.exceptAll(passed).isEmpty()


def test_only_what_passed_is_shuffled(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    got = join_tables(lines, dearest_orders(spark), "l_orderkey", strategy="shuffle", prefilter_bytes=1 << 20)
    got.collect()
    written = []

    def visit(node):
        if "ShuffleExchange" in node.getClass().getSimpleName():
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(got._jdf.queryExecution().executedPlan())
    assert written and max(written) < 0.05 * lines.count()


@pytest.mark.parametrize("how", JOIN_TYPES)
@pytest.mark.parametrize("strategy,partitions,size", [("auto", None, 112), ("shuffle", None, 1 << 16), ("shuffle", 3, 112)])
def test_false_positives_do_not_reach_a_join(spark, how, strategy, partitions, size):
    left = spark.range(3000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    left = left.union(spark.range(3).selectExpr("CAST(NULL AS LONG)", "id"))
    right = spark.range(40).selectExpr("CAST(id * 30 AS INT) AS k", "id AS w").union(
        spark.range(2).selectExpr("CAST(NULL AS INT)", "id")
    )
    want = left.join(right, "k", how)
    got = join_tables(left, right, "k", how, strategy, num_partitions=partitions, prefilter_bytes=size)
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want)


@pytest.mark.parametrize("multiplicity,how", [("semi", "left_semi"), ("inner", "inner")])
def test_key_lists(spark, multiplicity, how):
    df = spark.range(5000).selectExpr("id % 1000 AS k", "id AS v")
    keys = spark.range(60).selectExpr("id % 20 * 50 AS k")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = key_filter(df, {"k": keys}, multiplicity, prefilter_bytes=1 << 16)
        assert "left_semi" in got._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftsemi", "left_semi")
        assert rows(got) == rows(df.join(keys, "k", how))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize(
    "key",
    [
        "CASE id % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN -0.0D WHEN 2 THEN 0.0D ELSE double(id) END",
        "CASE id % 3 WHEN 0 THEN float('NaN') WHEN 1 THEN -0.0F ELSE float(id) END",
        "array(CASE id % 3 WHEN 0 THEN double('NaN') WHEN 1 THEN -0.0D ELSE 0.0D END)",
        "struct(id % 5 AS a, CASE id % 2 WHEN 0 THEN -0.0D ELSE 0.0D END AS b)",
        "CAST(id % 7 AS STRING)",
        "CAST(CAST(id % 7 AS STRING) AS BINARY)",
        "CAST(id % 7 AS DECIMAL(10, 2))",
        "DATE '2000-01-01' + CAST(id % 7 AS INT)",
    ],
)
def test_keys_are_equal_as_the_join_finds_them(spark, key):
    left = spark.range(40).selectExpr(f"{key} AS k", "id AS v")
    right = spark.range(0, 40, 3).selectExpr(f"{key} AS k", "id AS w")
    got = join_tables(left, right, "k", strategy="shuffle", prefilter_bytes=1 << 16)
    want = left.join(right, "k")
    # Either zero may stand for both in a joined row's key.
    assert rows(got.drop("k")) == rows(want.drop("k"))


def test_several_keys_of_unlike_types(spark):
    left = spark.range(100).selectExpr("id % 10 AS a", "CAST(id % 3 AS STRING) AS b", "id AS v")
    right = spark.range(5).selectExpr("CAST(id AS SMALLINT) AS a", "CAST(id % 2 AS STRING) AS b")
    assert rows(join_tables(left, right, ["a", "b"], strategy="shuffle", prefilter_bytes=4096)) == rows(
        left.join(right, ["a", "b"])
    )
    # Compared as another type than either side's own: nothing is left out beforehand.
    other = right.selectExpr("CAST(a AS DOUBLE) AS a", "b")
    assert may_match(left, other, ["a", "b"]).count() == left.count()
    assert rows(join_tables(left, other, ["a", "b"], strategy="shuffle", prefilter_bytes=4096)) == rows(
        left.join(other, ["a", "b"])
    )


def test_empty_tables_and_refused_arguments(spark):
    df = spark.range(10).toDF("k")
    assert may_match(df, df.where("false"), "k").isEmpty()
    assert may_match(df.where("false"), df, "k").isEmpty()
    for wrong in ({"on": []}, {"max_bytes": 100}):
        with pytest.raises(ValueError):
            may_match(df, df, **{"on": "k", **wrong})
