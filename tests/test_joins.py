from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keytables.operators import fits_broadcast, join_tables, key_filter, psi_join
from keytables.operators.joins import JOIN_TYPES, STRATEGIES
from keytables.sources import read_arrow, write_arrow

LAYOUTS = [(s, None) for s in STRATEGIES] + [("shuffle", 3)]


@pytest.fixture(scope="module")
def left(spark):
    rows = [(1, 1, "x"), (None, 1, "n"), (2, 1, "y"), (2, 1, "y"), (5, None, "q"), (2, 2, "z")]
    return spark.createDataFrame(rows, "k int, m int, v string")


@pytest.fixture(scope="module")
def right(spark):
    rows = [(2, 1, "p"), (2, 1, "p2"), (3, 1, "q"), (None, 1, "m"), (None, None, "mm"), (1, 2, "r")]
    return spark.createDataFrame(rows, "k long, m int, w string")


def rows(df):
    return Counter(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", JOIN_TYPES)
@pytest.mark.parametrize("strategy,partitions", LAYOUTS)
@pytest.mark.parametrize("on", ["k", ["k", "m"]])
def test_every_form_equals_the_plain_join(left, right, how, strategy, partitions, on):
    other = right.drop("m") if on == "k" else right
    want = left.join(other, on, how)
    got = join_tables(left, other, on, how, strategy, num_partitions=partitions)
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want)


@pytest.mark.parametrize("how", JOIN_TYPES)
@pytest.mark.parametrize("strategy,partitions", LAYOUTS)
def test_beyond_the_limits_the_rows_are_the_same(left, right, how, strategy, partitions):
    other = right.drop("m")
    got = join_tables(
        left, other, "k", how, strategy, num_partitions=partitions, broadcast_max_rows=2
    )
    assert rows(got) == rows(left.join(other, "k", how))


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_empty_sides(left, right, how):
    other = right.drop("m")
    for a, b in ((left.where("false"), other), (left, other.where("false"))):
        for strategy, partitions in LAYOUTS:
            got = join_tables(a, b, "k", how, strategy, num_partitions=partitions)
            assert rows(got) == rows(a.join(b, "k", how))


def test_both_keys_count(spark):
    a = spark.createDataFrame([(1, 1, "x")], "k1 int, k2 int, v string")
    b = spark.createDataFrame([(1, 2, "p")], "k1 int, k2 int, w string")
    assert psi_join(a, b, ["k1", "k2"]).count() == 0
    assert psi_join(a, b.drop("k2"), "k1").count() == 1


def test_same_named_columns_need_a_suffix(left, right):
    with pytest.raises(ValueError, match="both tables hold m"):
        join_tables(left, right, "k")
    got = join_tables(left, right, "k", suffix="_r")
    assert got.columns == ["k", "m", "v", "m_r", "w"]
    with pytest.raises(ValueError, match="both tables hold m_r"):
        join_tables(left.withColumnRenamed("v", "m_r"), right, "k", suffix="_r")


@pytest.mark.parametrize("how", JOIN_TYPES)
@pytest.mark.parametrize("strategy,partitions", LAYOUTS)
def test_odd_names_and_tables_of_one_origin(left, how, strategy, partitions):
    a = left.select(F.col("k").alias("the.key"), "v")
    b = left.where("k <> 5").select(F.col("k").alias("THE.KEY"), F.col("v").alias("w`1"))
    got = join_tables(a, b, "The.Key", how, strategy, num_partitions=partitions)
    assert got.columns == ["the.key", "v", "w`1"]
    plain = left.select("k", "v").join(
        left.where("k <> 5").select("k", F.col("v").alias("w")), "k", how
    )
    assert rows(got) == rows(plain)


def test_names_that_differ_in_case_clash(left, right):
    with pytest.raises(ValueError, match="both tables hold M"):
        join_tables(left, right.withColumnRenamed("m", "M"), "K")


def test_refused_arguments(left, right):
    for wrong in (
        dict(how="cross"),
        dict(strategy="nested"),
        dict(on="absent"),
        dict(on=[]),
    ):
        with pytest.raises(ValueError):
            join_tables(left, right, **{"on": "k", "suffix": "_r", **wrong})


def test_no_rows_allowed_means_nothing_is_measured(spark):
    broken = spark.range(1).select(F.raise_error(F.lit("computed")).cast("long").alias("k"))
    assert not fits_broadcast(broken, max_rows=0)
    join_tables(spark.range(3).toDF("k"), broken, "k", broadcast_max_rows=0)


def test_size_limits(spark):
    df = spark.createDataFrame([("a" * 100,)] * 10, "s string")
    assert fits_broadcast(df, max_rows=11, max_bytes=1000)
    assert not fits_broadcast(df, max_rows=10, max_bytes=1000)
    assert not fits_broadcast(df, max_rows=11, max_bytes=999)
    numbers = spark.range(10)
    assert fits_broadcast(numbers, max_rows=11, max_bytes=11 * 16)
    assert not fits_broadcast(numbers, max_rows=10, max_bytes=11 * 16)
    assert not fits_broadcast(numbers, max_rows=11, max_bytes=9)


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_broadcast_never_shuffles_the_left_rows(spark, how):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    nations = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    text = plan(join_tables(orders, nations, "o_custkey", how, "broadcast"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # Only the matched keys of a right or outer join are shuffled, reduced to the right side's number.
    assert len(shuffled) == (0 if how in ("inner", "left") else 1)


def test_beyond_the_limits_nothing_is_broadcast(left, right):
    text = plan(
        join_tables(left, right.drop("m"), "k", "outer", "broadcast", broadcast_max_rows=1)
    )
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_psi_order_is_nulls_first_ascending(left, right):
    got = psi_join(left, right.drop("m"), "k", "outer", order_by="v")
    values = [r.v for r in got.collect()]
    assert values == sorted(values, key=lambda v: (v is not None, v))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key; they come from many tasks."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    return spark.range(0, 300_000, 1, 24).select(
        key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )


@pytest.fixture(scope="module")
def even(spark):
    return spark.range(0, 100_000, 1, 4).select(
        F.col("id").alias("k"), F.sha2((F.col("id") + 1).cast("string"), 256).alias("w")
    )


@pytest.fixture
def small_splits(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("hot_side", ["left", "right"])
@pytest.mark.parametrize("how", JOIN_TYPES)
def test_a_hot_key_is_split_at_run_time(hot, even, small_splits, how, hot_side):
    sides = (hot, even) if hot_side == "left" else (even, hot)
    got = join_tables(*sides, "k", how, "shuffle")
    digest = F.sum(F.xxhash64(*got.columns).cast("decimal(38,0)"))
    summary = got.agg(F.count(F.lit(1)), digest)
    want = sides[0].join(sides[1], "k", how).agg(F.count(F.lit(1)), digest)
    assert summary.collect() == want.collect()
    assert "skew=true" in plan(summary).split("Initial Plan")[0]


def test_a_hot_key_is_salted_in_a_pinned_layout(hot, even):
    got = join_tables(hot, even, "k", "inner", "shuffle", num_partitions=16)
    sizes = {
        r.p: r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    }
    total = hot.join(even, "k").count()
    assert sum(sizes.values()) == total
    # The hot key alone holds more than half of the result.
    assert max(sizes.values()) < total / 3


@settings(deadline=None, max_examples=4)
@given(st.lists(st.none() | st.integers(0, 3), max_size=60), st.lists(st.integers(0, 4), max_size=60))
@pytest.mark.parametrize("how", JOIN_TYPES)
def test_salted_joins_of_two_hot_sides(spark, how, lefts, rights):
    a = spark.createDataFrame(list(enumerate(lefts)), "v int, k int")
    b = spark.createDataFrame(list(enumerate(rights)), "w int, k int")
    got = join_tables(a, b, "k", how, "shuffle", num_partitions=4)
    assert rows(got) == rows(a.join(b, "k", how))


def test_unmatched_rows_reuse_the_shuffled_side(hot, even, small_splits):
    got = join_tables(hot, even, "k", "outer", "shuffle")
    summary = got.agg(F.max(F.xxhash64(*got.columns)))
    summary.collect()
    assert plan(summary).split("Initial Plan")[0].count("ReusedExchange") == 2


def test_a_hot_key_of_a_filtered_table_is_split(hot, even, small_splits):
    got = key_filter(hot, {"k": even}, broadcast_max_rows=1)
    summary = got.agg(F.count(F.lit(1)), F.max(F.xxhash64(*got.columns)))
    assert summary.collect()[0][0] == hot.join(even, "k", "left_semi").count()
    assert "skew=true" in plan(summary).split("Initial Plan")[0]


def jobs_started(spark, name, build):
    """The jobs that ``build`` starts before its result is used."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_no_job_runs_while_a_join_is_built(spark, hot, even, tmp_path, how):
    write_arrow(even, str(tmp_path / "even"))
    listed = read_arrow(spark, str(tmp_path / "even"))
    for n, (right, limits) in enumerate(
        [(even, {}), (listed, {"broadcast_max_bytes": 1000}), (listed, {"broadcast_max_rows": 0})]
    ):
        started = jobs_started(spark, f"join-{how}-{n}", lambda: join_tables(hot, right, "k", how, **limits))
        assert started == 0
    assert jobs_started(spark, f"filter-{how}", lambda: key_filter(hot, {"k": even})) == 0
    # The counter does count.
    assert jobs_started(spark, f"count-{how}", lambda: join_tables(hot, listed.limit(5), "k", how).count()) > 0


@pytest.mark.parametrize("name", ["psi_join_auto", "psi_join_two_keys", "psi_join_left", "join_multi_key", "join_right"])
def test_queries_start_no_job_beyond_reading_schemas(spark, name):
    from keytables.plans.catalog import CATALOG

    tables = ("customer", "orders", "lineitem")
    folder = "/root/testdata/sf0.001"
    schemas = jobs_started(spark, f"schemas-{name}", lambda: [spark.read.parquet(f"{folder}/{t}.parquet") for t in tables])
    assert jobs_started(spark, name, lambda: CATALOG[name].run(spark, folder)) <= schemas


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_small_arrow_files_are_broadcast(spark, hot, tmp_path, how):
    write_arrow(spark.range(100).toDF("k"), str(tmp_path / "k"))
    keys = read_arrow(spark, str(tmp_path / "k"))
    text = plan(join_tables(hot, keys, "k", how))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "BroadcastHashJoin" in plan(key_filter(hot, {"k": keys}))


def test_a_tiny_right_side_is_left_to_spark(spark, hot):
    tiny = spark.range(10).toDF("k").withColumn("w", F.lit(1))
    text = plan(join_tables(hot, tiny, "k", "left", broadcast_max_rows=0))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text


@pytest.mark.parametrize("layout", ["spread", "by key", "clustered"])
def test_a_hot_key_is_spread_evenly_whatever_the_input(spark, hot, even, layout):
    given_ = {"spread": hot, "by key": hot.repartition(12, "k"), "clustered": hot.repartitionByRange(12, "k")}[layout]
    got = join_tables(given_, even, "k", "inner", "shuffle", num_partitions=16)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == hot.join(even, "k").count()
    assert max(sizes) < 2 * sum(sizes) / 16
    again = join_tables(given_, even, "k", "inner", "shuffle", num_partitions=16)
    assert sorted(sizes) == sorted(r["count"] for r in again.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_no_salt_without_a_hot_key(spark, even):
    other = even.withColumnRenamed("w", "v")
    text = plan(join_tables(other, even, "k", "inner", "shuffle", num_partitions=4))
    assert "Generate" not in text and "salt" not in text


KEYS = {
    "double": ("double", [float("nan"), -0.0, 0.0, 1.5, 2.5]),
    "float array": ("array<double>", [[float("nan")], [-0.0], [0.0], [], [1.0, None]]),
    "struct": ("struct<a:double,b:string>", [(float("nan"), "x"), (-0.0, "x"), (0.0, "x"), (None, None), (1.0, None)]),
    "binary": ("binary", [bytearray(b""), bytearray(b"\x00"), bytearray(b"\xff"), bytearray(b"a"), bytearray(b"b")]),
}


@pytest.mark.parametrize("how", JOIN_TYPES)
@pytest.mark.parametrize("kind", [*KEYS, "two columns"])
def test_hot_keys_of_any_type_on_both_sides(spark, kind, how):
    """The first key is hot on both sides, the second on the left, the third on the right."""
    at_left = [0] * 30 + [1] * 25 + [2] * 3 + [3, 4, None]
    at_right = [0] * 20 + [2] * 30 + [1] * 2 + [4, 4, None]

    def table(places, value):
        if kind == "two columns":
            doubles = KEYS["double"][1]
            rows = [(None if i is None else doubles[i], None if i is None else f"k{i}", n) for n, i in enumerate(places)]
            return spark.createDataFrame(rows, f"k double, m string, {value} int"), ["k", "m"]
        type_, values = KEYS[kind]
        return spark.createDataFrame([(None if i is None else values[i], n) for n, i in enumerate(places)], f"k {type_}, {value} int"), ["k"]

    (a, on), (b, _) = table(at_left, "v"), table(at_right, "w")
    got = join_tables(a, b, on, how, "shuffle", num_partitions=4)
    want = a.join(b, on, how)
    assert got.dtypes == want.dtypes
    pairs = lambda df: Counter((r.v, r.w) for r in df.select("v", "w").collect())
    assert pairs(got) == pairs(want)
    if how == "inner":
        assert "Generate" in plan(got)


def test_a_pinned_join_finds_hot_keys_of_both_sides_at_once(spark, hot, even):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else each stage counts as a job
    try:
        started = jobs_started(spark, "pinned", lambda: join_tables(hot, even, "k", "inner", "shuffle", num_partitions=16))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert started < 4


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_the_lighter_side_is_broadcast(spark, tmp_path, how):
    write_arrow(spark.range(50_000).selectExpr("id % 1000 AS k", "repeat('x', 40) AS v"), str(tmp_path / "heavy"))
    write_arrow(spark.range(0, 2000, 5).selectExpr("id AS k", "id AS w"), str(tmp_path / "light"))
    heavy, light = (read_arrow(spark, str(tmp_path / name)) for name in ("heavy", "light"))
    for a, b in ((heavy, light), (light, heavy)):
        joined = join_tables(a, b, "k", how)
        assert rows(joined.select("k", "w", "v")) == rows(a.join(b, "k", how).select("k", "w", "v"))
        text = plan(joined)
        if a is heavy or how in ("inner", "right"):
            assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        else:  # Spark cannot build the left side of these, and the right one is not worth it
            assert "BroadcastExchange" not in text
    started = jobs_started(spark, f"lighter-{how}", lambda: join_tables(light, heavy, "k", how))
    assert started == (0 if how in ("left", "outer") else jobs_started(spark, f"size-{how}", lambda: fits_broadcast(light)))
    equal = join_tables(heavy, read_arrow(spark, str(tmp_path / "heavy")), "k", how, suffix="_right")
    assert "BroadcastExchange" not in plan(equal)


def sketched(a, b, on):
    got = join_tables(a, b, on, "outer", "skew")
    return got, "salt" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", [*KEYS, "two columns"])
def test_a_full_join_by_sketch_for_keys_of_any_type(spark, kind):
    at_left, at_right = [0] * 40 + [1] * 25 + [2] * 3 + [3, 4, None], [0] * 20 + [2] * 30 + [1] * 2 + [4, 4, None]
    if kind == "two columns":
        doubles = KEYS["double"][1]
        make = lambda places, v: spark.createDataFrame(
            [(None if i is None else doubles[i], None if i == 1 else f"k{i}", n) for n, i in enumerate(places)], f"k double, m string, {v} int"
        )
        on = ["k", "m"]
    else:
        type_, values = KEYS[kind]
        make = lambda places, v: spark.createDataFrame(
            [(None if i is None else values[i], n) for n, i in enumerate(places)], f"k {type_}, {v} int"
        )
        on = ["k"]
    a, b = make(at_left, "v"), make(at_right, "w")
    got, salted = sketched(a, b, on)
    want = a.join(b, on, "outer")
    assert salted and got.dtypes == want.dtypes
    assert rows(got.select("v", "w")) == rows(want.select("v", "w"))
    assert rows(got.selectExpr("to_json(struct(*))")) == rows(want.selectExpr("to_json(struct(*))"))


@settings(deadline=None, max_examples=8)
@given(st.lists(st.none() | st.integers(0, 3), max_size=60), st.lists(st.none() | st.integers(0, 4), max_size=60))
def test_full_joins_by_sketch_of_two_hot_sides(spark, lefts, rights):
    a = spark.createDataFrame(list(enumerate(lefts)), "v int, k int")
    b = spark.createDataFrame(list(enumerate(rights)), "w int, k long")
    got = join_tables(a, b, "k", "outer", "skew")
    want = a.join(b, "k", "outer")
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want)


@pytest.mark.parametrize("hot_value", ["7", "NULL", "-1"])
def test_a_third_of_rows_on_one_key_of_a_full_join_is_dealt_out(spark, hot_value):
    """A key that both sides have, that no row has, and that the left side alone has."""
    a = spark.range(60_000).selectExpr(f"IF(id % 3 = 0, {hot_value}, id) AS k", "id AS v")
    b = spark.range(0, 90_000, 2).selectExpr("id + 7 AS k", "id AS w")
    got, salted = sketched(a, b, "k")
    assert salted
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the layout itself, before small tasks are merged
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    want = a.join(b, "k", "outer")
    assert sum(sizes) == want.count()
    assert max(sizes) < 2 * sum(sizes) / int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(got.agg(F.sum("k"), F.sum("v"), F.sum("w"), F.sum(F.hash("k", "v", "w")))) == rows(
        want.agg(F.sum("k"), F.sum("v"), F.sum("w"), F.sum(F.hash("k", "v", "w")))
    )


def test_a_full_join_by_sketch_stays_plain_without_a_hot_key(spark, even):
    other = even.withColumnRenamed("w", "v")
    got, salted = sketched(other, even, "k")
    assert not salted and rows(got) == rows(other.join(even, "k", "outer"))
