import pytest
from pyspark.sql import functions as F

from keytables.operators import KeyContractError, sort_table, write_sorted
from keytables.plans import jobs
from keytables.sources import read_arrow


def by_partition(df):
    marked = df.select("*", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("n"))
    return marked.collect()


def test_nulls_come_first_and_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert [r.a for r in sort_table(df, ["a"]).collect()] == [None, 1, 2]
    assert [r.a for r in sort_table(df, "a", ascending=False).collect()] == [2, 1, None]
    with pytest.raises(ValueError, match="at least one"):
        sort_table(df, [])


@pytest.mark.parametrize("num_partitions", [None, 5])
def test_whole_table_in_order(spark, num_partitions):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = sort_table(orders, ["o_custkey", "o_orderkey"], num_partitions=num_partitions)
    assert got.columns == orders.columns
    keys = [(r.o_custkey, r.o_orderkey) for r in got.collect()]
    assert keys == sorted(keys) and len(keys) == orders.count()


@pytest.mark.parametrize("num_partitions", [None, 8])
def test_a_hot_value_is_spread_over_tasks(spark, num_partitions):
    # A third of all rows, all alike, from eight tasks.
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = by_partition(sort_table(df, "k", num_partitions=num_partitions))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.k for r in sorted(got, key=lambda r: r.n)] == sorted(r.k for r in got)
    sizes = {}
    for row in got:
        sizes[row.p] = sizes.get(row.p, 0) + 1
    assert len(got) == 60_000 and max(sizes.values()) < 15_000


def test_written_files_hold_ascending_ranges(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    path = str(tmp_path / "sorted")
    saved = write_sorted(orders, "o_orderkey", jobs.arrow_saver(path), num_partitions=4)
    assert saved(None).count() == orders.count()
    files = sorted((tmp_path / "sorted").glob("part-*.arrow"))
    assert len(files) == 4
    last = -1
    for file in files:
        keys = [r.o_orderkey for r in read_arrow(spark, str(file)).collect()]
        assert keys == sorted(keys) and keys[0] > last
        last = keys[-1]


def test_nothing_is_written_when_the_key_is_broken(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    with pytest.raises(KeyContractError):
        write_sorted(df, "a", lambda _: pytest.fail("written"))
    assert write_sorted(df, "a", lambda d: d.count(), check=False) == 2


def evaluations(spark, rows, build):
    """How often ``build`` reads each of the table's ``rows``."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    build(spark.range(0, rows, 1, 4).selectExpr("(id * 7919) % 100003 AS k").mapInPandas(count, "k long"))
    return seen.value / rows


def test_the_rule_is_checked_while_writing(spark, tmp_path):
    def written(name, whole):
        save = jobs.arrow_saver(str(tmp_path / name))
        save.publishes_whole = whole
        return evaluations(spark, 20_000, lambda df: write_sorted(df, "k", save, num_partitions=4))

    assert written("before", False) - written("streamed", True) == 1
    a, b = (read_arrow(spark, str(tmp_path / n)).collect() for n in ("before", "streamed"))
    assert a == b


def test_no_shuffle_is_added_by_the_check(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    plan.publishes_whole = True
    for n in (None, 4):
        text = write_sorted(orders, "o_orderkey", plan, num_partitions=n)
        assert text.count("Exchange") == 1 and "rangepartitioning" in text and text.count("Sort [") == 1


@pytest.mark.parametrize("num_partitions", [None, 1, 6])
@pytest.mark.parametrize("broken", ["repeat", "null"])
def test_nothing_is_published_when_one_key_is_broken(spark, tmp_path, num_partitions, broken):
    path = str(tmp_path / "kept")
    whole = spark.range(0, 3000, 1, 6).selectExpr("id AS k", "'v' AS v")
    save = jobs.arrow_saver(path)
    write_sorted(whole, "k", save, num_partitions)
    for key in ("500", "1000", "2999") if broken == "repeat" else ("CAST(NULL AS LONG)",):
        bad = whole.union(spark.range(1).selectExpr(f"{key} AS k", "'again' AS v"))
        found = "0 null and 1 repeated" if broken == "repeat" else "1 null and 0 repeated"
        with pytest.raises(KeyContractError, match=found):
            write_sorted(bad, "k", save, num_partitions)
    assert read_arrow(spark, path).collect() == whole.collect()


@pytest.mark.parametrize("kind", ["double", "string", "binary", "date", "decimal(12,2)", "timestamp"])
def test_every_kind_of_key(spark, tmp_path, kind):
    key = "DATE '2000-01-01' + CAST(id AS INT)" if kind in ("date", "timestamp") else "CAST(id AS STRING)"
    df = spark.range(0, 500, 1, 3).selectExpr(f"CAST({key} AS {kind}) AS `a.k`")
    save = jobs.arrow_saver(str(tmp_path / "t"))
    got = write_sorted(df, "a.k", save, num_partitions=3)(None).collect()
    assert got == df.sort("`a.k`").collect()
    with pytest.raises(KeyContractError):
        write_sorted(df.union(df.limit(1)), "a.k", save, num_partitions=3)
