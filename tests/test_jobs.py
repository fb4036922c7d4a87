from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keytables.functions import HASH_COLUMN
from keytables.operators import KeyContractError, add_hash_column
from keytables.plans import jobs
from keytables.sources import read_arrow, scratch_path, write_arrow, write_scratch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.read.parquet(f"{FOLDER}/customer.parquet")


def test_query_job_needs_as_many_sources_as_columns(spark, orders):
    with pytest.raises(ValueError, match="equally long"):
        jobs.query_job(spark, orders, ["o_orderkey"], [])


def test_query_job_without_key_lists(spark, orders):
    assert jobs.query_job(spark, orders, columns=["o_orderkey"]).count() == orders.count()


def test_hash_job_saves_table_and_keys(spark, customers, tmp_path):
    table, keys = str(tmp_path / "table"), str(tmp_path / "keys")
    saved = jobs.hash_job(spark, customers, ["c_custkey", "c_name"], jobs.arrow_saver(table), keys)
    assert saved.columns == [*customers.columns, HASH_COLUMN]
    published = [x for f in Path(keys).glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(published) == sorted(r[0] for r in saved.select(HASH_COLUMN).collect())
    assert len(set(published)) == customers.count()


def test_the_whole_exchange(spark, customers, orders, tmp_path):
    """Keys out, the other party's answer in, the intersection in key order."""
    mine, keys = str(tmp_path / "mine"), str(tmp_path / "keys")
    jobs.hash_job(spark, customers, ["c_custkey"], jobs.arrow_saver(mine), keys)
    theirs = add_hash_column(orders.select("o_custkey").distinct(), ["o_custkey"])
    published = spark.read.text(keys).withColumnRenamed("value", HASH_COLUMN)
    answer = published.join(theirs.where("o_custkey < 100"), HASH_COLUMN).select(HASH_COLUMN)
    write_arrow(answer, str(tmp_path / "answer"))
    target = str(tmp_path / "target")
    got = jobs.psi_job(
        spark, mine, str(tmp_path / "answer"), HASH_COLUMN, "c_custkey", save=jobs.arrow_saver(target)
    )
    both = orders.where("o_custkey < 100").select("o_custkey").distinct()
    want = sorted(r[0] for r in both.join(customers, F.expr("o_custkey = c_custkey")).collect())
    assert [r.c_custkey for r in got.collect()] == want


def test_psi_job_refuses_a_broken_key(spark, orders, tmp_path):
    keys = orders.select("o_custkey").distinct()
    with pytest.raises(KeyContractError):
        jobs.psi_job(
            spark, orders, keys, "o_custkey", "o_custkey", save=jobs.arrow_saver(str(tmp_path / "t"))
        )
    assert not (tmp_path / "t").exists()


@pytest.mark.parametrize("how", ["left", "right", "outer"])
def test_psi_job_join_types(spark, customers, how):
    keys = customers.select("c_custkey").where("c_custkey >= 10")
    got = jobs.psi_job(spark, customers, keys, "c_custkey", "c_custkey", how=how)
    want = customers.count() if how != "right" else customers.count() - 10
    assert [r.c_custkey for r in got.collect()] == sorted(r.c_custkey for r in got.collect())
    assert got.count() == want


def test_empty_results_are_tables(spark, orders, tmp_path):
    none = orders.where("o_orderkey < 0")
    saved = jobs.copy_job(spark, none, jobs.arrow_saver(str(tmp_path / "t")))
    assert saved.schema == orders.schema and saved.count() == 0
    assert jobs.count_job(spark, str(tmp_path / "t")).collect() == [(0,)]
    assert jobs.sort_job(spark, str(tmp_path / "t"), ["o_orderkey"]).count() == 0
    assert jobs.group_count_job(spark, str(tmp_path / "t"), ["o_custkey"]).count() == 0
    assert jobs.join_job(spark, orders, none.select("o_orderkey"), "o_orderkey").count() == 0


def test_only_named_columns_are_read(spark, orders, tmp_path):
    write_arrow(orders, str(tmp_path / "t"))
    assert jobs.load(spark, str(tmp_path / "t"), ["o_custkey"]).columns == ["o_custkey"]
    assert jobs.load(spark, orders, ["o_custkey"]).columns == ["o_custkey"]


def test_saver_overwrites(spark, tmp_path):
    save = jobs.arrow_saver(str(tmp_path / "t"))
    save(spark.range(5))
    assert save(spark.range(3))(None).count() == read_arrow(spark, str(tmp_path / "t")).count() == 3


def test_scratch_tables_are_in_the_shared_folder(spark, orders):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{folder}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = write_scratch(orders, "orders")
    assert kept.schema == orders.schema and kept.inputFiles()[0].removeprefix("file://").startswith(folder)


def test_a_saved_psi_job_leaves_no_scratch_table(spark, customers, tmp_path):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("psi-*"))
    keys = customers.select("c_custkey").where("c_custkey < 10")
    jobs.psi_job(spark, customers, keys, "c_custkey", "c_custkey", save=jobs.arrow_saver(str(tmp_path / "t")))
    with pytest.raises(KeyContractError):
        jobs.psi_job(
            spark, customers, keys, "c_custkey", "c_nationkey", save=jobs.arrow_saver(str(tmp_path / "u"))
        )
    with pytest.raises(ZeroDivisionError):
        jobs.psi_job(spark, customers, keys, "c_custkey", "c_custkey", save=lambda df: 1 / 0)
    assert set(folder.glob("psi-*")) == before


@pytest.fixture
def no_own_broadcast(spark):
    """Else Spark broadcasts tables whose small size it knows."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_limits_and_strategy_reach_the_join(spark, customers, tmp_path, no_own_broadcast):
    keys = customers.select("c_custkey").where("c_custkey < 10")
    write_arrow(keys, str(tmp_path / "k"))
    for limit, hinted in ((1_000_000, True), (5, False)):
        got = jobs.join_job(spark, customers, str(tmp_path / "k"), "c_custkey", broadcast_max_rows=limit)
        assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) == hinted
        filtered = jobs.query_job(
            spark, customers, ["c_custkey"], [str(tmp_path / "k")], broadcast_max_rows=limit
        )
        assert ("BroadcastHashJoin" in filtered._jdf.queryExecution().executedPlan().toString()) == hinted
        assert got.count() == filtered.count() == keys.count()
    pinned = jobs.join_job(
        spark, customers, str(tmp_path / "k"), "c_custkey", strategy="shuffle", num_partitions=13
    )
    assert pinned.rdd.getNumPartitions() == 13


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_a_cluster_must_name_its_folder(master):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        pass

    Context.master = master

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")


def test_jdbc_saver_raises_on_doubled_rows(spark, orders, monkeypatch):
    declared = []
    monkeypatch.setattr(jobs, "write_jdbc", lambda *a, **b: declared.append(b["column_types"]) or "t")
    monkeypatch.setattr(jobs, "read_jdbc_hashed", lambda *a: orders.union(orders.limit(1)))
    types = {"o_orderstatus": "VARCHAR(1)"}
    with pytest.raises(RuntimeError, match="not the 1500 written"):
        jobs.jdbc_saver("jdbc:x", "o_orderkey", column_types=types)(orders)
    assert declared[0]["o_orderstatus"] == "VARCHAR(1)" and declared[0]["o_orderkey"] == "bigint"
    jobs.jdbc_saver("jdbc:x", "o_orderkey", column_types=types, check=False)(orders)


def test_jdbc_saver_reads_back_in_slices(spark, orders, monkeypatch):
    calls = []

    def write(df, url, table, properties):
        calls.append((url, table, properties))
        return table or "result_0"

    def read(session, url, table, key, slices, dialect, properties):
        calls.append((url, table, key, slices, dialect, properties))
        return orders

    monkeypatch.setattr(jobs, "write_jdbc", write)
    monkeypatch.setattr(jobs, "read_jdbc_hashed", read)
    save = jobs.jdbc_saver("jdbc:x", "o_orderkey", "mysql", num_partitions=3, properties={"user": "me"})
    saved = save(orders)
    assert saved(["o_custkey"]).columns == ["o_custkey"]
    assert calls == [
        ("jdbc:x", None, {"user": "me"}),
        ("jdbc:x", "result_0", "o_orderkey", 3, "mysql", {"user": "me"}),
    ]
