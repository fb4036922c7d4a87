"""What can be told without a database: options, slices, declared types and the options Spark gets."""

import datetime
import zlib
from collections import Counter
from unittest import mock

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytables.sources import jdbc
from keytables.sources.jdbc import (
    create_types,
    edge_predicates,
    even_edges,
    jdbc_column_types,
    jdbc_options,
    range_predicates,
    read_jdbc_hashed,
    read_jdbc_query,
    read_jdbc_ranged,
    slice_predicates,
    write_jdbc,
)


def test_options_keep_credentials_out_of_the_url():
    url, properties = jdbc_options("mysql", "db", 3306, "shop", "me", "secret")
    assert url == "jdbc:mysql://db:3306/shop"
    assert properties["driver"] == "com.mysql.cj.jdbc.Driver"
    assert (properties["user"], properties["password"]) == ("me", "secret")
    url, properties = jdbc_options("2", "db", 54321, "shop")
    assert url == "jdbc:kingbase8://db:54321/shop"
    assert properties["driver"] == "com.kingbase8.Driver" and "user" not in properties
    assert jdbc_options("1", "db", 1, "x")[0].startswith("jdbc:mysql:")
    with pytest.raises(ValueError, match="no such database"):
        jdbc_options("3", "db", 1, "x")


def test_slice_texts():
    assert slice_predicates("k", 2, "mysql") == [
        "MOD(ABS(CRC32(`k`)), 2) = 0",
        "MOD(ABS(CRC32(`k`)), 2) = 1",
        "`k` IS NULL",
    ]
    assert slice_predicates("k", 1, "kingbase") == [
        'ABS(MOD(hashtext("k"::text), 1)) = 0',
        '"k" IS NULL',
    ]
    assert slice_predicates("k", 1, "numeric") == ['ABS(MOD("k", 1)) = 0', '"k" IS NULL']
    assert slice_predicates(["a", "b"], 4, "1")[3:] == [
        "MOD(ABS(CRC32(CASE WHEN `a` IS NOT NULL OR `b` IS NOT NULL"
        " THEN CONCAT_WS('|', `a`, `b`) END)), 4) = 3",
        "`a` IS NULL AND `b` IS NULL",
    ]


def test_names_are_quoted():
    assert slice_predicates("a`b", 1, "mysql")[1] == "`a``b` IS NULL"
    assert slice_predicates('a"; DROP', 1, "2")[1] == '"a""; DROP" IS NULL'


def test_refused_slices():
    for arguments in (("k", 0, "mysql"), ([], 1, "mysql"), ("k", 1, "db2"), (["a", "b"], 1, "numeric")):
        with pytest.raises(ValueError):
            slice_predicates(*arguments)


def hits(spark, df, predicates):
    """Per row: the slices that select it. The texts are close enough to Spark's own SQL to run here."""
    tests = [F.expr(p.replace('"', "`")).eqNullSafe(True).cast("int") for p in predicates]
    return df.select("*", F.array(*tests).alias("hit")).collect()


def test_null_keys_have_a_slice(spark):
    rows = [(None if i % 5 == 0 else i, f"n{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "id int, nm string")
    got = hits(spark, df, slice_predicates("id", 3, "numeric"))
    assert all(sum(r.hit) == 1 for r in got)
    assert sum(r.hit[-1] for r in got) == 4


@settings(deadline=None, max_examples=10)
@given(st.lists(st.none() | st.integers(-(2**63), 2**63 - 1), min_size=1), st.integers(1, 12))
def test_numeric_slices_are_disjoint_and_complete(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for row in hits(spark, df, slice_predicates("k", n, "numeric")):
        want = n if row.k is None else abs(row.k) % n
        assert [i for i, hit in enumerate(row.hit) if hit] == [want]


@settings(deadline=None, max_examples=10)
@given(st.lists(st.tuples(st.none() | st.text(), st.none() | st.text()), min_size=1), st.integers(1, 9))
def test_mysql_slices_are_disjoint_and_complete(spark, values, n):
    df = spark.createDataFrame(values, "a string, b string")
    for row in hits(spark, df, slice_predicates(["a", "b"], n, "mysql")):
        held = [v for v in (row.a, row.b) if v is not None]
        want = zlib.crc32("|".join(held).encode()) % n if held else n
        assert [i for i, hit in enumerate(row.hit) if hit] == [want]


RANGED = {
    "k long": st.integers(-(2**62), 2**62),
    "k decimal(12,2)": st.decimals(-(10**9), 10**9, places=2),
    "k date": st.dates(datetime.date(1900, 1, 1), datetime.date(2100, 1, 1)),
}


@settings(deadline=None, max_examples=6)
@given(st.data(), st.integers(1, 9))
@pytest.mark.parametrize("schema", RANGED)
def test_ranges_are_disjoint_and_complete(spark, schema, data, n):
    values = data.draw(st.lists(st.none() | RANGED[schema], min_size=1))
    known = [v for v in data.draw(st.lists(st.sampled_from(values))) if v is not None]
    low, high = (min(known), max(known)) if known else (None, None)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{schema}, other long")
    plain = range_predicates("k", low, high, n, "numeric")
    split = range_predicates("k", low, high, n, "numeric", nulls_by="other")
    for predicates in (plain, split):
        for row in hits(spark, df, predicates):
            assert sum(row.hit) == 1
            assert (row.k is None) == any(row.hit[i] for i, p in enumerate(predicates) if "IS NULL" in p)


def test_range_texts():
    assert range_predicates("k", 0, 9, 3, "mysql") == ["`k` < 3", "`k` >= 3 AND `k` < 6", "`k` >= 6", "`k` IS NULL"]
    assert range_predicates("k", 5, 5, 3, "2") == ['"k" IS NOT NULL', '"k" IS NULL']
    assert range_predicates("k", None, None, 3, "1", "j")[1] == "`k` IS NULL AND MOD(ABS(CRC32(`j`)), 3) = 0"
    day = datetime.date(2020, 1, 1)
    assert range_predicates("d", day, day + datetime.timedelta(10), 2, "1")[0] == "`d` < DATE '2020-01-06'"
    for wrong in ("a", 1.5, datetime.datetime(2020, 1, 1)):
        with pytest.raises(ValueError, match="integer, decimal or date"):
            range_predicates("k", wrong, wrong, 2, "1")


def test_ranged_reads_ask_for_the_ends_first():
    session = mock.MagicMock()
    session.read.format().options().load().first.return_value = (0, 9)
    read_jdbc_ranged(session, "jdbc:mysql://h/d", "t", "k", 3)
    query = session.read.format().options.call_args.kwargs["query"]
    assert query == "SELECT MIN(`k`) AS low, MAX(`k`) AS high FROM t"
    assert session.read.jdbc.call_args.kwargs["predicates"] == range_predicates("k", 0, 9, 3, "mysql")


@settings(deadline=None, max_examples=8)
@given(
    st.lists(st.none() | st.integers(-3, 3) | st.integers(0, 40) | st.integers(-(2**62), 2**62), max_size=80),
    st.integers(1, 9),
)
def test_even_ranges_hold_two_shares_or_one_value(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "k long")
    edges = even_edges(df, "k", n)
    assert edges == sorted(set(edges)) and len(edges) < 2 * n
    held = {}
    for row in hits(spark, df, edge_predicates("k", edges, "numeric")):
        assert sum(row.hit) == 1
        held.setdefault(row.hit.index(1), []).append(row.k)
    known = [v for v in values if v is not None]
    for keys in held.values():
        assert None in keys or len(set(keys)) == 1 or len(keys) <= 2 * len(known) / n


def test_even_ranges_of_a_sample_of_a_skewed_key(spark):
    # A third of the rows on one value, the others ever sparser.
    df = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE CAST(pow(id / 1000, 4) AS LONG) END AS k")
    edges = even_edges(df.sample(0.1, 7), "k", 20)
    sizes = Counter(row.hit.index(1) for row in hits(spark, df, edge_predicates("k", edges, "mysql")))
    ranked = sorted(sizes.values())
    assert 20_000 <= ranked[-1] < 20_100 and ranked[-2] < 2.2 * 3000
    wide = range_predicates("k", 0, 60**4, 20, "mysql")
    assert max(Counter(row.hit.index(1) for row in hits(spark, df, wide)).values()) > 1.5 * ranked[-1]


def test_edges_of_other_kinds(spark):
    days = spark.createDataFrame([(datetime.date(2020, 1, 1 + i),) for i in range(4)], "k date")
    assert edge_predicates("k", even_edges(days, "k", 2), "2")[0] == "\"k\" < DATE '2020-01-03'"
    assert edge_predicates("k", [], "mysql") == ["`k` IS NOT NULL", "`k` IS NULL"]
    assert len(edge_predicates("k", [1], "mysql", "j", 4)) == 2 + 5
    with pytest.raises(ValueError, match="integer, decimal or date"):
        edge_predicates("k", ["a"], "mysql")
    with pytest.raises(ValueError, match="at least 1"):
        even_edges(days, "k", 0)


def test_a_sampled_read_draws_keys_in_the_database(spark):
    queries = []

    class Reader(mock.MagicMock):
        def options(self, **given):
            queries.append(given["query"])
            answer = [(1000,)] if "COUNT" in given["query"] else [(v,) for v in range(10)]
            loaded = mock.MagicMock()
            loaded.load.return_value = spark.createDataFrame(answer, "k long")
            return loaded

    session = mock.MagicMock()
    reader = Reader()
    session.read.format.return_value = reader
    read_jdbc_ranged(session, "jdbc:mysql://h/d", "t", "k", 2, sample_rows=100)
    assert queries == [
        "SELECT COUNT(`k`) AS n FROM t",
        "SELECT `k` AS k FROM t WHERE `k` IS NOT NULL AND RAND() < 0.100000000000",
    ]
    assert session.read.jdbc.call_args.kwargs["predicates"] == ["`k` < 5", "`k` >= 5", "`k` IS NULL"]
    with pytest.raises(ValueError, match="a sample needs"):
        read_jdbc_ranged(session, "jdbc:x", "t", "k", 2, "numeric", sample_rows=100)


def test_reads_are_left_to_spark():
    session = mock.MagicMock()
    read_jdbc_hashed(session, "jdbc:x", "t", "k", 2, "numeric", {"user": "me"})
    session.read.jdbc.assert_called_once_with(
        url="jdbc:x",
        table="t",
        predicates=slice_predicates("k", 2, "numeric"),
        properties={"fetchsize": "10000", "user": "me"},
    )
    read_jdbc_hashed(session, "jdbc:mysql://h/d", "t", "k", 2)
    arguments = session.read.jdbc.call_args.kwargs
    assert arguments["properties"] == {"fetchsize": "10000", "useCursorFetch": "true"}
    assert arguments["predicates"] == slice_predicates("k", 2, "mysql")
    with pytest.raises(ValueError, match="give a dialect"):
        read_jdbc_hashed(session, "jdbc:h2:mem", "t", "k", 2)
    read_jdbc_query(session, "jdbc:x", " SELECT 1; ", {"user": "me"})
    session.read.format.assert_called_once_with("jdbc")
    options = session.read.format().options.call_args.kwargs
    assert options["query"] == "SELECT 1" and options["user"] == "me"


def test_a_large_query_result_is_read_in_slices():
    session = mock.MagicMock()
    read_jdbc_query(session, "jdbc:x", "SELECT k FROM t;", key="k", num_partitions=3, dialect="2")
    arguments = session.read.jdbc.call_args.kwargs
    assert arguments["table"] == "(SELECT k FROM t) subquery"
    assert arguments["predicates"] == slice_predicates("k", 3, "kingbase")


@pytest.fixture
def table(spark):
    length = {"__CHAR_VARCHAR_TYPE_STRING": "varchar(40)"}
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("name", T.StringType(), metadata=length),
            T.StructField("note", T.StringType()),
            T.StructField("price", T.DecimalType(10, 2)),
        ]
    )
    return spark.createDataFrame([], schema)


def test_column_types_keep_lengths(table):
    want = {"id": "bigint", "name": "varchar(40)", "note": "string", "price": "decimal(10,2)"}
    assert jdbc_column_types(table) == want
    assert jdbc_column_types(table.withColumn("x", F.lit(1)).drop("id"))["name"] == "varchar(40)"


def test_declared_types_are_ones_spark_takes(spark, table):
    text = create_types(table, {**jdbc_column_types(table), "absent": "int"})
    assert text == "`id` bigint, `name` varchar(40), `price` decimal(10,2)"
    parsed = T.StructType.fromDDL(text)
    assert parsed.names == ["id", "name", "price"]


def test_the_table_that_mysql_would_create(spark, table):
    """The column list of Spark's MySQL dialect, which needs no connection."""
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get("jdbc:mysql://host/db")
    text = create_types(table, {**jdbc_column_types(table), "note": "VARCHAR(64)"})
    create = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.schemaString
    some = getattr(jvm.scala, "Option").apply(text)
    shown = create(dialect, table._jdf.schema(), False, some)
    assert "`note` VARCHAR(64)" in shown and "`name` varchar(40)" in shown.replace("VARCHAR(40)", "varchar(40)")
    plain = create(dialect, table._jdf.schema(), False, getattr(jvm.scala, "Option").apply(None))
    assert "`note` LONGTEXT" in plain


def test_write_names_the_table_and_declares_its_types(spark):
    df = mock.MagicMock(columns=["a"])
    name = write_jdbc(df, "jdbc:x", column_types={"a": "VARCHAR(4)", "b": "int"}, properties={"u": "v"})
    assert name.startswith("result_") and len(name) == len("result_") + 8
    df.write.mode.assert_called_once_with("overwrite")
    writer = df.write.mode()
    writer.option.assert_called_once_with("createTableColumnTypes", "`a` VARCHAR(4)")
    writer.option().jdbc.assert_called_once_with("jdbc:x", name, properties={"u": "v"})
    plain = mock.MagicMock(columns=["a"])
    assert write_jdbc(plain, "jdbc:x", "t", column_types={}, mode="append") == "t"
    plain.write.mode().option.assert_not_called()


def test_default_slice_count():
    assert jdbc.DEFAULT_SLICES == 10
