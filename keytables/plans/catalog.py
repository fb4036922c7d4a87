"""The operators as queries over whole tables, each with the SQL that gives the same rows.

A query takes the session and a folder of Parquet tables. Tables written on the way go to the shared
scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytables.functions.keys import HASH_COLUMN, hash_key
from keytables.operators import (
    add_hash_column,
    count_rows,
    estimate_size,
    group_count,
    join_tables,
    key_contract,
    key_filter,
    key_violations,
    project,
    psi_join,
    sort_table,
    where,
    write_sorted,
)
from keytables.operators.prefilter import PREFILTER_MAX_BYTES
from keytables.operators.size import weight
from keytables.plans import jobs
from keytables.sources import (
    edge_predicates,
    even_edges,
    export_key_column,
    kept_rows,
    read_arrow,
    scratch_path,
    slice_predicates,
    stage_rows,
    write_arrow,
)
from keytables.sources.staging import TOLD


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


CATALOG: dict[str, Query] = {}


def _query(sql: str):
    def add(run):
        CATALOG[run.__name__] = Query(run, sql)
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _arrow(spark: SparkSession, df: DataFrame, name: str) -> str:
    """The path of ``df`` written as Arrow files."""
    path = scratch_path(spark, name)
    write_arrow(df, path)
    return path


# Files written from a table dealt out anew hold about so many bytes of it, as its size is listed.
_PART_BYTES = 32 * 1024 * 1024


def _in_parts(df: DataFrame, least: int) -> DataFrame:
    """``df`` dealt out evenly, over at least so many partitions and more for a larger table."""
    return df.repartition(max(least, -(-weight(df) // _PART_BYTES)))


# Inputs that several queries share.


def _large_lines(spark, folder):
    """Order keys of large line items; an order with several of them comes several times."""
    lines = where(_table(spark, folder, "lineitem"), "l_quantity >= 49")
    return lines.select(F.col("l_orderkey").alias("o_orderkey"))


_LARGE_LINES = "SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_quantity >= 49"


def _household(spark, folder):
    customers = where(_table(spark, folder, "customer"), "c_mktsegment = 'HOUSEHOLD'")
    return customers.select(F.col("c_custkey").alias("o_custkey"))


_HOUSEHOLD = "SELECT c_custkey AS o_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'"


def _lines_by_order(spark, folder):
    return _table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")


_LINES_BY_ORDER = "SELECT l_orderkey AS o_orderkey, * EXCLUDE (l_orderkey) FROM lineitem"


def _vectors(spark, folder):
    return _table(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")


# A number that changes with every element of a vector and with their order.
_DIGEST = (
    "aggregate(transform(embedding, (x, i) -> CAST(floor(CAST(x AS DOUBLE) * 1e6) AS BIGINT) * (i + 1)),"
    " 0L, (a, x) -> a + x) AS vector"
)
_DIGEST_SQL = (
    "(SELECT CAST(sum(CAST(floor(CAST(embedding[i] AS DOUBLE) * 1e6) AS BIGINT) * i) AS BIGINT)"
    " FROM range(1, len(embedding) + 1) AS places(i)) AS vector"
)
_VECTORS = "SELECT vec_id AS doc_id, embedding, label FROM embeddings"
_OUTER = (
    f"SELECT doc_id, {_DIGEST_SQL}, label, quality, toxic FROM ({_VECTORS}) FULL JOIN labels USING (doc_id)"
)


def _with_digest(joined: DataFrame) -> DataFrame:
    return joined.selectExpr("doc_id", _DIGEST, "label", "quality", "toxic")


def _returned_pairs(spark, folder):
    """Part and supplier of returned large lines: a table with a key of two columns."""
    lines = where(_table(spark, folder, "lineitem"), ["l_returnflag = 'R'", "l_quantity >= 45"])
    return group_count(lines, ["l_partkey", "l_suppkey"]).withColumnRenamed("count", "n_returned")


_RETURNED_PAIRS = (
    "SELECT l_partkey, l_suppkey, count(*) AS n_returned FROM lineitem"
    " WHERE l_returnflag = 'R' AND l_quantity >= 45 GROUP BY l_partkey, l_suppkey"
)


def _keyed_customers(spark, folder):
    return add_hash_column(_table(spark, folder, "customer"), ["c_custkey"])


_KEYED_CUSTOMERS = (
    f"SELECT *, substr(sha256(c_custkey::VARCHAR), 1, 32) AS {HASH_COLUMN} FROM customer"
)


def _urgent_keys(spark, folder):
    """The other party's keys: those of the customers with an urgent order."""
    orders = where(_table(spark, folder, "orders"), "o_orderpriority = '1-URGENT'")
    return orders.select(hash_key("o_custkey").alias(HASH_COLUMN)).distinct()


_URGENT_KEYS = (
    f"SELECT DISTINCT substr(sha256(o_custkey::VARCHAR), 1, 32) AS {HASH_COLUMN} FROM orders"
    " WHERE o_orderpriority = '1-URGENT'"
)

_PSI = (
    f"SELECT * FROM ({_KEYED_CUSTOMERS}) JOIN ({_URGENT_KEYS}) USING ({HASH_COLUMN})"
    " ORDER BY c_custkey"
)


# Key-list filters and projections.


@_query(
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
    f" WHERE o_orderkey IN ({_LARGE_LINES})"
)
def key_filter_semi(spark, folder):
    # The list comes from the largest table: Spark decides, rather than computing it twice.
    keys = {"o_orderkey": _large_lines(spark, folder)}
    orders = key_filter(_table(spark, folder, "orders"), keys, broadcast_max_rows=0)
    return project(orders, ["o_orderkey", "o_custkey", "o_totalprice"])


@_query(f"SELECT * FROM orders JOIN ({_LARGE_LINES}) USING (o_orderkey)")
def key_filter_inner(spark, folder):
    keys = {"o_orderkey": _large_lines(spark, folder)}
    return key_filter(_table(spark, folder, "orders"), keys, "inner", broadcast_max_rows=0)


@_query(
    f"SELECT * FROM orders WHERE o_orderkey IN ({_LARGE_LINES}) AND o_custkey IN ({_HOUSEHOLD})"
)
def key_filter_multi(spark, folder):
    keys = {
        "o_orderkey": _large_lines(spark, folder),
        "o_custkey": _household(spark, folder),
    }
    return key_filter(_table(spark, folder, "orders"), keys, broadcast_max_rows=0)


@_query("SELECT event_id, user_id, event_type, props FROM events")
def project_columns(spark, folder):
    return project(_table(spark, folder, "events"), ["event_id", "user_id", "event_type", "props"])


@_query(
    "SELECT c_custkey, upper(c_mktsegment) AS seg, c_acctbal * 2 AS bal2,"
    " concat_ws('-', c_name, c_mktsegment) AS tag FROM customer"
)
def project_expr(spark, folder):
    exprs = [
        "c_custkey",
        "upper(c_mktsegment) AS seg",
        "c_acctbal * 2 AS bal2",
        "concat_ws('-', c_name, c_mktsegment) AS tag",
    ]
    return project(_table(spark, folder, "customer"), exprs=exprs)


@_query("SELECT count(*) AS n, max(n_chars) AS longest FROM documents")
def project_aggregate(spark, folder):
    exprs = ["count(*) AS n", "max(n_chars) AS longest"]
    return project(_table(spark, folder, "documents"), exprs=exprs)


@_query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def project_distinct(spark, folder):
    orders = _table(spark, folder, "orders")
    return project(orders, ["o_orderstatus", "o_orderpriority"], distinct=True)


# Predicates, counts and sizes.


@_query(
    "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'"
    " AND o_orderpriority IN ('1-URGENT', '2-HIGH')"
)
def where_list(spark, folder):
    conditions = [
        "o_totalprice > 100000 AND o_orderstatus = 'O'",
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
    ]
    return where(_table(spark, folder, "orders"), conditions)


@_query("SELECT count(*) AS count FROM documents")
def count_all(spark, folder):
    return count_rows(_table(spark, folder, "documents"))


@_query("SELECT count(*) AS count FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'")
def count_where(spark, folder):
    return count_rows(
        _table(spark, folder, "lineitem"), ["l_quantity > 25", "l_returnflag = 'R'"]
    )


@_query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def group_count_one(spark, folder):
    return group_count(_table(spark, folder, "events"), ["event_type"])


@_query(
    "SELECT lang, source, count(*) AS count FROM documents WHERE n_chars > 100 GROUP BY lang, source"
)
def group_count_multi(spark, folder):
    return group_count(_table(spark, folder, "documents"), ["lang", "source"], "n_chars > 100")


@_query("SELECT text, count(*) AS count FROM documents GROUP BY text")
def group_count_text(spark, folder):
    return group_count(_table(spark, folder, "documents"), ["text"])


@_query(
    "SELECT CAST(sum(strlen(concat_ws('|', doc_id, text, lang, source, n_chars))) AS BIGINT) AS bytes,"
    " count(*) AS n_rows FROM documents"
)
def size_estimate(spark, folder):
    return estimate_size(_table(spark, folder, "documents"))


# Order.


@_query("SELECT * FROM orders ORDER BY o_custkey, o_orderkey")
def sort_orders(spark, folder):
    return sort_table(_table(spark, folder, "orders"), ["o_custkey", "o_orderkey"])


@_query("SELECT * FROM lineitem ORDER BY l_returnflag DESC")
def sort_few_values(spark, folder):
    return sort_table(_table(spark, folder, "lineitem"), "l_returnflag", ascending=False)


@_query("SELECT * FROM orders ORDER BY o_orderkey")
def sorted_write(spark, folder):
    save = jobs.arrow_saver(scratch_path(spark, "sorted"))
    return write_sorted(_table(spark, folder, "orders"), "o_orderkey", save)(None)


# Joins.


@_query("SELECT * FROM documents JOIN labels USING (doc_id)")
def join_inner(spark, folder):
    return join_tables(_table(spark, folder, "documents"), _table(spark, folder, "labels"), "doc_id")


@_query("SELECT * FROM documents LEFT JOIN labels USING (doc_id)")
def join_left(spark, folder):
    documents, labels = (_table(spark, folder, n) for n in ("documents", "labels"))
    return join_tables(documents, labels, "doc_id", "left")


@_query(f"SELECT * FROM ({_LINES_BY_ORDER}) RIGHT JOIN orders USING (o_orderkey)")
def join_right(spark, folder):
    orders = _table(spark, folder, "orders")
    return join_tables(_lines_by_order(spark, folder), orders, "o_orderkey", "right")


@_query(_OUTER)
def join_outer(spark, folder):
    labels = _table(spark, folder, "labels")
    return _with_digest(join_tables(_vectors(spark, folder), labels, "doc_id", "outer"))


@_query(f"SELECT * FROM orders LEFT JOIN ({_LINES_BY_ORDER}) USING (o_orderkey)")
def join_left_shuffle(spark, folder):
    orders = _table(spark, folder, "orders")
    return join_tables(orders, _lines_by_order(spark, folder), "o_orderkey", "left", "shuffle")


@_query(_OUTER)
def join_outer_shuffle(spark, folder):
    labels = _table(spark, folder, "labels")
    return _with_digest(join_tables(_vectors(spark, folder), labels, "doc_id", "outer", "shuffle"))


# A third of the lines, those without a real part, share one key.
_CROWDED = "CASE WHEN l_linenumber % 3 = 1 THEN -1 ELSE l_partkey END AS p_partkey, l_orderkey, l_linenumber, l_quantity"


@_query(
    f"SELECT p_partkey, l_orderkey, l_linenumber, l_quantity, p_name, p_size FROM (SELECT {_CROWDED} FROM lineitem)"
    " FULL JOIN (SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 10) USING (p_partkey)"
)
def join_outer_skew(spark, folder):
    lines = _table(spark, folder, "lineitem").selectExpr(*_CROWDED.split(", "))
    parts = _table(spark, folder, "part").where("p_size > 10").select("p_partkey", "p_name", "p_size")
    return join_tables(lines, parts, "p_partkey", "outer", "skew")


@_query(
    f"SELECT l.*, p.n_returned FROM lineitem l JOIN ({_RETURNED_PAIRS}) p USING (l_partkey, l_suppkey)"
)
def join_multi_key(spark, folder):
    lines = _table(spark, folder, "lineitem")
    return join_tables(lines, _returned_pairs(spark, folder), ["l_partkey", "l_suppkey"])


@_query(
    "SELECT doc_id, c.text, c.lang, c.source, c.n_chars, b.text AS text_item"
    " FROM documents c JOIN (SELECT item_id AS doc_id, text FROM benchmark) b USING (doc_id)"
)
def join_suffix(spark, folder):
    items = _table(spark, folder, "benchmark").withColumnRenamed("item_id", "doc_id")
    return join_tables(_table(spark, folder, "documents"), items, "doc_id", suffix="_item")


@_query(
    "SELECT l.* EXCLUDE (l_orderkey), l_orderkey AS o_orderkey, o.o_custkey, o.o_totalprice FROM lineitem l"
    " JOIN (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 495000) o"
    " ON l.l_orderkey = o.o_orderkey"
)
def join_prefiltered(spark, folder):
    orders = where(_table(spark, folder, "orders"), "o_totalprice >= 495000")
    dearest = project(orders, ["o_orderkey", "o_custkey", "o_totalprice"])
    lines = _lines_by_order(spark, folder)
    return join_tables(lines, dearest, "o_orderkey", strategy="shuffle", prefilter_bytes=PREFILTER_MAX_BYTES)


@_query(
    "SELECT * FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_retailprice < 901)"
)
def key_filter_prefiltered(spark, folder):
    parts = where(_table(spark, folder, "part"), "p_retailprice < 901")
    keys = {"l_partkey": parts.select(F.col("p_partkey").alias("l_partkey"))}
    lines = _table(spark, folder, "lineitem")
    return key_filter(lines, keys, broadcast_max_rows=0, prefilter_bytes=PREFILTER_MAX_BYTES)


# Hash keys.


@_query(
    "SELECT *, substr(sha256(concat_ws('|', c_custkey, c_name)), 1, 32) AS combined_join_column"
    " FROM customer"
)
def hash_customer(spark, folder):
    return add_hash_column(_table(spark, folder, "customer"), ["c_custkey", "c_name"])


@_query(
    "SELECT *, substr(sha256(concat_ws('|', o_orderkey, o_orderdate, o_totalprice, o_orderpriority)),"
    " 1, 32) AS combined_join_column FROM orders"
)
def hash_mixed_types(spark, folder):
    columns = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    return add_hash_column(_table(spark, folder, "orders"), columns)


@_query(
    "SELECT doc_id, substr(sha256(concat_ws('|', text, lang)), 1, 32) AS combined_join_column"
    " FROM documents"
)
def hash_text(spark, folder):
    keyed = add_hash_column(_table(spark, folder, "documents"), ["text", "lang"])
    return project(keyed, ["doc_id", HASH_COLUMN])


@_query(
    "SELECT page_id, substr(sha256(concat_ws('|', coalesce(length(url) || ':' || url, '-'),"
    " coalesce(length(html) || ':' || html, '-'))), 1, 32) AS combined_join_column FROM pages"
)
def hash_strict(spark, folder):
    keyed = add_hash_column(_table(spark, folder, "pages"), ["url", "html"], strict=True)
    return project(keyed, ["page_id", HASH_COLUMN])


@_query(f"SELECT {HASH_COLUMN} FROM ({_KEYED_CUSTOMERS})")
def export_keys(spark, folder):
    path = scratch_path(spark, "keys")
    export_key_column(_keyed_customers(spark, folder), HASH_COLUMN, path)
    return spark.read.text(path).withColumnRenamed("value", HASH_COLUMN)


# Joins of a keyed table with returned keys.


@_query(_PSI)
def psi_join_auto(spark, folder):
    return psi_join(
        _keyed_customers(spark, folder), _urgent_keys(spark, folder), HASH_COLUMN, order_by="c_custkey"
    )


@_query(_PSI)
def psi_join_broadcast(spark, folder):
    return psi_join(
        _keyed_customers(spark, folder),
        _urgent_keys(spark, folder),
        HASH_COLUMN,
        order_by="c_custkey",
        strategy="broadcast",
    )


@_query(_PSI)
def psi_join_shuffle(spark, folder):
    return psi_join(
        _keyed_customers(spark, folder),
        _urgent_keys(spark, folder),
        HASH_COLUMN,
        order_by="c_custkey",
        strategy="shuffle",
    )


@_query(
    f"SELECT * FROM lineitem JOIN ({_RETURNED_PAIRS}) USING (l_partkey, l_suppkey) ORDER BY l_orderkey"
)
def psi_join_two_keys(spark, folder):
    return psi_join(
        _table(spark, folder, "lineitem"),
        _returned_pairs(spark, folder),
        ["l_partkey", "l_suppkey"],
        order_by="l_orderkey",
    )


@_query(
    "SELECT * FROM lineitem JOIN (SELECT s_suppkey AS l_suppkey, s_name FROM supplier"
    " WHERE s_acctbal > 0) USING (l_suppkey) ORDER BY l_orderkey"
)
def psi_join_pinned(spark, folder):
    suppliers = where(_table(spark, folder, "supplier"), "s_acctbal > 0")
    keys = suppliers.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return psi_join(
        _table(spark, folder, "lineitem"),
        keys,
        "l_suppkey",
        order_by="l_orderkey",
        strategy="shuffle",
        num_partitions=16,
    )


@_query(
    f"SELECT * FROM ({_KEYED_CUSTOMERS}) LEFT JOIN (SELECT *, true AS returned FROM ({_URGENT_KEYS}))"
    f" USING ({HASH_COLUMN}) ORDER BY c_custkey"
)
def psi_join_left(spark, folder):
    keys = _urgent_keys(spark, folder).withColumn("returned", F.lit(True))
    return psi_join(
        _keyed_customers(spark, folder), keys, HASH_COLUMN, how="left", order_by="c_custkey"
    )


# Data contracts.


@_query(
    "SELECT count(*) AS n_rows, count(*) - count(l_orderkey) AS n_null,"
    " count(DISTINCT l_orderkey) AS n_distinct FROM lineitem"
)
def key_contract_lines(spark, folder):
    return key_contract(_table(spark, folder, "lineitem"), "l_orderkey")


@_query("SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def key_violations_lines(spark, folder):
    return key_violations(_table(spark, folder, "lineitem"), "l_orderkey")


# Sources and sinks.


@_query("SELECT * FROM orders")
def arrow_roundtrip(spark, folder):
    return read_arrow(spark, _arrow(spark, _table(spark, folder, "orders"), "orders"))


@_query("SELECT * FROM documents")
def arrow_multi_file(spark, folder):
    documents = _in_parts(_table(spark, folder, "documents"), 4)
    return read_arrow(spark, _arrow(spark, documents, "documents"))


@_query("SELECT l_orderkey, l_shipdate FROM lineitem")
def arrow_columns(spark, folder):
    path = _arrow(spark, _table(spark, folder, "lineitem"), "lineitem")
    return read_arrow(spark, path, columns=["l_orderkey", "l_shipdate"])


@_query("SELECT * FROM documents")
def arrow_file_list(spark, folder):
    """A list of paths, each a directory of its own."""
    documents = _table(spark, folder, "documents")
    halves = [documents.where(f"pmod(doc_id, 2) = {i}") for i in (0, 1)]
    paths = [_arrow(spark, half, f"documents-{i}") for i, half in enumerate(halves)]
    return read_arrow(spark, paths)


@_query("SELECT * FROM orders")
def arrow_glob(spark, folder):
    path = _arrow(spark, _in_parts(_table(spark, folder, "orders"), 3), "orders")
    return read_arrow(spark, f"{path}/part-*.arrow")


@_query(
    "SELECT vec_id, len(embedding) AS n, CAST(embedding[1] AS DOUBLE) AS head,"
    f" CAST(embedding[len(embedding)] AS DOUBLE) AS tail, {_DIGEST_SQL} FROM embeddings"
)
def arrow_nested(spark, folder):
    vectors = read_arrow(spark, _arrow(spark, _table(spark, folder, "embeddings"), "vectors"))
    exprs = [
        "vec_id",
        "CAST(size(embedding) AS BIGINT) AS n",
        "CAST(element_at(embedding, 1) AS DOUBLE) AS head",
        "CAST(element_at(embedding, -1) AS DOUBLE) AS tail",
        _DIGEST,
    ]
    return project(vectors, exprs=exprs)


@_query("SELECT abs(o_custkey) % 10 AS slice, count(*) AS count FROM orders GROUP BY slice")
def jdbc_slices(spark, folder):
    """The conditions of a sliced database read, tried on a Parquet table: no row lost or doubled. No database
    is read."""
    orders = _table(spark, folder, "orders")
    slices = slice_predicates("o_custkey", 10, "numeric")
    numbers = [
        F.when(F.expr(condition.replace('"', "`")), F.lit(i).cast("long"))
        for i, condition in enumerate(slices)
    ]
    held = orders.select(F.explode(F.array_compact(F.array(*numbers))).alias("slice"))
    return group_count(held, ["slice"])


@_query("SELECT l_orderkey, l_linenumber, l_suppkey, 1 AS n_slices FROM lineitem")
def jdbc_even_slices(spark, folder):
    """How many of the ranges, cut by a sample of the keys, select each row: one. No database is read."""
    lines = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    edges = even_edges(lines.sample(min(1.0, 20_000 / max(lines.count(), 1))), "l_suppkey", 10)
    ranges = edge_predicates("l_suppkey", edges, "numeric")
    tests = [F.coalesce(F.expr(p.replace('"', "`")).cast("long"), F.lit(0)) for p in ranges]
    return lines.withColumn("n_slices", reduce(add, tests))


# Whole jobs.


@_query(
    "SELECT o_orderkey, round(o_totalprice, 0) AS price FROM orders"
    f" WHERE o_orderkey IN ({_LARGE_LINES}) AND o_custkey IN ({_HOUSEHOLD})"
)
def query_job(spark, folder):
    return jobs.query_job(
        spark,
        _arrow(spark, _table(spark, folder, "orders"), "orders"),
        ["o_orderkey", "o_custkey"],
        [
            _arrow(spark, _large_lines(spark, folder), "lines"),
            _arrow(spark, _household(spark, folder), "customers"),
        ],
        exprs=["o_orderkey", "round(o_totalprice, 0) AS price"],
        read_columns=["o_orderkey", "o_custkey", "o_totalprice"],
    )


@_query("SELECT * FROM customer")
def copy_job(spark, folder):
    save = jobs.arrow_saver(scratch_path(spark, "copy"))
    return jobs.copy_job(spark, _table(spark, folder, "customer"), save)


@_query("SELECT * FROM events ORDER BY ts, event_id")
def sort_job(spark, folder):
    path = _arrow(spark, _table(spark, folder, "events"), "events")
    return jobs.sort_job(spark, path, ["ts", "event_id"])


@_query("SELECT count(*) AS count FROM lineitem WHERE l_discount > 0.05")
def count_job(spark, folder):
    path = _arrow(spark, _table(spark, folder, "lineitem"), "lineitem")
    return jobs.count_job(spark, path, ["l_discount > 0.05"], read_columns=["l_discount"])


@_query("SELECT count(*) AS count FROM lineitem")
def count_job_listed(spark, folder):
    """From the rows that the table's manifest lists."""
    return jobs.count_job(spark, _arrow(spark, _table(spark, folder, "lineitem"), "lineitem"))


@_query("SELECT * FROM orders WHERE o_orderkey BETWEEN 1000 AND 2500")
def arrow_range(spark, folder):
    """Only the files of a clustered table that can hold the range are opened."""
    path = scratch_path(spark, "clustered")
    write_sorted(_table(spark, folder, "orders"), "o_orderkey", jobs.arrow_saver(path))
    return read_arrow(spark, path, between={"o_orderkey": (1000, 2500)})


@_query("SELECT * FROM lineitem")
def staged_write(spark, folder):
    """Every task of the write committed twice, and once without its end."""
    path = scratch_path(spark, "staged")
    runs = [stage_rows(_table(spark, folder, "lineitem")) for _ in range(3)]
    for run in (runs[0].where(f"{TOLD} IS NULL"), *runs[1:]):
        run.write.mode("append").parquet(path)
    return kept_rows(spark.read.parquet(path))


@_query(
    "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem"
    " GROUP BY l_returnflag, l_linestatus"
)
def group_count_job(spark, folder):
    path = _arrow(spark, _table(spark, folder, "lineitem"), "lineitem")
    return jobs.group_count_job(spark, path, ["l_returnflag", "l_linestatus"])


@_query(f"SELECT * FROM orders JOIN ({_LINES_BY_ORDER}) USING (o_orderkey)")
def join_job(spark, folder):
    path = _arrow(spark, _lines_by_order(spark, folder), "lines")
    return jobs.join_job(spark, _table(spark, folder, "orders"), path, "o_orderkey")


@_query(
    "SELECT *, substr(sha256(concat_ws('|', o_orderkey, o_orderpriority)), 1, 32)"
    " AS combined_join_column FROM orders"
)
def hash_job(spark, folder):
    return jobs.hash_job(
        spark,
        _table(spark, folder, "orders"),
        ["o_orderkey", "o_orderpriority"],
        jobs.arrow_saver(scratch_path(spark, "keyed")),
        scratch_path(spark, "keys"),
    )


@_query(_PSI)
def psi_job(spark, folder):
    return jobs.psi_job(
        spark,
        _arrow(spark, _keyed_customers(spark, folder), "keyed"),
        _arrow(spark, _urgent_keys(spark, folder), "keys"),
        HASH_COLUMN,
        "c_custkey",
        save=jobs.arrow_saver(scratch_path(spark, "psi")),
    )
