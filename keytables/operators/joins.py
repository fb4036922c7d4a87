"""Equi-joins of two tables on one or more key columns, built to stand hot keys.

By default the join is Spark's own, which broadcasts a side that is small by its estimate or turns out
so at run time. No job runs while it is put together, but for one case: of Arrow files Spark knows no
size, so where the files of the lighter side are small by their listed sizes they are counted and broadcast.

Which side of a skewed join can be divided depends on the join type: adaptive execution splits a hot
key on either side of an inner join, but only on the preserved side of a left or right join and on
neither side of a full one. For such keys there is the ``shuffle`` form: ``left``, ``right`` and ``outer`` are
put together from an inner join and the unmatched rows of each preserved side. The unmatched rows
come from an anti join against the *distinct* keys of the other side, which are reduced within each
task before they are shuffled. Every part can then be split. The ``skew`` form does the same, but puts a full join
together as one join: it takes a sketch of both sides' keys first, and deals out hot ones over several tasks.

The broadcast and shuffle forms read an input more than once, so inputs must give the same rows each
time. Write one that does not (``rand()``, ``limit`` without order) to a table first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from keytables.functions.columns import named as _col
from keytables.operators.order import sort_table
from keytables.operators.prefilter import may_match
from keytables.operators.size import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_ROWS,
    fits_broadcast,
    listed_as_small,
    plan_bytes,
    weight,
)

JOIN_TYPES = ("inner", "left", "right", "outer")
STRATEGIES = ("auto", "broadcast", "shuffle", "skew")

_SALT_L, _SALT_R = "__keytables_salt_l", "__keytables_salt_r"
_FAN_L, _FAN_R = "__keytables_fan_l", "__keytables_fan_r"
_COPY_L, _COPY_R = "__keytables_copy_l", "__keytables_copy_r"
# A full join's sketch names at most so many hot keys of a side, and follows so many.
_NAMED_KEYS = 1_024
_FOLLOWED_KEYS = 16 * _NAMED_KEYS
_FINER = 8
# A side is broadcast if the other one is so many times as heavy; else shuffling both costs about as little.
_LIGHTER = 2


def join_tables(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    strategy: str = "auto",
    suffix: str | None = None,
    num_partitions: int | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    prefilter_bytes: int = 0,
) -> DataFrame:
    """Join on all columns of ``on``; the keys come first, once. Null keys match nothing.

    ``strategy``:

    - ``auto``: the plain join, left to Spark. Both sides are weighed, Arrow files by their listed sizes and others by
      Spark's estimate. Only if the lighter one is of Arrow files within ``broadcast_max_bytes`` and at most
      half as heavy as the other, it is counted and, if it fits the limits, broadcast: a right side for every
      join type, a left one for ``inner`` and ``right``. ``broadcast_max_rows=0`` leaves this out.
    - ``broadcast``: a right side that its files or Spark's estimate bound by ``broadcast_max_bytes`` is
      measured and broadcast. Beyond the limits it takes the shuffle form, and nothing is broadcast.
    - ``shuffle``: both sides are shuffled on the keys and no size is measured. ``num_partitions`` pins
      the partition count; adaptive execution does not touch a pinned layout, so the commonest keys of
      each side are counted, and hot ones salted.
    - ``skew``: as ``shuffle``, but a full join without ``num_partitions`` reads each side once, after a job that takes a
      sketch of the frequent keys and, if there are hot ones, a job that counts those (:func:`_full_join`).

    A column name that both sides hold besides the keys is an error, unless ``suffix`` is given for
    the right side's column.

    ``prefilter_bytes`` is for keys too many to broadcast that few rows match: an ``inner`` or ``right`` join that does not
    broadcast a side by itself leaves out left rows by :func:`may_match` before they are shuffled, a ``left`` join
    right rows. Its filter takes at most so many bytes; the side it is made of is read once more. A full
    join keeps all rows and takes none.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        raise ValueError("join_tables needs at least one key column")
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {', '.join(JOIN_TYPES)}, not {how!r}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}, not {strategy!r}")
    fold = _folding(left)
    keys = [_found(left, k, fold, "left") for k in keys]
    spelled = {_found(right, k, fold, "right"): k for k in keys}
    given = right
    right = _without_clashes(left, right.withColumnsRenamed(spelled), keys, suffix, fold)

    limits = (broadcast_max_rows, broadcast_max_bytes)
    bounded = strategy == "broadcast" and plan_bytes(right) <= broadcast_max_bytes
    if strategy == "broadcast" and (
        listed_as_small(given, right, *limits) or (bounded and fits_broadcast(right, *limits))
    ):
        return _broadcast_join(left, right, keys, how)
    if strategy == "auto":
        weights = (weight(left), weight(given))
        if _LIGHTER * weights[1] <= weights[0] and listed_as_small(given, right, *limits):
            return _broadcast_join(left, right, keys, how)
        if _LIGHTER * weights[0] <= weights[1] and how in ("inner", "right") and listed_as_small(left, None, *limits):
            return F.broadcast(left).join(right, on=keys, how=how)
    if prefilter_bytes > 0 and how in ("inner", "right"):
        left = may_match(left, right, keys, prefilter_bytes)
    elif prefilter_bytes > 0 and how == "left":
        right = may_match(right, left, keys, prefilter_bytes)
    if strategy == "auto":
        return left.join(right, on=keys, how=how)
    if strategy == "skew" and how == "outer" and num_partitions is None:
        return _full_join(left, right, keys)
    return _shuffle_join(left, right, keys, how, num_partitions)


def psi_join(
    table: DataFrame,
    keys: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    order_by: str | Sequence[str] | None = None,
    strategy: str = "auto",
    suffix: str | None = None,
    num_partitions: int | None = None,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    prefilter_bytes: int = 0,
) -> DataFrame:
    """Join a keyed table with a returned set of keys and sort the result on ``order_by``, ascending.

    The join is :func:`join_tables` on all columns of ``on``. Without ``order_by`` the rows come
    unsorted, for a caller that sorts them later on.
    """
    joined = join_tables(
        table,
        keys,
        on,
        how,
        strategy,
        suffix,
        num_partitions,
        broadcast_max_rows,
        broadcast_max_bytes,
        prefilter_bytes,
    )
    return joined if order_by is None else sort_table(joined, order_by)


def _folding(df: DataFrame) -> Callable[[str], str]:
    """How the session compares column names."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return str if exact else str.lower


def _found(df: DataFrame, name: str, fold: Callable[[str], str], side: str) -> str:
    """The table's own spelling of a column."""
    found = [c for c in df.columns if fold(c) == fold(name)]
    if len(found) != 1:
        raise ValueError(f"the {side} table has {len(found) or 'no'} column {name}")
    return found[0]


def _without_clashes(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    suffix: str | None,
    fold: Callable[[str], str],
) -> DataFrame:
    taken = {fold(c) for c in left.columns}
    clashes = [c for c in right.columns if fold(c) in taken and c not in keys]
    if not clashes:
        return right
    if not suffix:
        raise ValueError(f"both tables hold {', '.join(clashes)}; give a suffix for the right side's")
    renamed = right.withColumnsRenamed({c: c + suffix for c in clashes})
    return _without_clashes(left, renamed, keys, None, fold)


def _cols(names: Sequence[str]) -> list[Column]:
    return [_col(n) for n in names]


def _broadcast_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``right`` is known to be small. Spark builds the right side of inner and left joins only, so
    the unmatched right rows of the other types are found apart. The matched keys are a subset of
    the right side's, hence small too, and ``left`` is never shuffled."""
    if how in ("inner", "left"):
        return left.join(F.broadcast(right), on=keys, how=how)
    joined = left.join(F.broadcast(right), on=keys, how="inner" if how == "right" else "left")
    matched = (
        left.select(*_cols(keys))
        .join(F.broadcast(right.select(*_cols(keys))), on=keys, how="left_semi")
        .distinct()
    )
    alone = right.join(F.broadcast(matched), on=keys, how="left_anti")
    return _as_joined(joined.unionByName(alone, allowMissingColumns=True), left, right, keys, how)


def _shuffle_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, num_partitions: int | None
) -> DataFrame:
    # The same null filter on every use of a side lets Spark shuffle that side once.
    left_keyed, right_keyed = (
        df.where(reduce(lambda a, b: a & b, [_col(k).isNotNull() for k in keys]))
        for df in (left, right)
    )
    if num_partitions is None:
        parts = [left_keyed.join(right_keyed.hint("merge"), on=keys, how="inner")]
    else:
        parts = [_salted_join(left_keyed, right_keyed, keys, num_partitions)]
    if how in ("left", "outer"):
        parts += _unmatched(left, left_keyed, right_keyed, keys)
    if how in ("right", "outer"):
        parts += _unmatched(right, right_keyed, left_keyed, keys)
    if how == "inner":
        return parts[0]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _as_joined(whole, left, right, keys, how)


def _unmatched(
    whole: DataFrame, keyed: DataFrame, other: DataFrame, keys: list[str]
) -> list[DataFrame]:
    """Rows of ``whole`` whose key is not in ``other``, and those with a null key."""
    alone = keyed.join(other.select(*_cols(keys)).distinct().hint("merge"), on=keys, how="left_anti")
    return [alone, whole.where(reduce(lambda a, b: a | b, [_col(k).isNull() for k in keys]))]


def _as_joined(
    df: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], how: str
) -> DataFrame:
    """Column order and key types of a plain join."""
    names = keys + [c for side in (left, right) for c in side.columns if c not in keys]
    kept = {"left": left, "right": right}.get(how)
    if kept is None:
        return df.select(*_cols(names))
    return df.select(*(_typed(df, kept, c) if c in keys else _col(c) for c in names))


def _typed(df: DataFrame, like: DataFrame, name: str) -> Column:
    wanted = like.schema[name].dataType
    return _col(name) if df.schema[name].dataType == wanted else _col(name).cast(wanted).alias(name)


def _salted_join(left: DataFrame, right: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Inner join in ``n`` partitions, hot keys spread over several of them. Spark makes as many as
    ``spark.sql.shuffle.partitions`` where that is more.

    A key is hot on a side where it has more rows than one even partition, so each side has fewer
    than ``n`` of them. One grouping of both sides' keys finds them. Without any, both sides are simply dealt
    out by key. A hot key's rows get a salt from what they hold and the task they come from, stable
    when a lost task runs again, and the other side's rows of that key are repeated once per salt.
    """
    hot = _hot_keys(left, right, keys, n)
    salted_keys = keys
    if hot is not None:
        left = _salt(left, hot, keys, own=(_SALT_L, _FAN_L), other=(_SALT_R, _FAN_R))
        right = _salt(right, hot, keys, own=(_SALT_R, _FAN_R), other=(_SALT_L, _FAN_L))
        salted_keys = [*keys, _SALT_L, _SALT_R]
    left, right = (df.repartition(n, *_cols(salted_keys)) for df in (left, right))
    return left.join(right.hint("merge"), on=salted_keys, how="inner").drop(_SALT_L, _SALT_R)


def _full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The plain full join, unless a key has more rows of a side than an even partition.

    Then it is one full join still, on the keys and two salts, and each side is read once in it. A hot key's rows of a
    side are dealt out, and the other side's rows of that key repeated once per share. A repeated row without a
    partner in one share has one in another, as the hot key exists, so these are left out. Null keys meet nothing,
    so their rows are dealt out freely.
    """
    n = min(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), _NAMED_KEYS)
    hot = _hot_by_sketch(left, right, keys, n)
    if hot is None:
        return left.join(right, on=keys, how="outer")
    left = _salt(left, hot, keys, (_SALT_L, _FAN_L), (_SALT_R, _FAN_R), copied=_COPY_L, nulls=n * _FINER)
    right = _salt(right, hot, keys, (_SALT_R, _FAN_R), (_SALT_L, _FAN_L), copied=_COPY_R, nulls=n * _FINER)
    joined = left.join(right.hint("merge"), on=[*keys, _SALT_L, _SALT_R], how="outer")
    # A side's mark is null where that side has no row.
    spare = (_col(_COPY_L) & _col(_COPY_R).isNull()) | (_col(_COPY_R) & _col(_COPY_L).isNull())
    return joined.where(~F.coalesce(spare, F.lit(False))).drop(_SALT_L, _SALT_R, _COPY_L, _COPY_R)


def _hot_by_sketch(left: DataFrame, right: DataFrame, keys: list[str], n: int) -> DataFrame | None:
    """The keys of which a side has more than an ``n``-th of its rows, as :func:`_hot_keys` gives them. None if there
    are none, nor a null key's; empty if only null keys are hot.

    One job takes a sketch of frequent hashes of both sides' keys. Only if it names one, a second job counts the keys with
    such a hash, so that no two keys are taken for one. Both read the key columns alone.
    """
    joined = left.select(*_cols(keys)).join(right.select(*_cols(keys)), on=keys, how="outer").schema
    typed = [_col(k).cast(joined[k].dataType).alias(k) for k in keys]
    some_null = reduce(lambda a, b: a | b, [_col(k).isNull() for k in keys])
    hashed = [
        df.select(*typed).select(*_cols(keys), F.when(~some_null, F.xxhash64(*_cols(keys))).alias("hash"), F.lit(side).alias("side"))
        for side, df in enumerate((left, right))
    ]
    top = F.expr(f"approx_top_k(hash, {_NAMED_KEYS}, {_FOLLOWED_KEYS})")
    both = hashed[0].unionByName(hashed[1])
    sketches = both.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("hash").alias("keyed"), top.alias("top")
    ).collect()
    totals = {s["side"]: s["n_rows"] for s in sketches}
    share = [max(totals.get(side, 0) // n, 1) for side in (0, 1)]
    nulls = any(s["n_rows"] - s["keyed"] > share[s["side"]] for s in sketches)
    named = {t["item"] for s in sketches for t in s["top"] if t["item"] is not None and t["count"] > share[s["side"]]}
    if not named:
        return _fans([], joined, keys, share, left) if nulls else None
    few = F.broadcast(left.sparkSession.createDataFrame([(h,) for h in sorted(named)], "hash long"))
    counts = (
        both.join(few, on="hash", how="left_semi")
        .groupBy(*_cols(keys))
        .agg(*(F.count(F.when(F.col("side") == side, 1)).alias(f) for side, f in enumerate((_FAN_L, _FAN_R))))
    )
    rows = counts.where((F.col(_FAN_L) > share[0]) | (F.col(_FAN_R) > share[1])).collect()
    return _fans(rows, joined, keys, share, left) if rows or nulls else None


def _hot_keys(left: DataFrame, right: DataFrame, keys: list[str], n: int) -> DataFrame | None:
    """The hot keys of either side, fewer than ``2 * n``, with how many shares each side's rows are to have.

    Spark alone tells keys apart, as it does in the join: NaN is one key, and so are -0.0 and 0.0, also within arrays
    and structs. No key of either side is null.
    """
    joined = left.select(*_cols(keys)).join(right.select(*_cols(keys)), on=keys, how="outer").schema
    sides = [
        df.select(
            *(_col(k).cast(joined[k].dataType).alias(k) for k in keys),
            F.lit(int(side == 0)).cast("long").alias(_FAN_L),
            F.lit(int(side == 1)).cast("long").alias(_FAN_R),
        )
        for side, df in enumerate((left, right))
    ]
    both = sides[0].unionByName(sides[1])
    totals = both.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in (_FAN_L, _FAN_R))).first()
    share = [max(total // n, 1) for total in totals]
    counts = both.groupBy(*_cols(keys)).agg(*(F.sum(c).alias(c) for c in (_FAN_L, _FAN_R)))
    rows = counts.where((F.col(_FAN_L) > share[0]) | (F.col(_FAN_R) > share[1])).collect()
    return _fans(rows, joined, keys, share, left) if rows else None


def _fans(
    rows: Sequence[tuple], joined: StructType, keys: list[str], share: Sequence[int], left: DataFrame
) -> DataFrame:
    """A table of hot keys, each with the number of shares of either side's rows; ``rows`` are the key and both counts."""
    fanned = []
    for *key, count_l, count_r in rows:
        fans = [-(-c // s) if c > s else 1 for c, s in zip((count_l, count_r), share, strict=True)]
        # Finer than the shares, or chance would put two salts too many into one partition; where both
        # sides are hot, rows are repeated on both, so there it stays at the shares.
        fanned.append((*key, *(f * _FINER if f > 1 and min(fans) == 1 else f for f in fans)))
    fields = [StructField(k, joined[k].dataType) for k in keys]
    schema = StructType([*fields, StructField(_FAN_L, IntegerType()), StructField(_FAN_R, IntegerType())])
    return left.sparkSession.createDataFrame(fanned, schema)


def _salt(
    df: DataFrame,
    hot: DataFrame,
    keys: list[str],
    own: tuple[str, str],
    other: tuple[str, str],
    copied: str | None = None,
    nulls: int = 1,
) -> DataFrame:
    """``df`` with its own and the other side's salt; ``copied`` tells rows that may be there more than once, and rows
    with a null key get one of ``nulls`` salts."""
    (own_salt, own_fan), (other_salt, other_fan) = own, other
    # Maps have no hash in Spark; the rest of the row has to do then.
    held = [_col(f.name) for f in df.schema if f.name not in keys and "map<" not in f.dataType.simpleString()]
    spread = F.xxhash64(*held, F.spark_partition_id())
    some_null = reduce(lambda a, b: a | b, [_col(k).isNull() for k in keys])
    fanned = df.withColumn(own_salt, spread).join(F.broadcast(hot), on=keys, how="left")
    if copied:
        fanned = fanned.withColumn(copied, F.coalesce(F.col(other_fan) > 1, F.lit(False)))
    return (
        fanned.withColumn(
            own_salt, F.pmod(_col(own_salt), F.when(some_null, nulls).otherwise(F.coalesce(F.col(own_fan), F.lit(1))))
        )
        .withColumn(
            other_salt,
            F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other_fan), F.lit(1)).cast("long") - 1)),
        )
        .drop(own_fan, other_fan)
    )
