"""The primary-key rule: a key column holds no null and no value twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keytables.functions.columns import columns_of, named


class KeyContractError(ValueError):
    """The key column holds nulls or repeated values."""


_BROKEN = "keytables: null or repeated key"
_PLACE = "__keytables_place"


def _groups(df: DataFrame, key: str | Sequence[str]) -> tuple[list[str], DataFrame]:
    names = [key] if isinstance(key, str) else list(key)
    groups = df.groupBy(*columns_of(df, names)).agg(F.count(F.lit(1)).alias("count"))
    return groups.columns[:-1], groups


def _has_null(names: Sequence[str]):
    test = F.lit(False)
    for name in names:
        test = test | named(name).isNull()
    return test


def key_contract(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_null`` (a null in any key column) and ``n_distinct`` non-null keys.

    Only the key columns are read. Rows are counted per key within each task before the shuffle.
    """
    names, groups = _groups(df, key)
    null = _has_null(names)
    return groups.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(null, F.col("count")).otherwise(0)), F.lit(0)).alias("n_null"),
        F.count(F.when(~null, 1)).alias("n_distinct"),
    )


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The keys that are null or repeated, with their ``count``."""
    names, groups = _groups(df, key)
    return groups.where((F.col("count") > 1) | _has_null(names))


def check_key(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise :class:`KeyContractError` unless ``key`` is unique and never null."""
    found = key_contract(df, key).first()
    if found.n_null or found.n_distinct != found.n_rows:
        repeats = found.n_rows - found.n_null - found.n_distinct
        raise KeyContractError(
            f"{key} is no primary key: {found.n_null} null and {repeats} repeated of {found.n_rows} rows"
        )


def checked_in_order(ranged: DataFrame, key: str) -> DataFrame:
    """``ranged``, which is dealt out in ranges of ``key``, sorted on it within each; reading it fails at a null key and at
    the second row of a repeated one.

    Rows of one key are in one range, so the rule is checked in the sorted stream, without another shuffle.
    """
    by_key = Window.partitionBy(named(key)).orderBy(named(key))
    broken = named(key).isNull() | (F.col(_PLACE) > 1)
    held = F.when(broken, F.raise_error(F.lit(_BROKEN)).cast("boolean")).otherwise(F.lit(True))
    return ranged.withColumn(_PLACE, F.row_number().over(by_key)).where(held).drop(_PLACE)


def says_broken(error: PySparkException) -> bool:
    """Whether a job failed by :func:`checked_in_order`."""
    return _BROKEN in str(error)
