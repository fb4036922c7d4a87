"""Counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytables.functions.columns import columns_of
from keytables.operators.select import Conditions, where


def count_rows(df: DataFrame, conditions: Conditions = None) -> DataFrame:
    """One row, one column ``count``."""
    return where(df, conditions).agg(F.count(F.lit(1)).alias("count"))


def group_count(
    df: DataFrame, columns: Sequence[str | Column], conditions: Conditions = None
) -> DataFrame:
    """The group columns and ``count``; nulls form a group of their own.

    Each task counts its own rows before the shuffle, so a group that holds most of the rows sends
    one row per task.
    """
    if not columns:
        raise ValueError("group_count needs at least one column")
    kept = where(df, conditions)
    return kept.groupBy(*columns_of(df, columns)).agg(F.count(F.lit(1)).alias("count"))
