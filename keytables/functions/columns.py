"""Columns by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def column_of(df: DataFrame, column: str | Column) -> Column:
    """A column of ``df``: one that has the very name given, else what Spark makes of the name, such as a
    field of a struct."""
    if isinstance(column, Column):
        return column
    return named(column) if column in df.columns else F.col(column)


def columns_of(df: DataFrame, columns: Sequence[str | Column]) -> list[Column]:
    return [column_of(df, c) for c in columns]
