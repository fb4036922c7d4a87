"""Publishing a key column as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytables.functions.columns import column_of


def export_key_column(df: DataFrame, column: str, path: str, mode: str = "error") -> None:
    """Write one value per line, without header or quotes, as text files under ``path``.

    The tasks write, each its own file. A null, or a value with a line break, has no line of its own
    and fails the export.
    """
    text = column_of(df, column).cast("string")
    problem = F.concat(F.lit(f"{column} cannot be exported: null or line break in "), _shown(text))
    good = text.isNotNull() & ~text.contains("\n") & ~text.contains("\r")
    df.select(F.when(good, text).otherwise(F.raise_error(problem)).alias("value")).write.mode(
        mode
    ).text(path)


def _shown(text):
    return F.coalesce(F.to_json(F.struct(text.alias("value"))), F.lit("null"))
