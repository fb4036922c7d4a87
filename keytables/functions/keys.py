"""Fixed-width hash keys over one or more columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The other party derives its keys in the same way.
HASH_COLUMN = "combined_join_column"
SEPARATOR = "|"
DIGEST_BITS = 256
KEY_DIGITS = 32


def hash_key(*columns: str | Column, strict: bool = False) -> Column:
    """First 32 hex digits of the SHA-256 of the columns joined with a bar.

    Values are cast to string, so both parties must hold the same types: 1.50 is ``1.50`` as a
    decimal and ``1.5`` as a double, and timestamps with a zone print in the session's zone. Cast
    doubles to decimal or string first where the other side is not Spark.

    By default nulls vanish, so (a, null, b) and (a, b) share a key and every all-null row gets the
    key of the empty string; a bar inside a value is ambiguous too. ``strict`` marks nulls and writes
    each value's length before it, which removes both. It gives other keys, so both parties must
    use it.
    """
    if not columns:
        raise ValueError("hash_key needs at least one column")
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    if strict:
        parts = [_framed(c) for c in parts]
    return F.substring(F.sha2(F.concat_ws(SEPARATOR, *parts), DIGEST_BITS), 1, KEY_DIGITS)


def _framed(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
