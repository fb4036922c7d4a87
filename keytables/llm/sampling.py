"""Samples drawn by a hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Of the 62 bits compared, these lowest ones of the hash come first.
FIRST_BITS, BITS = 20, 62


def drawn(rows: int, total: int, *key: Column | str) -> Column:
    """Whether a row is in a sample of about ``rows`` of ``total`` by a hash of ``key``; for any total below 2**62."""
    if total <= rows:
        return F.lit(True)
    rest = BITS - FIRST_BITS
    hashed = F.xxhash64(*key)
    high = F.shiftleft(hashed.bitwiseAND(F.lit((1 << FIRST_BITS) - 1).cast("long")), rest)
    low = F.shiftrightunsigned(hashed, FIRST_BITS).bitwiseAND(F.lit((1 << rest) - 1).cast("long"))
    return high + low < F.lit((rows << BITS) // total).cast("long")
