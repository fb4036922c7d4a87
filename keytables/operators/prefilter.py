"""Leave out rows that cannot match a table of keys, before they are shuffled.

The keys go into a Bloom filter of blocks: a hash of the key names a block of eight 64-bit words, and a second hash
one bit in each of them. The filter is a table of blocks, joined as a broadcast, so its size is bounded by
the number of blocks, however many keys there are. It is built by one grouping, which Spark begins within each task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from keytables.functions.columns import named

# 300,000 blocks: some 15 million keys with one false positive in a hundred or so.
PREFILTER_MAX_BYTES = 32 * 1024 * 1024

_WORDS = 8
# What a block takes in a broadcast: its row, and its share of the hash table over them.
_BLOCK_BYTES = 112
_BLOCK = "__keytables_block"
_BITS = [f"__keytables_bits_{i}" for i in range(_WORDS)]


def may_match(
    df: DataFrame, keys: DataFrame, on: str | Sequence[str], max_bytes: int = PREFILTER_MAX_BYTES
) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys``, and some more: false positives, but no row too few.

    Key columns go by the same names in both tables; rows with a null key match nothing and are left out. Rows come
    once, however often their key is repeated. The filter takes at most ``max_bytes`` in each executor;
    the more keys there are for it, the more rows pass. No job runs here, and ``keys`` is read once for the filter.
    Keys of other types than those of ``df``, but for integers of another width, leave out null keys only.
    """
    names = [on] if isinstance(on, str) else list(on)
    blocks = max_bytes // _BLOCK_BYTES
    if not names:
        raise ValueError("may_match needs at least one key column")
    if blocks < 1:
        raise ValueError(f"max_bytes must be at least {_BLOCK_BYTES}")
    known = reduce(lambda a, b: a & b, [named(n).isNotNull() for n in names])
    key_rows = keys.select(*(named(n) for n in names))
    kinds = list(zip(df.select(*(named(n) for n in names)).schema, key_rows.schema, strict=True))
    whole = [isinstance(a.dataType, IntegralType) and isinstance(b.dataType, IntegralType) for a, b in kinds]
    if not all(w or a.dataType == b.dataType for w, (a, b) in zip(whole, kinds, strict=True)):
        return df.where(known)
    typed = [named(n).cast(LongType()) if w else named(n) for n, w in zip(names, whole, strict=True)]
    block, masks = _block(typed, blocks), _masks(typed)
    table = (
        key_rows.where(known)
        .select(block.alias(_BLOCK), *(m.alias(b) for m, b in zip(masks, _BITS, strict=True)))
        .groupBy(_BLOCK)
        .agg(*(F.bit_or(b).alias(b) for b in _BITS))
    )
    held = [F.col(b).bitwiseAND(m) == m for m, b in zip(masks, _BITS, strict=True)]
    passed = reduce(lambda a, b: a & b, held, block == F.col(_BLOCK))
    return df.where(known).join(F.broadcast(table), passed, "left_semi")


def _block(keys: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), *keys), F.lit(blocks))


def _masks(keys: list[Column]) -> list[Column]:
    """One bit for each word of a block, by six bits of the hash each."""
    spread = F.xxhash64(*keys)
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftright(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        )
        for i in range(_WORDS)
    ]
