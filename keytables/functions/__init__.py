"""Column functions."""

from keytables.functions.keys import HASH_COLUMN, hash_key

__all__ = ["HASH_COLUMN", "hash_key"]
