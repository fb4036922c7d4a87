"""Operators: plain functions from DataFrame to DataFrame, usable with ``df.transform``."""

from keytables.operators.aggregate import count_rows, group_count
from keytables.operators.contracts import (
    KeyContractError,
    check_key,
    key_contract,
    key_violations,
)
from keytables.operators.joins import join_tables, psi_join
from keytables.operators.order import sort_table, write_sorted
from keytables.operators.prefilter import may_match
from keytables.operators.select import add_hash_column, key_filter, project, where
from keytables.operators.size import estimate_size, fits_broadcast

__all__ = [
    "KeyContractError",
    "add_hash_column",
    "check_key",
    "count_rows",
    "estimate_size",
    "fits_broadcast",
    "group_count",
    "join_tables",
    "key_contract",
    "key_filter",
    "key_violations",
    "may_match",
    "project",
    "psi_join",
    "sort_table",
    "where",
    "write_sorted",
]
