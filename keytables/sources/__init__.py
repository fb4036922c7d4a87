"""Where tables come from and go to."""

from keytables.sources.arrow_ipc import read_arrow, register, write_arrow
from keytables.sources.jdbc import (
    edge_predicates,
    even_edges,
    jdbc_column_types,
    jdbc_options,
    read_jdbc_hashed,
    read_jdbc_query,
    slice_predicates,
    write_jdbc,
)
from keytables.sources.key_file import export_key_column
from keytables.sources.scratch import (
    remove_scratch,
    scratch_path,
    scratch_scope,
    scratch_table,
    write_result,
    write_scratch,
)
from keytables.sources.staging import kept_rows, kept_sql, stage_rows

__all__ = [
    "export_key_column",
    "edge_predicates",
    "even_edges",
    "jdbc_column_types",
    "jdbc_options",
    "kept_rows",
    "kept_sql",
    "read_arrow",
    "read_jdbc_hashed",
    "read_jdbc_query",
    "register",
    "scratch_path",
    "scratch_scope",
    "slice_predicates",
    "stage_rows",
    "write_arrow",
    "write_jdbc",
    "write_result",
    "write_scratch",
]
