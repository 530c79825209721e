"""Sources and sinks."""

from .documents import read_documents, write_documents
from .drift import drift_report, read_with_drift
from .key_list import read_key_list
from .tables import (
    SchemaMismatchError,
    StrayFilesError,
    append_table,
    conform,
    current_path,
    default_format,
    publish,
    read_table,
    save_table,
    table_name,
    typed_rows,
)

__all__ = [
    "SchemaMismatchError",
    "StrayFilesError",
    "append_table",
    "conform",
    "current_path",
    "default_format",
    "drift_report",
    "publish",
    "read_documents",
    "read_key_list",
    "read_table",
    "read_with_drift",
    "save_table",
    "table_name",
    "typed_rows",
    "write_documents",
]
