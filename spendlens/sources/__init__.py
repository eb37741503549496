from .dimensions import attach_dimension, dimension
from .row_ids import add_row_ids
from .store import materialize, remove, scratch_path, temporaries
from .tables import (
    append_audit, complete_columns, ensure_audit_table, read_transactions, require_columns,
    stamp, standardize, write_table,
)

__all__ = [
    "add_row_ids", "append_audit", "attach_dimension", "complete_columns", "dimension",
    "ensure_audit_table", "materialize", "read_transactions", "remove", "require_columns",
    "scratch_path", "stamp", "standardize", "temporaries", "write_table",
]
