from coursemart.sinks.export import (
    ExportReport,
    escape_tsv,
    export,
    export_all,
    export_by_account_batches,
    export_by_seq_batches,
    rows_since_term_year,
    sanitize_strings,
    with_account_batch,
    with_seq_batch,
)
from coursemart.sinks.tables import write_table

__all__ = [
    "ExportReport",
    "escape_tsv",
    "export",
    "export_all",
    "export_by_account_batches",
    "export_by_seq_batches",
    "rows_since_term_year",
    "sanitize_strings",
    "with_account_batch",
    "with_seq_batch",
    "write_table",
]
