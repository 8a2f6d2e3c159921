from coursemart.sources.catalog import (
    CATALOG_COLUMNS,
    CATALOG_XML_SCHEMA,
    CatalogError,
    catalog_faults,
    catalog_rows,
    parse_catalog_text,
    read_catalog_csv,
    read_catalog_xml,
    require_catalog,
    response_title,
)
from coursemart.sources.raw import LmsSource, clean_zero_dates, read_excerpt, read_raw, read_table, unreadable_values
from coursemart.sources.text import log_file_lines, read_log_lines, read_text_lines, split_lines

__all__ = [
    "CATALOG_COLUMNS",
    "CATALOG_XML_SCHEMA",
    "CatalogError",
    "LmsSource",
    "catalog_faults",
    "catalog_rows",
    "clean_zero_dates",
    "log_file_lines",
    "parse_catalog_text",
    "read_catalog_csv",
    "read_catalog_xml",
    "read_excerpt",
    "read_log_lines",
    "read_raw",
    "read_table",
    "read_text_lines",
    "require_catalog",
    "response_title",
    "split_lines",
    "unreadable_values",
]
