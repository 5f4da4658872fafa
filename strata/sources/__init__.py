"""Sources: catalog tables, SQL queries, files, records."""

from strata.sources.tables import (
    enforce_schema, from_records, is_table_reference, read_csv, read_input, read_table,
    register_tables, table_path,
)

__all__ = ["enforce_schema", "from_records", "is_table_reference", "read_csv", "read_input",
           "read_table", "register_tables", "table_path"]
