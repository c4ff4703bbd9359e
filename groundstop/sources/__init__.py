"""Sources and sinks: parquet tables, CSV layouts, the catalog."""

from groundstop.sources.batches import append_batch, new_batches
from groundstop.sources.csv import (
    broken_rows,
    read_legacy_csv,
    read_modern_csv,
    read_registry_json,
    read_training_csv,
    whole_rows,
    write_csv,
)
from groundstop.sources.publish import publish_table
from groundstop.sources.tables import (
    append_table,
    create_if_absent,
    describe_table,
    replace_table,
    save_bucketed,
    save_slices,
    save_table,
    scan_table,
    describe_formatted,
    ensure_database,
    show_databases,
    show_tables,
)
from groundstop.sources.testdata import load_tables

__all__ = [
    "append_batch",
    "append_table",
    "broken_rows",
    "create_if_absent",
    "describe_table",
    "load_tables",
    "new_batches",
    "publish_table",
    "read_legacy_csv",
    "read_modern_csv",
    "read_registry_json",
    "read_training_csv",
    "replace_table",
    "save_bucketed",
    "save_slices",
    "save_table",
    "scan_table",
    "describe_formatted",
    "ensure_database",
    "show_databases",
    "show_tables",
    "whole_rows",
    "write_csv",
]
