"""Sources and sinks: JDBC, column catalogs, bulk-load text, parameterised
SQL and the target tables."""

from tidecopy.sources.catalog import (
    CATALOG_SCHEMA, catalog_from_frames, column_catalog, jdbc_catalog, tables_from_frames,
)
from tidecopy.sources.jdbc import JdbcTable, append_jdbc, jdbc_scan
from tidecopy.sources.postgres import postgres_catalog, postgres_columns, postgres_information_schema, resolve_domains
from tidecopy.sources.sql import run_sql
from tidecopy.sources.versions import LeaseHeld, LeaseLost
from tidecopy.sources.target import (
    append_target, chunk_report, chunked_load, drop_target, ensure_table, full_load, hold, merge_into_target,
    recover, struct_of, target_exists, truncate_load, with_partitions, write_swap,
)
from tidecopy.sources.text import load_tsv, write_tsv

__all__ = [
    "CATALOG_SCHEMA", "catalog_from_frames", "column_catalog", "jdbc_catalog", "tables_from_frames",
    "postgres_catalog", "postgres_columns", "postgres_information_schema", "resolve_domains",
    "JdbcTable", "append_jdbc", "jdbc_scan", "run_sql", "append_target", "chunk_report",
    "chunked_load", "drop_target", "ensure_table", "full_load", "hold", "LeaseHeld", "LeaseLost", "recover", "struct_of",
    "target_exists", "truncate_load", "write_swap", "merge_into_target", "with_partitions", "load_tsv", "write_tsv",
]
