"""DataFrame operators of a replication: type mapping, projections, row
selection, merge and checks."""

from tidecopy.operators.checks import (
    CountCheckError, condition_met, count_check, has_rows, row_count,
)
from tidecopy.operators.incremental import (
    chunk_bounds, chunk_grid, chunk_list, in_chunk, incremental_filter, key_max, watermark_predicate,
)
from tidecopy.operators.merge import DuplicateKeyError, duplicate_keys, merge_upsert
from tidecopy.operators.project import (
    catalog_of, column_pairs, conform, replace_fields,
)
from tidecopy.operators.typemap import (
    POSTGRES_RULES, TYPE_RULES, MappedColumn, ddl_report, map_types, mapped_columns, unknown_types,
)

__all__ = [
    "CountCheckError", "condition_met", "count_check", "has_rows", "row_count",
    "chunk_bounds", "chunk_grid", "chunk_list", "in_chunk", "incremental_filter", "key_max",
    "watermark_predicate", "DuplicateKeyError", "duplicate_keys", "merge_upsert",
    "catalog_of", "column_pairs", "conform", "replace_fields",
    "POSTGRES_RULES", "TYPE_RULES", "MappedColumn", "ddl_report", "map_types", "mapped_columns", "unknown_types",
]
