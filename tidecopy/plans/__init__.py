"""Whole replications: one table, or many at once."""

from tidecopy.plans.replicate import (
    STATUS_SCHEMA, jobs_from_configs, replicate_all, replicate_table, spec_columns,
)

__all__ = ["STATUS_SCHEMA", "jobs_from_configs", "replicate_all", "replicate_table", "spec_columns"]
