"""Parameterised SQL (S14): named parameters are bound, never spliced into the
text; table names go through ``IDENTIFIER(:name)``."""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, statements: str | Sequence[str],
            params: Mapping[str, Any] | None = None) -> DataFrame:
    """Run one statement or a list in order; returns the last result."""
    if isinstance(statements, str):
        statements = [statements]
    result = None
    for text in statements:
        result = spark.sql(text, args=dict(params) if params else None)
    if result is None:
        raise ValueError("no SQL statement given")
    return result
