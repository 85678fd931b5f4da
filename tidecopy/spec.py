"""Table specs: what to copy, from where, by which key, and how to load it.

A spec can be built from the same dictionary a replication config holds
(``TableSpec.from_config``); the checks below turn a bad config into a clear
error before any Spark job starts."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping

LOAD_TYPES = ("merge", "truncate")
SOURCE_DATABASE_TYPES = ("mysql", "postgresql")
WATERMARK_TYPES = ("int", "datetime")


class SpecError(ValueError):
    """A table spec that cannot be run."""


@dataclass(frozen=True)
class ChunkSpec:
    """First-load split: ``column`` cut at every ``freq`` boundary from Jan 1 of
    ``start_year``; the last chunk is open-ended. ``include_rest`` also loads rows
    before the first chunk or without a date; otherwise they are left out and
    the status tells how many (``excluded``)."""

    column: str
    freq: str
    start_year: int
    include_rest: bool = False

    def __post_init__(self):
        from tidecopy.functions.timeparts import parse_freq

        parse_freq(self.freq)  # raises on an unsupported alias
        if not isinstance(self.start_year, int) or self.start_year < 1:
            raise SpecError(f"start_year must be a positive int, got {self.start_year!r}")


@dataclass(frozen=True)
class TableSpec:
    load_type: str
    source_schema: str
    source_table_name: str
    target_schema: str
    target_table_name: str
    source_main_fields: tuple[str, ...] = ()
    target_main_fields: tuple[str, ...] = ()
    source_merge_columns: Mapping[str, str] = field(default_factory=dict)
    source_freq: ChunkSpec | None = None
    replace_fields_to: Mapping[str, str] = field(default_factory=dict)
    source_database_type: str = "mysql"
    source_jdbc_connection: str | None = None
    # Count check (see operators.checks.count_check)
    count_cutoff_column: str = "created_at"
    count_tolerance: int = 1000
    # Days re-read before the run date by datetime watermarks
    lookback_days: int = 3
    # Upper-case source column names in the target
    fold_case: bool = True
    # Parallel statements per JDBC read of the delta (key strides); each is one
    # source connection, so this bounds the load put on the source database.
    source_partitions: int = 4
    # Target partition columns {name: SQL expression over the target row}; each
    # must give all versions of a row the same value (a function of the key,
    # e.g. {"ID_RANGE": "floor(ID / 1000000)"}). Merges then rewrite only the
    # partitions the delta touches.
    partition_by: Mapping[str, str] = field(default_factory=dict)
    # Bucket the target by its keys into this many buckets (0: no bucketing). A
    # merge with a large delta then shuffles only the delta; the first load
    # pays one shuffle to lay the buckets out.
    bucket_count: int = 0
    # Rows of a file group (0: no groups). A merge then rewrites only the groups
    # that hold keys of the delta, found by an index of key ranges and Bloom
    # filters; the target has the technical column TC_GROUP.
    group_rows: int = 0

    def __post_init__(self):
        if self.group_rows and (self.partition_by or self.bucket_count):
            raise SpecError("group_rows goes without partition_by and bucket_count")
        if self.load_type not in LOAD_TYPES:
            raise SpecError(f"unknown load type {self.load_type!r}: use one of {', '.join(LOAD_TYPES)}")
        if self.source_database_type not in SOURCE_DATABASE_TYPES:
            raise SpecError(f"no support for a {self.source_database_type!r} source: use one of "
                            f"{', '.join(SOURCE_DATABASE_TYPES)}")
        for name in ("source_main_fields", "target_main_fields"):
            value = getattr(self, name)
            if isinstance(value, str) or not isinstance(value, (list, tuple)):
                raise SpecError(f"{name} must list column names, got {value!r}")
            object.__setattr__(self, name, tuple(value))
        if len(self.source_main_fields) != len(self.target_main_fields):
            raise SpecError("source_main_fields and target_main_fields differ in length: "
                            f"{list(self.source_main_fields)} vs {list(self.target_main_fields)}")
        if self.load_type == "merge":
            if not self.source_main_fields:
                raise SpecError("merge needs at least one key in source_main_fields")
            if not self.source_merge_columns:
                raise SpecError("merge needs source_merge_columns (watermark columns)")
        if self.bucket_count and not self.source_main_fields:
            raise SpecError("bucket_count needs key columns (source_main_fields)")
        for col, kind in dict(self.source_merge_columns).items():
            if kind not in WATERMARK_TYPES:
                raise SpecError(f"watermark {col!r} has type {kind!r}: use one of {', '.join(WATERMARK_TYPES)}")
        for name in ("source_schema", "source_table_name", "target_schema", "target_table_name"):
            if not getattr(self, name):
                raise SpecError(f"{name} is required")

    @property
    def target(self) -> str:
        return f"`{self.target_schema}`.`{self.target_table_name}`"

    @property
    def source(self) -> str:
        return f"{self.source_schema}.{self.source_table_name}"

    @classmethod
    def from_config(cls, conf: Mapping[str, Any], **overrides) -> "TableSpec":
        """Build from a config dict with the usual keys; ``source_freq`` holds
        ``data_filed`` (the config's spelling), ``freq`` and ``start_year``."""
        conf = dict(conf)
        conf.update(overrides)
        freq = conf.pop("source_freq", None) or {}
        chunk = None
        if isinstance(freq, ChunkSpec):
            chunk = freq
        elif freq.get("data_filed") and freq.get("freq") and freq.get("start_year"):
            chunk = ChunkSpec(freq["data_filed"], freq["freq"], int(freq["start_year"]), bool(freq.get("include_rest")))
        for single in ("source_main_field", "target_main_field"):
            if single in conf:
                raise SpecError(f"{single} is not read: give {single}s as a list, e.g. [{conf[single]}]")
        known = set(cls.__dataclass_fields__)
        unknown = set(conf) - known
        if unknown:
            raise SpecError(f"unknown spec keys: {sorted(unknown)}")
        required = ("load_type", "source_schema", "source_table_name", "target_schema", "target_table_name")
        args = {k: conf.get(k) for k in required}
        args.update({k: v for k, v in conf.items() if k not in required and v is not None})
        return cls(source_freq=chunk, **args)
