import pytest

from tidecopy import ChunkSpec, SpecError, TableSpec

BASE = dict(load_type="merge", source_database_type="mysql", source_jdbc_connection="SRC",
            source_schema="shopdb", source_table_name="users", source_main_fields=["id"],
            source_merge_columns={"updated_at": "datetime", "created_at": "datetime", "id": "int"},
            source_freq={"data_filed": "created_at", "freq": "MS", "start_year": 2018},
            target_schema="REPLICA", target_table_name="USERS", target_main_fields=["ID"])


def test_sample_spec_builds():
    spec = TableSpec.from_config(BASE)
    assert spec.source_freq == ChunkSpec("created_at", "MS", 2018)
    assert spec.source_main_fields == ("id",)
    assert spec.target == "`REPLICA`.`USERS`"


@pytest.mark.parametrize("change, message", [
    ({"load_type": "upsert"}, "unknown load type"),
    ({"source_main_fields": "id"}, "must list column names"),
    ({"source_merge_columns": {"id": "string"}}, "has type 'string'"),
    ({"source_merge_columns": {}}, "watermark"),
    ({"target_main_fields": ["ID", "X"]}, "differ in length"),
    ({"source_database_type": "oracle"}, "no support"),
    ({"source_freq": {"data_filed": "created_at", "freq": "bh", "start_year": 2018}}, "unsupported freq"),
    ({"no_such_key": 1}, "unknown spec keys"),
    ({"source_main_field": "id"}, "as a list"),
])
def test_invalid_specs(change, message):
    conf = dict(BASE)
    conf.update(change)
    with pytest.raises((SpecError, ValueError), match=message):
        TableSpec.from_config(conf)


def test_truncate_needs_no_watermarks():
    conf = dict(BASE, load_type="truncate", source_merge_columns={})
    assert TableSpec.from_config(conf).load_type == "truncate"


def test_partial_chunk_spec_is_ignored():
    conf = dict(BASE, source_freq={"data_filed": "created_at"})
    assert TableSpec.from_config(conf).source_freq is None
