import pytest

from loadweir import Check, Column, Incremental, ResourceSpec, specs_from_source
from loadweir.spec import Parent

# A resource of an invented source: readings of tide gauges.
READINGS = {
    "name": "gauge_readings",
    "primary_key": ["gauge", "taken_at"],
    "write_disposition": "merge",
    "aliases": {"level_mm": "water_level"},
    "pii_fields": ["observer"],
    "incremental": {"cursor_field": "meta.takenAt", "initial_value": "2023-05-01T00:00:00Z"},
    "parent": {"resource": "gauges", "key": "id", "child_key": "gauge"},
    "schema": {
        "columns": [
            {"name": "gauge", "data_type": "integer", "nullable": False},
            {"name": "taken_at", "data_type": "timestamp", "path": "meta.takenAt"},
            {"name": "level_mm", "data_type": "float"},
            {"name": "observer", "data_type": "string"},
        ]
    },
    "data_quality": {"checks": [{"type": "range", "column": "level_mm", "min_value": -5000, "max_value": 9000}]},
}


def test_from_parsed_config():
    spec = ResourceSpec.from_dict(READINGS)
    assert spec.primary_key == ("gauge", "taken_at") and spec.pii_fields == ("observer",)
    assert [c.sql_type for c in spec.columns] == ["bigint", "timestamp", "double", "string"]
    assert [c.source for c in spec.columns][1] == "meta.takenAt"
    assert [c.type for c in spec.checks] == ["range"]
    assert spec.incremental.cursor_field == "meta.takenAt"
    assert spec.aliases == {"level_mm": "water_level"}
    assert spec.parent == Parent("gauges", "id", "gauge")


def test_source_keeps_file_order():
    specs = specs_from_source({"source": {"resources": [{"name": "b"}, {"name": "a"}]}})
    assert list(specs) == ["b", "a"]
    assert specs["b"].write_disposition == "append"


def test_source_without_resources():
    with pytest.raises(ValueError, match="at least one resource"):
        specs_from_source({"source": {"resources": []}})


def test_merge_without_key():
    with pytest.raises(ValueError, match="no primary_key"):
        ResourceSpec("r", write_disposition="merge")


def test_key_may_come_from_the_contract():
    spec = ResourceSpec(
        "r", write_disposition="merge", columns=(Column("id", "string", primary_key=True),)
    )
    assert spec.primary_key == ("id",)


def test_incremental_without_cursor():
    with pytest.raises(ValueError, match="cursor_field"):
        Incremental("", "2024-01-01")
    assert not Incremental("", "2024-01-01", enabled=False).enabled


@pytest.mark.parametrize(
    "config",
    [
        {"type": "odd"},
        {"type": "range", "column": "a"},
        {"type": "pattern", "column": "a"},
        {"type": "volume"},
        {"type": "completeness"},
        {"type": "not_null", "column": "a", "severity": "fatal"},
    ],
)
def test_bad_checks(config):
    with pytest.raises(ValueError):
        Check.from_dict(config)


def test_bad_type_and_disposition():
    with pytest.raises(ValueError, match="unknown data type"):
        Column("a", "decimal")
    with pytest.raises(ValueError, match="unknown write_disposition"):
        ResourceSpec("r", write_disposition="upsert")
