from datetime import datetime

import pytest

from loadweir.plans.configured import dataset_from_config, load_configured
from loadweir.spec import Parent, ResourceSpec, in_parent_order

AT = datetime(2024, 3, 1)

SOURCE = {
    "source": {
        "name": "mock",
        "resources": [
            {"name": "users", "params": {"q": "{name}", "limit": 5}, "primary_key": ["id"], "write_disposition": "replace"},
            {
                "name": "events",
                "primary_key": ["id"],
                "write_disposition": "merge",
                "incremental": {"cursor_field": "day", "initial_value": "2024-01-01"},
            },
        ],
    }
}
LOAD = {
    "pipeline": {
        "name": "mock_load",
        "source": {"resources": ["events", "users"], "params": {"name": "ann"}},
        "destination": {"dataset_name": "data"},
        "data_quality": {
            "fail_on_error": False,
            "checks": [{"name": "volume_check", "type": "volume", "min_rows": 100}],
        },
    }
}
DESTINATION = {
    "destination": {
        "connection": {"catalog": "dev"},
        "settings": {"table_format": "parquet", "optimize_after_write": True, "max_parallel_loads": 2},
        "naming": {"prefix": "raw_"},
        "retention": {"enabled": False, "days": 90},
    }
}


def test_destinations():
    data = dataset_from_config(DESTINATION, "data")
    assert data.address("users").location == "`dev`.`data`.`raw_users`"
    assert data.retention_days is None and data.compact_after_write
    kept = dataset_from_config({"data_retention": {"enabled": True}}, "data", "/x")
    assert (kept.retention_days, kept.root) == (7, "/x/data")


def test_load(spark, folder, rows):
    asked = {}
    days = spark.sql("SELECT * FROM VALUES (1, DATE'2023-12-01'), (2, DATE'2024-01-05') AS t(id, day)")

    def open_resource(spec, params):
        asked[spec.name] = params
        return days

    def run(at, *parameters):
        return load_configured(
            spark, SOURCE, LOAD, DESTINATION, open_resource, at, as_of=at, root=folder, parameters=parameters
        )

    audit = run(AT, {"name": "bob"})
    assert asked == {"events": {}, "users": {"q": "bob", "limit": 5}}
    got = [(r.pipeline_name, r.resource, r.success, r.rows_processed) for r in audit.collect()]
    assert got == [("mock_load", "events", True, 1), ("mock_load", "users", True, 2)]
    table = dataset_from_config(DESTINATION, "data", folder).address("events")
    assert rows(table.read(spark), "id") == [(2,)]
    run(AT.replace(hour=1), {"backfill_days": 120})
    assert rows(table.read(spark), "id") == [(1,), (2,)]
    run(AT.replace(hour=2), {"force_refresh": True})
    assert table.read(spark).count() == 2

    strict = {**LOAD["pipeline"], "data_quality": {"checks": LOAD["pipeline"]["data_quality"]["checks"]}}
    failed = load_configured(spark, SOURCE, strict, DESTINATION, open_resource, AT, root=folder)
    assert all("volume_check" in r.error for r in failed.collect())


def test_statements_after_the_load(spark, folder, rows):
    load = {
        "source": {"resources": ["users"]},
        "destination": {"dataset_name": "data"},
        "transformations": {
            "enabled": True,
            "post_load": [
                {"name": "adults", "sql": "SELECT id FROM raw_users WHERE age >= :age"},
                {"name": "adultCount", "sql": "SELECT count(*) AS n FROM adults"},
            ],
        },
    }
    people = spark.sql("SELECT * FROM VALUES (1, 17), (2, 18), (3, 70) AS t(id, age)")
    for _ in range(2):
        load_configured(
            spark, SOURCE, load, DESTINATION, lambda *_: people, AT, root=folder, parameters=({"age": 18},)
        )
    data = dataset_from_config(DESTINATION, "data", folder)
    assert rows(data.address("adults").read(spark)) == [(2,), (3,)]
    assert rows(data.address("adultCount").read(spark)) == [(2,)]


def test_unknown_resource(spark):
    load = {"source": {"resources": ["orders"]}, "destination": {"dataset_name": "d"}}
    with pytest.raises(ValueError, match="Resource 'orders' not found in source 'mock'"):
        load_configured(spark, SOURCE, load, {}, lambda *_: None, AT, root="/x")


def shop(landing):
    """Authors and their books, landed as JSON bodies; books are read for the authors just loaded."""
    return {
        "name": "library",
        "type": "landing",
        "connection": {"landing": landing},
        "resources": [
            {
                "name": "books",
                "endpoint": "/v1/books",
                "primary_key": ["isbn"],
                "parent": {"resource": "authors", "key": "author_id", "child_key": "by"},
                "schema": {
                    "columns": [
                        {"name": "isbn", "data_type": "string"},
                        {"name": "by", "data_type": "integer"},
                        {"name": "pages", "data_type": "integer", "path": "size.pages"},
                    ]
                },
            },
            {
                "name": "authors",
                "endpoint": "/v1/authors",
                "primary_key": ["author_id"],
                "write_disposition": "merge",
                "where": "country = :country",
                "params": {"country": "{land}"},
                "schema": {
                    "columns": [
                        {"name": "author_id", "data_type": "integer", "nullable": False},
                        {"name": "country", "data_type": "string"},
                    ]
                },
                "data_quality": {"checks": [{"type": "volume", "min_rows": 1}]},
            },
        ],
    }


def test_sources_are_opened_by_type_and_children_fed(spark, folder, rows):
    landing = f"{folder}/landing"
    authors = [(1, "is"), (2, "is"), (3, "no")]
    spark.createDataFrame(authors, "author_id int, country string").write.json(f"{landing}/v1/authors")
    books = ['{"isbn": "a", "by": 1, "size": {"pages": 10}}', '{"isbn": "b", "by": 3}', '{"isbn": "c", "by": 2, "size": {"pages": "x"}}']
    spark.createDataFrame([(b,) for b in books], "value string").write.text(f"{landing}/v1/books")
    load = {"name": "l", "source": {"resources": ["books", "authors"], "params": {"land": "is"}}, "destination": {"dataset_name": "d"}}

    def run(hour, settings, **values):
        return load_configured(
            spark, shop(landing), load, {"settings": settings}, None, AT.replace(hour=hour), root=f"{folder}/out", parameters=(values,)
        )

    audit = run(0, {"write_mode": "merge", "max_parallel_loads": 2})
    assert rows(audit, "resource", "success", "rows_processed", "rows_rejected") == [("authors", True, 2, 0), ("books", True, 1, 1)]
    data = dataset_from_config({}, "d", f"{folder}/out")
    assert rows(data.address("books").read(spark), "isbn", "by", "pages") == [("a", 1, 10)]
    # no author comes, so its check fails and the books are skipped
    audit = run(1, {"write_mode": "merge"}, land="xx")
    skipped = audit.filter("resource = 'books'").first()
    assert not skipped.success and "skipped: its parent 'authors' failed" in skipped.error
    assert data.address("books").read(spark).count() == 1
    with pytest.raises(ValueError, match="case_sensitive"):
        run(2, {"case_sensitive": True})
    with pytest.raises(ValueError, match="Unknown write_mode"):
        run(2, {"write_mode": "upsert"})


def test_a_fixed_schema_refuses_new_columns(spark, folder):
    source = {"name": "s", "type": "file", "connection": {"path": f"{folder}/in"}, "resources": [{"name": "t"}]}
    load = {"name": "l", "source": {"resources": ["t"]}, "destination": {"dataset_name": "d"}}
    for hour, sql, good in ((0, "SELECT 1 AS id", True), (1, "SELECT 2 AS id, 'x' AS more", False), (2, "SELECT 3 AS ID", True)):
        spark.sql(sql).write.mode("overwrite").parquet(f"{folder}/in/t")
        audit = load_configured(
            spark, source, load, {"settings": {"schema_evolution": False}}, None, AT.replace(hour=hour), root=f"{folder}/out"
        )
        assert audit.first().success is good
    unknown = {**source, "type": "kafka"}
    with pytest.raises(ValueError, match="Unsupported source type"):
        load_configured(spark, unknown, load, {}, None, AT, root=f"{folder}/out")


def test_parents_in_a_circle():
    def spec(name, parent):
        return ResourceSpec(name, parent=Parent(parent, "id", "id"))

    with pytest.raises(ValueError, match="each other's parents"):
        in_parent_order([spec("a", "b"), spec("b", "a")])
    chain = [spec("c", "b"), ResourceSpec("a"), spec("b", "a"), spec("d", "elsewhere")]
    assert [[s.name for s in step] for step in in_parent_order(chain)] == [["a", "d"], ["b"], ["c"]]
