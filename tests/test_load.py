import json
from contextlib import contextmanager
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadweir import Check, Column, Incremental, ResourceSpec
from loadweir.operators.quality import QualityError
from loadweir.plans import load as loads
from loadweir.plans.load import LoadOptions, load_frame, load_resource, load_resources
from loadweir.plans.state import derive_load_id, high_water
from loadweir.sinks.target import Dataset

AT = datetime(2024, 3, 1)

CHANNELS = ResourceSpec.from_dict(
    {
        "name": "channelStats",
        "primary_key": ["id"],
        "write_disposition": "merge",
        "incremental": {"cursor_field": "snippet.publishedAt", "initial_value": "2024-01-01T00:00:00Z"},
        "schema": {
            "columns": [
                {"name": "id", "data_type": "string", "nullable": False},
                {"name": "title", "data_type": "string", "path": "snippet.title"},
                {"name": "view_count", "data_type": "integer", "path": "statistics.viewCount"},
                {"name": "published_at", "data_type": "timestamp", "nullable": False, "path": "snippet.publishedAt"},
                {"name": "_extracted_at", "data_type": "timestamp", "nullable": False},
            ]
        },
        "data_quality": {
            "checks": [
                {"type": "not_null", "columns": ["id", "published_at"]},
                {"type": "positive", "columns": ["view_count"], "severity": "warning"},
                {"type": "unique", "columns": ["id"]},
                {"type": "freshness", "column": "_extracted_at", "max_age_hours": 12},
            ]
        },
        "pii_fields": ["title"],
        "aliases": {"view_count": "totalViews"},
    }
)


def channels(spark, *records):
    """Landed bodies as a reader would deliver them: nested, all text."""
    schema = "id string, snippet struct<title string, publishedAt string>, statistics struct<viewCount string>"
    return spark.createDataFrame([(i, (t, p), (v,)) for i, t, p, v in records], schema)


@pytest.fixture(params=["root", "schema"])
def dataset(request, folder):
    if request.param == "root":
        return Dataset(root=folder, prefix="raw_")
    return Dataset(schema=request.getfixturevalue("schema"), prefix="raw_")


def book(spark, dataset, name):
    return dataset.bookkeeping(name).read(spark)


def test_increments_merge_and_advance(spark, dataset, rows):
    first = channels(
        spark,
        ("a", "A", "2023-06-01T00:00:00Z", "1"),
        ("b", "B", "2024-01-05T00:00:00Z", "2"),
        ("c", "C", "2024-01-06T00:00:00Z", "3"),
    )
    result = load_resource(spark, CHANNELS, first, dataset, AT, as_of=AT)
    assert (result["success"], result["rows_processed"], result["rows_rejected"]) == (True, 2, 0)
    assert high_water(spark, dataset, "channelStats") == "2024-01-06T00:00:00Z"

    second = channels(
        spark,
        ("b", "B2", "2024-02-01T00:00:00Z", "20"),
        ("c", "C", "2024-01-06T00:00:00Z", "3"),
        ("d", "D", "2024-02-02T00:00:00Z", "4"),
    )
    later = AT + timedelta(hours=1)
    load_resource(spark, CHANNELS, second, dataset, later, as_of=later)
    stored = dataset.address("channelStats").read(spark)
    names = {"id", "title", "published_at", "total_views", "_load_id", "_extracted_at"}
    assert set(stored.columns) == names
    assert rows(stored, "id", "total_views") == [("b", 20), ("c", 3), ("d", 4)]
    assert all(len(r.title) == 64 for r in stored.collect())

    again = load_resource(spark, CHANNELS, second, dataset, later, as_of=later)
    assert again["rows_processed"] == 0
    stored = dataset.address("channelStats").read(spark)
    assert rows(stored, "id") == [("b",), ("c",), ("d",)]
    # A load that brings nothing is as fresh as what is stored.
    stale = later + timedelta(hours=13)
    with pytest.raises(QualityError, match="freshness"):
        load_resource(spark, CHANNELS, second, dataset, stale, as_of=stale)
    audit = book(spark, dataset, "loads")
    assert sorted((r.rows_processed, r.success) for r in audit.collect()) == [
        (0, False), (0, True), (2, True), (2, True)
    ]


def test_rejects_are_kept_whole_and_protected(spark, folder):
    dataset = Dataset(root=folder)
    batch = channels(
        spark,
        (None, "A", "2024-01-05T00:00:00Z", "1"),
        ("b", "B", None, "1"),
        ("c", "C", "2024-01-05T00:00:00Z", "many"),
        ("d", "D", "2024-01-06T00:00:00Z", "1"),
    )
    result = load_resource(spark, CHANNELS, batch, dataset, AT, as_of=AT)
    assert (result["rows_processed"], result["rows_rejected"]) == (1, 3)
    rejects = {tuple(r.reasons): json.loads(r.raw) for r in book(spark, dataset, "rejects").collect()}
    assert rejects[("id: null",)] == {"view_count": "1", "published_at": "2024-01-05T00:00:00Z"}
    assert rejects[("view_count: not a valid integer",)]["view_count"] == "many"
    assert rejects[("published_at: null", "snippet.publishedAt: no cursor")]["id"] == "b"
    assert not any("title" in raw for raw in rejects.values())


def test_a_load_reads_only_what_its_contract_names(spark, folder):
    spark.sql("SELECT '1' AS id, 2 AS n, 'wide' AS other, 'secret' AS mail").write.parquet(folder)
    spec = ResourceSpec("t", columns=(Column("id", "integer"), Column("n", "integer")))
    judged = loads.judge(spark.read.parquet(folder), spec)
    assert "ReadSchema: struct<id:string,n:int>" in judged._jdf.queryExecution().executedPlan().toString()


def test_gate_aborts_before_anything_is_written(spark, folder):
    dataset = Dataset(root=folder)
    twice = channels(
        spark, ("a", "A", "2024-01-05T00:00:00Z", "1"), ("a", "A", "2024-01-06T00:00:00Z", "2")
    )
    with pytest.raises(QualityError, match="unique:id"):
        load_resource(spark, CHANNELS, twice, dataset, AT, as_of=AT)
    assert not dataset.address("channelStats").exists(spark)
    assert high_water(spark, dataset, "channelStats") is None
    row = book(spark, dataset, "loads").first()
    assert not row.success and "unique:id" in row.error

    warned = load_resource(
        spark, CHANNELS, twice, dataset, AT, as_of=AT, options=LoadOptions(fail_on_error=False)
    )
    assert warned["success"]
    assert dataset.address("channelStats").read(spark).first().total_views == 2


def test_quarantine_diverts_rows(spark, folder):
    dataset = Dataset(root=folder)
    spec = ResourceSpec(
        "t",
        columns=(Column("id", "integer"), Column("n", "integer")),
        checks=(Check("positive", column="n"), Check("not_null", column="id", severity="warning")),
    )
    df = spark.sql("SELECT * FROM VALUES (1, 5), (2, -5), (NULL, 1) AS t(id, n)")
    result = load_resource(spark, spec, df, dataset, AT, options=LoadOptions(quarantine=True))
    assert (result["rows_processed"], result["rows_rejected"]) == (2, 1)
    reject = book(spark, dataset, "rejects").first()
    assert reject.reasons == ["check positive:n"] and json.loads(reject.raw) == {"id": 2, "n": -5}


def test_append_replay_adds_nothing(spark, dataset):
    spec = ResourceSpec("commits", primary_key=("sha",))
    df = spark.sql("SELECT * FROM VALUES ('x'), ('x') AS t(sha)")
    counts = [load_resource(spark, spec, df, dataset, AT)["rows_processed"] for _ in range(2)]
    assert counts == [2, 0]
    # Duplicates stay although there is a key; the replay has the same load id.
    assert dataset.address("commits").read(spark).count() == 2
    load_resource(spark, spec, df, dataset, AT + timedelta(hours=1))
    assert dataset.address("commits").read(spark).count() == 4


def test_replays_of_partitioned_appends(spark, dataset):
    data = Dataset(root=dataset.root, schema=dataset.schema, partition_by=["_extracted_at"])
    spec, df = ResourceSpec("commits"), spark.range(4)
    for at in (AT, AT, AT + timedelta(days=1), AT + timedelta(days=1)):
        load_resource(spark, spec, df, data, at)
    assert data.address("commits").read(spark).count() == 8
    # An id of the caller's own is looked for in all of the table.
    for at in (AT + timedelta(days=2), AT + timedelta(days=3)):
        load_resource(spark, spec, df, data, at, load_id="mine")
    assert data.address("commits").read(spark).count() == 12


def test_a_stop_before_the_cursor_is_absorbed(spark, folder, rows, monkeypatch):
    dataset = Dataset(root=folder)
    batch = channels(spark, ("a", "A", "2024-01-05T00:00:00Z", "1"))

    def stop(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(loads, "save_cursor", stop)
        with pytest.raises(RuntimeError, match="driver lost"):
            load_resource(spark, CHANNELS, batch, dataset, AT, as_of=AT)
    assert high_water(spark, dataset, "channelStats") is None
    load_resource(spark, CHANNELS, batch, dataset, AT, as_of=AT)
    assert rows(dataset.address("channelStats").read(spark), "id") == [("a",)]


def test_full_refresh_backfill_and_disabled_cursor(spark, folder, rows):
    dataset = Dataset(root=folder)
    spec = ResourceSpec(
        "e", ("id",), "merge", incremental=Incremental("ts", "2024-01-01 00:00:00")
    )
    df = spark.sql(
        "SELECT id, CAST(ts AS TIMESTAMP) AS ts FROM VALUES (1, '2023-12-01'), (2, '2024-01-10'), "
        "(3, '2024-01-20') AS t(id, ts)"
    )
    load_resource(spark, spec, df, dataset, AT)
    target = dataset.address("e")
    assert rows(target.read(spark), "id") == [(2,), (3,)]
    state = high_water(spark, dataset, "e")

    fill = LoadOptions(backfill_days=60)
    load_resource(spark, spec, df, dataset, AT + timedelta(1), as_of=datetime(2024, 1, 15), options=fill)
    assert rows(target.read(spark), "id") == [(1,), (2,), (3,)]
    assert high_water(spark, dataset, "e") == state

    shrunk = df.filter("id < 3")
    load_resource(
        spark, spec, shrunk, dataset, AT + timedelta(2), options=LoadOptions(full_refresh=True)
    )
    assert rows(target.read(spark), "id") == [(1,), (2,)]
    assert high_water(spark, dataset, "e") == "2024-01-10 00:00:00"


def test_partitioned_dataset_with_retention(spark, dataset, rows):
    data = Dataset(
        root=dataset.root, schema=dataset.schema, partition_by=["_extracted_at"], retention_days=7
    )
    spec = ResourceSpec("posts", ("id",), "merge")
    old = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(id, v)")
    new = spark.sql("SELECT * FROM VALUES (2, 'c'), (3, 'd') AS t(id, v)")
    load_resource(spark, spec, old, data, AT, as_of=AT)
    load_resource(spark, spec, new, data, AT + timedelta(days=3), as_of=AT + timedelta(days=3))
    target = data.address("posts")
    assert target.partition_columns(spark) == ["_extracted_at_date"]
    assert rows(target.read(spark), "id", "v") == [(1, "a"), (2, "c"), (3, "d")]
    later = AT + timedelta(days=9)
    load_resource(spark, spec, new.limit(0), data, later, as_of=later)
    assert rows(target.read(spark), "id") == [(2,), (3,)]


@pytest.mark.parametrize("stage", [True, False])
def test_json_columns_and_extras(spark, folder, stage):
    dataset = Dataset(root=folder)
    spec = ResourceSpec("t", columns=(Column("id", "integer"), Column("payload", "json")), extra_columns="keep")
    df = spark.sql("SELECT '1' AS id, '{\"a\": 1}' AS payload, 5 AS other")
    load_resource(spark, spec, df, dataset, AT, options=LoadOptions(stage=stage))
    row = dataset.address("t").read(spark).selectExpr("id", "to_json(payload)", "other").first()
    assert tuple(row) == (1, '{"a":1}', 5)


def test_several_resources_report_their_failures(spark, dataset):
    specs = [ResourceSpec("users"), ResourceSpec("posts", checks=(Check("volume", min_rows=9),))]
    sources = {"users": spark.range(3), "posts": spark.range(2)}
    audit = load_resources(spark, specs, sources, dataset, AT, pipeline="mock", parallel_loads=2)
    got = {r.resource: (r.success, r.rows_processed, r.row_counts) for r in audit.collect()}
    assert got["users"] == (True, 3, {"raw_users": 3})
    assert got["posts"][0] is False
    assert book(spark, dataset, "loads").count() == 2
    with pytest.raises(ValueError, match="not found"):
        load_resources(spark, [ResourceSpec("x")], sources, dataset, AT)


def test_load_ids_are_derived():
    assert derive_load_id("r", None, AT) == derive_load_id("r", None, AT)
    assert derive_load_id("r", None, AT) != derive_load_id("r", "2024", AT)


def test_the_frame_equals_the_table(spark, folder, rows):
    dataset = Dataset(root=folder)
    batch = channels(spark, ("a", "A", "2024-01-05T00:00:00Z", "1"), ("b", "B", "2024-01-06T00:00:00Z", "2"))
    frame = load_frame(batch, CHANNELS, None, None, "l", AT)
    load_resource(spark, CHANNELS, batch, dataset, AT, load_id="l", as_of=AT)
    names = sorted(frame.columns)
    assert rows(frame, *names) == rows(dataset.address("channelStats").read(spark), *names)


def test_the_source_is_read_once(spark, folder, tmp_path):
    source = str(tmp_path / "src")
    spark.range(10).write.parquet(source)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches

    df = spark.read.parquet(source).coalesce(1).mapInPandas(seen, "id bigint")
    spec = ResourceSpec("t", ("id",), "merge", checks=(Check("unique", column="id"), Check("not_null", column="id")))
    load_resource(spark, spec, df, Dataset(root=folder), AT)
    assert reads.value == 1
    assert Dataset(root=folder).address("t").read(spark).agg(F.sum("id")).first()[0] == 45


@pytest.mark.parametrize("disposition", ["append", "merge"])
def test_rows_that_tie_with_the_high_water_mark(spark, dataset, rows, disposition):
    """Known rows at the mark are skipped, later ones and changed ones are not, in any session zone."""
    spec = ResourceSpec("e", ("id",), disposition, incremental=Incremental("ts", "2024-01-01 00:00:00"))

    def events(*values):
        listed = ", ".join(f"({i}, TIMESTAMP'{t}+00:00', {v}, {m})" for i, t, v, m in values)
        return spark.sql(f"SELECT * FROM VALUES {listed} AS t(id, ts, v, m)")

    hour = timedelta(hours=1)
    first = [(1, "2024-01-10 00:00:00", "'a'", "map('k', 1)"), (2, "2024-01-10 00:00:00", "NULL", "NULL")]
    load_resource(spark, spec, events(*first), dataset, AT)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for n, name in enumerate(("Asia/Tokyo", "America/New_York"), 1):
            spark.conf.set("spark.sql.session.timeZone", name)
            again = load_resource(spark, spec, events(*first), dataset, AT + n * hour)
            assert again["rows_processed"] == 0
            late = (10 + n, "2024-01-10 00:00:00", "'late'", "NULL")
            got = load_resource(spark, spec, events(*first, late), dataset, AT + 3 * n * hour)
            assert got["rows_processed"] == 1
            first.append(late)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    changed = [first[0][:2] + ("'b'", "map('k', 2)"), *first[1:], (3, "2024-01-11 00:00:00", "'c'", "NULL")]
    got = load_resource(spark, spec, events(*changed), dataset, AT + 9 * hour)
    assert got["rows_processed"] == 2
    stored = dataset.address("e").read(spark)
    old = [] if disposition == "merge" else [(1, "a")]
    assert sorted(rows(stored, "id", "v"), key=str) == sorted(old + [(1, "b"), (2, None), (3, "c"), (11, "late"), (12, "late")], key=str)


def test_rejects_at_the_mark_are_seen_once(spark, folder):
    dataset = Dataset(root=folder)
    spec = ResourceSpec("n", columns=(Column("id", "integer"), Column("day", "date")), incremental=Incremental("day", "2024-01-01"))
    df = spark.sql("SELECT * FROM VALUES ('1', '2024-01-02'), ('x', '2024-01-02') AS t(id, day)")
    counts = [load_resource(spark, spec, df, dataset, AT + timedelta(hours=h)) for h in range(2)]
    assert [(c["rows_processed"], c["rows_rejected"]) for c in counts] == [(1, 1), (0, 0)]


def test_a_backfill_rejects_rows_without_a_cursor(spark, folder):
    dataset = Dataset(root=folder)
    spec = ResourceSpec("e", ("id",), "merge", incremental=Incremental("ts", "2024-01-01 00:00:00"))
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-05'), (2, NULL) AS t(id, ts)")
    got = load_resource(spark, spec, df, dataset, AT, as_of=datetime(2024, 1, 10), options=LoadOptions(backfill_days=30))
    assert (got["rows_processed"], got["rows_rejected"]) == (1, 1)


@pytest.mark.parametrize("mode", ["hash", "mask", "drop"])
def test_protected_values_are_nowhere_in_the_shared_folder(spark, folder, monkeypatch, mode):
    """Neither staged, rejected nor stored; and checks still see what they are about."""
    seen = []
    whole = loads.staged

    @contextmanager
    def looking(df, purpose):
        with whole(df, purpose) as held:
            seen.extend(str(r) for r in held.collect())
            yield held

    monkeypatch.setattr(loads, "staged", looking)
    dataset = Dataset(root=folder)
    spec = ResourceSpec(
        "people", ("id",), "merge", extra_columns="keep", pii_fields=("email", "contact.phone"), pii_mode=mode,
        columns=(Column("id", "integer"), Column("email", "string", path="contact.email"), Column("age", "integer")),
        checks=(
            Check("pattern", column="email", pattern="@", severity="warning"), Check("unique", columns=("email",)),
            Check("not_null", columns=("email",)), Check("schema", severity="warning"),
        ),
    )
    people = spark.sql("""
        SELECT '1' AS id, '5' AS age, named_struct('email', 'ann@secret.org', 'phone', '0123456', 'town', 'Ulm') AS contact
        UNION ALL SELECT '2', '6', named_struct('email', 'secret.org', 'phone', '0123456', 'town', 'Ulm')
        UNION ALL SELECT '3', 'old', named_struct('email', 'bad@secret.org', 'phone', '0123456', 'town', 'Ulm')""")
    result = load_resource(spark, spec, people, dataset, AT)
    assert (result["rows_processed"], result["rows_rejected"]) == (2, 1)
    everything = seen + [str(r) for n in ("rejects", "loads") for r in book(spark, dataset, n).collect()]
    everything += [str(r) for r in dataset.address("people").read(spark).collect()]
    assert seen and not any("secret" in text or "0123456" in text for text in everything)
    assert "Ulm" in str(book(spark, dataset, "rejects").first().raw)
    strict = replace(spec, checks=(Check("pattern", column="email", pattern="@"),))
    with pytest.raises(QualityError, match="pattern:email .1 of 2"):
        load_resource(spark, strict, people, dataset, AT + timedelta(hours=1))


def test_a_failure_after_the_load_does_not_undo_it(spark, folder, monkeypatch):
    def stop(*_, **__):
        raise OSError("no space")

    monkeypatch.setattr(loads, "compact", stop)
    dataset = Dataset(root=folder, compact_after_write=True)
    result = load_resource(spark, ResourceSpec("n"), spark.range(3), dataset, AT)
    assert result["success"] and result["rows_processed"] == 3 and result["error"] == "after the load: no space"
    assert book(spark, dataset, "loads").first().success
