from datetime import datetime

import pytest

from loadweir.operators import cursor as cur


@pytest.fixture
def events(spark):
    return spark.sql(
        """SELECT id, CAST(ts AS TIMESTAMP_NTZ) AS ts FROM VALUES
        (1, '2024-01-01'), (2, '2024-01-02'), (3, '2024-01-02'), (4, '2024-01-05'), (5, NULL)
        AS t(id, ts)"""
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_first_run_includes_initial_value(events):
    assert ids(cur.incremental(events, "ts", None, "2024-01-02T00:00:00Z")) == [2, 3, 4]


def test_later_runs_are_strict_unless_asked(events):
    state = datetime(2024, 1, 2)
    assert ids(cur.incremental(events, "ts", state, "2020-01-01")) == [4]
    assert ids(cur.incremental(events, "ts", state, inclusive=True)) == [2, 3, 4]


def test_rows_without_cursor(events):
    assert ids(cur.without_cursor(events, "ts")) == [5]
    assert ids(cur.incremental(events, "ts", None)) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="cursor_field is empty"):
        cur.incremental(events, "", None)


def test_filter_reaches_the_scan(spark, folder, events):
    events.write.parquet(folder)
    plan = cur.incremental(spark.read.parquet(folder), "ts", datetime(2024, 1, 2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in text


def test_increments_equal_one_full_load(events):
    state, seen = None, []
    for upper in (datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 9)):
        source = events.filter(events.ts <= upper)
        batch = cur.incremental(source, "ts", state, "2000-01-01")
        seen += ids(batch)
        state = cur.advance_cursor(batch, "ts", state).first()[0]
    assert sorted(seen) == [1, 2, 3, 4]
    assert state == datetime(2024, 1, 5)


def test_cursor_never_goes_back_and_survives_an_empty_batch(events):
    old = datetime(2030, 1, 1)
    assert cur.advance_cursor(events, "ts", old).first()[0] == old
    assert cur.advance_cursor(events.limit(0), "ts", old).first()[0] == old
    assert cur.advance_cursor(events.limit(0), "ts").first()[0] is None


def test_backfill_is_half_open(events):
    assert ids(cur.backfill(events, "ts", 3, datetime(2024, 1, 5))) == [2, 3]


def test_retention_keeps_undated_rows(events):
    assert ids(cur.apply_retention(events, "ts", datetime(2024, 1, 9), 4)) == [4, 5]


def test_latest_breaks_ties(events):
    assert [r.id for r in cur.latest(events, "ts", 3, ["id"]).collect()] == [4, 2, 3]
    plan = cur.latest(events, "ts", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_scan_binds_values(spark):
    df = spark.sql("SELECT * FROM VALUES ('a'), (\"o'b\") AS t(name)")
    assert cur.scan(df, "name = :n", args={"n": "o'b"}).count() == 1
    assert cur.scan(df, order_by=["name"], limit=1).first().name == "a"
