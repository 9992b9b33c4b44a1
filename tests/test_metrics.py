from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loadweir.operators import metrics as met


def test_row_counts_with_an_empty_table(spark):
    counts = met.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"a": 3, "b": 0, "__total__": 3}


def test_freshness_and_staleness(spark):
    fresh = spark.sql("SELECT TIMESTAMP'2024-01-02 00:30:00' AS ts")
    frames = {"a": fresh, "empty": fresh.limit(0)}
    lag = met.freshness(frames, {"a": "ts", "empty": "ts"}, datetime(2024, 1, 3))
    assert {r.table_name: r.lag_hours for r in lag.collect()} == {"a": 23, "empty": None}
    assert [r.table_name for r in met.stale_tables(lag, 24, datetime(2024, 1, 3)).collect()] == ["empty"]
    # 24 hours and 59 minutes are more than 24 hours
    later = datetime(2024, 1, 3, 0, 59)
    assert "a" in [r.table_name for r in met.stale_tables(lag, 22, later).collect()]
    with pytest.raises(ValueError):
        met.stale_tables(lag, 0, datetime(2024, 1, 3))


def test_errors_count_unknown_outcomes(spark):
    runs = spark.sql("SELECT * FROM VALUES ('p', true), ('p', false), ('p', NULL) AS t(job, success)")
    row = met.error_metrics(runs, "success", ["job"]).first()
    assert (row.runs, row.errors, row.error_rate) == (3, 2, pytest.approx(2 / 3))


def test_audit_and_sla(spark):
    start = datetime(2024, 1, 1)
    runs = [
        {"pipeline_name": "p", "success": True, "start_time": start, "end_time": start + timedelta(minutes=m)}
        for m in (19, 20, 21)
    ]
    audit = met.load_audit(spark, runs)
    assert sorted(r.duration_seconds for r in audit.collect()) == [1140.0, 1200.0, 1260.0]
    assert [r.duration_minutes for r in met.sla_misses(audit, 20).collect()] == [21]


def test_post_load_statements_see_each_other(spark):
    out = met.post_load(
        spark,
        {"loaded": spark.range(10)},
        {"even": "SELECT id FROM loaded WHERE id % :d = 0", "n": "SELECT count(*) AS n FROM even"},
        {"d": 2},
    )
    assert out["n"].first().n == 5


def test_post_load_leaves_the_sessions_views_alone(spark):
    spark.range(3).createOrReplaceTempView("loaded")
    statements = {"Even": "SELECT id FROM loaded WHERE id % 2 = 0", "n": "SELECT count(*) AS n FROM even"}
    before = {r.viewName for r in spark.sql("SHOW VIEWS").collect()}
    try:
        for _ in range(2):
            assert met.post_load(spark, {"loaded": spark.range(10)}, statements)["n"].first().n == 5
        with pytest.raises(AnalysisException):
            met.post_load(spark, {"loaded": spark.range(10)}, {**statements, "bad": "SELECT x FROM n"})
        assert spark.table("loaded").count() == 3
        assert {r.viewName for r in spark.sql("SHOW VIEWS").collect()} == before
    finally:
        spark.catalog.dropTempView("loaded")


def test_missing_slots(spark):
    df = spark.sql(
        "SELECT CAST(ts AS TIMESTAMP) AS ts FROM VALUES ('2024-01-01 00:10:00'), "
        "('2024-01-01 00:59:59'), ('2024-01-01 02:00:00'), ('2024-01-01 09:00:00'), (NULL) AS t(ts)"
    )
    gaps = met.missing_slots(df, "ts", datetime(2024, 1, 1), datetime(2024, 1, 1, 3, 30), timedelta(hours=1))
    got = sorted(r[0] for r in gaps.select(F.col("slot_start").cast("string")).collect())
    assert got == ["2024-01-01 01:00:00", "2024-01-01 03:00:00"]
    none = met.missing_slots(df, "ts", datetime(2024, 1, 1), datetime(2024, 1, 1), timedelta(hours=1))
    assert none.count() == 0
