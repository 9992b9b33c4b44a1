import pytest
from pyspark.sql import functions as F

from loadweir import Check
from loadweir.operators import merging as mrg
from loadweir.session import shared_dir
from loadweir.sinks.target import Target
from loadweir.sources.readers import read_stream
from loadweir.streaming import streams

SCHEMA = "id int, ts timestamp, v int"


@pytest.fixture
def feed(spark, folder):
    """Write each group of rows as the next file of a stream read one file at a time."""

    def write(*groups):
        for n, group in enumerate(groups):
            rows = ", ".join(f"({i}, TIMESTAMP'2024-01-01 {t}', {v})" for i, t, v in group)
            df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, ts, v)")
            df.coalesce(1).write.mode("append").parquet(folder)
        return read_stream(spark, folder, "parquet", SCHEMA, max_files=1)

    return write


def finish(query, batches):
    query.awaitTermination()
    assert query.exception() is None
    done = [p for p in query.recentProgress if p.numInputRows > 0]
    assert len(done) == batches
    return query


def test_append_restarts_without_repeats(spark, feed, rows):
    out, log = shared_dir(spark, "out"), shared_dir(spark, "log")
    sdf = feed([(1, "00:00:00", 1)], [(2, "00:01:00", 2)])
    finish(streams.stream_append(sdf, out, log), 2)
    finish(streams.stream_append(feed([(3, "00:02:00", 3)]), out, log), 1)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_merge_ignores_late_older_rows(spark, feed, rows, folder):
    target = Target.folder(shared_dir(spark, "out"))
    sdf = feed(
        [(1, "00:05:00", 10), (2, "00:00:00", 1)],
        [(1, "00:01:00", 99), (2, "00:02:00", 2), (2, "00:02:00", 3)],
        [(3, "00:00:00", 7), (1, "00:05:00", 10)],
    )
    finish(streams.stream_merge(sdf, target, "id", "ts", shared_dir(spark, "log")), 3)
    assert rows(target.read(spark), "id", "v") == [(1, 10), (2, 3), (3, 7)]
    # The stream ends where one batch over the same rows would.
    whole = mrg.latest_per_key(spark.read.schema(SCHEMA).parquet(folder), "id", "ts")
    assert rows(target.read(spark), "id", "v") == rows(whole, "id", "v")


def test_merge_keeps_rows_without_a_key(spark, feed, rows):
    sdf = feed([(1, "00:00:00", 1), (0, "00:00:00", 2)], [(0, "00:01:00", 3)])
    sdf = sdf.selectExpr("nullif(id, 0) AS id", "ts", "v")
    target, rejects = Target.folder(shared_dir(spark, "out")), shared_dir(spark, "rejects")
    log = shared_dir(spark, "log")
    finish(streams.stream_merge(sdf, target, "id", "ts", log, rejects=rejects), 2)
    assert rows(target.read(spark), "id", "v") == [(1, 1)]
    assert sorted(r.v for r in spark.read.parquet(rejects).collect()) == [2, 3]
    with pytest.raises(Exception, match="NULL key"):
        streams.stream_merge(sdf, target, "id", "ts", shared_dir(spark, "log")).awaitTermination()


@pytest.mark.parametrize("slots", [None, 4])
def test_dedup_over_several_files(spark, feed, rows, slots):
    sdf = feed(
        [(1, "00:00:00", 1), (1, "00:00:30", 1), (2, "00:00:00", 1)],
        [(1, "00:05:00", 1), (3, "00:06:00", 1)],
        [(3, "00:06:30", 1), (4, "00:07:00", 1)],
    )
    once = streams.stream_dedup(sdf, "id", "ts", "1 hour", hot_key_slots=slots)
    assert once.columns == ["id", "ts", "v"]
    out = shared_dir(spark, "out")
    finish(streams.stream_append(once, out, shared_dir(spark, "log")), 3)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,), (4,)]


def test_interval_metrics_keep_open_windows_and_drop_late_rows(spark, feed, rows):
    sdf = feed(
        [(1, "00:01:00", 1), (2, "00:14:59", 0), (3, "00:15:00", 1)],
        [(4, "00:02:00", 0), (5, "03:00:00", 1)],
        [(6, "03:01:00", 1)],
        [(7, "00:03:00", 1)],
    )
    metrics = streams.interval_metrics(sdf, "ts", lateness="1 hour", error=F.col("v") == 0)
    target = Target.folder(shared_dir(spark, "out"))
    finish(streams.stream_interval_metrics(metrics, target, shared_dir(spark, "log")), 4)
    start = F.date_format("window_start", "HH:mm").alias("at")
    assert rows(target.read(spark).select(start, "row_count", "error_count")) == [
        ("00:00", 3, 2),
        ("00:15", 1, 0),
        ("03:00", 2, 0),
    ]


def test_quarantine_splits_whole_and_replays_safely(spark, feed, rows):
    good, bad = Target.folder(shared_dir(spark, "good")), Target.folder(shared_dir(spark, "bad"))
    checks = [Check("positive", column="v")]
    sdf = feed([(1, "00:00:00", 1), (2, "00:00:00", 0)], [(3, "00:00:00", -1), (4, "00:00:00", 4)])
    log = shared_dir(spark, "log")
    finish(streams.stream_quarantine(sdf, checks, good, bad, log), 2)
    assert rows(good.read(spark), "id") == [(1,), (4,)]
    assert rows(bad.read(spark), "id") == [(2,), (3,)]
    # Another stream into the same tables: its batch 0 is not taken for the first one's.
    finish(streams.stream_quarantine(sdf, checks, good, bad, shared_dir(spark, "log")), 2)
    assert rows(good.read(spark), "id") == [(1,), (1,), (4,), (4,)]
    assert {tuple(r.failed_checks) for r in bad.read(spark).collect()} == {("positive:v",)}


def test_watermark_accepts_zoneless_times(spark, folder):
    spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts").write.parquet(folder)
    sdf = read_stream(spark, folder, "parquet", "id int, ts timestamp_ntz")
    assert streams.watermarked(sdf, "ts", "1 hour").schema["ts"].dataType.typeName() == "timestamp"


def test_rejects_of_two_streams_stay_apart(spark, feed):
    target, rejects = Target.folder(shared_dir(spark, "out")), shared_dir(spark, "rejects")
    sdf = feed([(0, "00:00:00", 2)]).selectExpr("nullif(id, 0) AS id", "ts", "v")
    for _ in range(2):  # a new checkpoint each time: the same batch number of another stream
        finish(streams.stream_merge(sdf, target, "id", "ts", shared_dir(spark, "log"), rejects=rejects), 1)
    assert [r.v for r in spark.read.parquet(rejects).collect()] == [2, 2]


def test_metrics_rewrite_the_days_of_a_batch_alone(spark, feed):
    target, log = Target.folder(shared_dir(spark, "out")), shared_dir(spark, "log")

    def run(*groups):
        sdf = feed(*groups).withColumn("ts", F.col("ts") + F.make_dt_interval(F.col("v")))
        metrics = streams.interval_metrics(sdf, "ts", lateness="30 days")
        finish(streams.stream_interval_metrics(metrics, target, log), len(groups))
        return {f for f in target.read(spark).inputFiles()}

    first = run([(1, "00:00:00", 0)], [(2, "00:01:00", 1)])
    second = run([(3, "00:02:00", 1)])
    assert {f for f in first if "2024-01-01" in f} == {f for f in second if "2024-01-01" in f}
    assert sorted(r.row_count for r in target.read(spark).collect()) == [1, 2]
