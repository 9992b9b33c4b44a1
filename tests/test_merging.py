import pytest
from pyspark.sql import functions as F

from loadweir.operators import merging as mrg

SCHEMA = "id int, ts int, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_append_keeps_duplicates(spark, rows):
    df = frame(spark, (1, 1, "a"))
    assert rows(mrg.append(df, df)) == [(1, 1, "a"), (1, 1, "a")]


def test_latest_with_ties_and_nulls(spark, rows):
    df = frame(spark, (1, 1, "old"), (1, 2, "x"), (1, 2, "y"), (2, None, "n"), (2, 0, "m"), (None, 1, "k"))
    assert rows(mrg.latest_per_key(df, "id", "ts")) == [(1, 2, "y"), (2, 0, "m"), (None, 1, "k")]


def test_latest_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = mrg.latest_per_key(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_a_hot_key_sends_one_row_per_task(spark):
    # A third of all rows share one key, over four tasks.
    df = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("ts")
    )
    out = mrg.latest_per_key(df, "k", "ts")
    assert out.count() == 20_001
    assert out.filter("k = -1").first().ts == 29_997


def test_latest_orders_maps_and_variants(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, map('a', 1)), (1, map('a', 2)) AS t(id, m)"
    ).withColumn("j", F.parse_json(F.lit("{}")))
    assert mrg.latest_per_key(df, "id").first().m == {"a": 2}


def test_merge(spark, rows):
    target = frame(spark, (1, 1, "keep"), (2, 1, "old"), (None, 1, "nokey"))
    batch = frame(spark, (2, 2, "new"), (2, 3, "newer"), (3, 1, "add"), (None, 9, "rejected"))
    merged = mrg.merge(target, batch, "id", "ts")
    want = [(1, 1, "keep"), (2, 3, "newer"), (3, 1, "add"), (None, 1, "nokey")]
    assert rows(merged) == want
    assert rows(mrg.merge(merged, batch, "id", "ts")) == want


def test_merge_into_and_from_empty(spark, rows):
    some, empty = frame(spark, (1, 1, "a")), frame(spark)
    assert rows(mrg.merge(empty, some, "id")) == [(1, 1, "a")]
    assert rows(mrg.merge(some, empty, "id")) == [(1, 1, "a")]
    with pytest.raises(ValueError, match="primary key"):
        mrg.merge(some, some, [])


def test_merge_by_two_keys_with_a_new_column(spark, rows):
    target = spark.sql("SELECT 1 AS a, 'x' AS b, 10 AS n")
    batch = spark.sql("SELECT 1 AS a, 'x' AS b, 2.5D AS n, true AS flag")
    other = spark.sql("SELECT 1 AS a, 'y' AS b, 1.0D AS n, true AS flag")
    assert rows(mrg.merge(target, batch.unionAll(other), ["a", "b"])) == [
        (1, "x", 2.5, True),
        (1, "y", 1.0, True),
    ]


def test_append_once(spark, rows):
    target = spark.createDataFrame([(1, "l1")], "id int, _load_id string")
    batch = spark.createDataFrame([(1, "l1"), (2, "l2"), (3, "l2")], "id int, _load_id string")
    once = mrg.append_once(target, batch)
    assert rows(once) == [(1, "l1"), (2, "l2"), (3, "l2")]
    assert rows(mrg.append_once(once, batch)) == rows(once)
    plan = mrg.append_once(target, batch)._jdf.queryExecution().executedPlan().toString()
    # No forced broadcast: adaptive execution plans the join of distinct ids by their measured size.
    assert "AdaptiveSparkPlan" in plan and "ResolvedHint" not in plan
