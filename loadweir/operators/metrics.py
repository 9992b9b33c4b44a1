"""Load metrics as frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from datetime import datetime, timedelta
from functools import reduce
from threading import Lock
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import path_col, path_type, typed_literal

TOTAL = "__total__"

AUDIT_SCHEMA = (
    "pipeline_name string, resource string, success boolean, start_time timestamp, "
    "end_time timestamp, duration_seconds double, rows_processed bigint, rows_rejected bigint, "
    "error string, load_id string, destination string, high_water string, "
    "row_counts map<string, bigint>"
)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """A1: rows per table and a ``__total__`` row.

    Each table is counted where it is; only one number per table is shuffled.
    """
    if not frames:
        raise ValueError("no tables to count")
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in frames.items()
    ]
    each = reduce(DataFrame.unionByName, counts)
    return each.rollup("table_name").agg(F.sum("n").alias("row_count")).select(
        F.coalesce("table_name", F.lit(TOTAL)).alias("table_name"), "row_count"
    )


def load_audit(spark: SparkSession, results: Sequence[Mapping[str, Any]]) -> DataFrame:
    """A2: one audit row per load. The rows are load results, not data."""
    fields = T.StructType.fromDDL(AUDIT_SCHEMA).fields
    rows = []
    for result in results:
        row = dict(result)
        if row.get("start_time") is not None and row.get("end_time") is not None:
            row["duration_seconds"] = (row["end_time"] - row["start_time"]).total_seconds()
        counts = [F.lit(x) for pair in (row.get("row_counts") or {}).items() for x in pair]
        row["row_counts"] = F.create_map(*counts) if counts else None
        rows.append(F.struct(*[_fact(row.get(f.name), f) for f in fields]))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def _fact(value: Any, field: T.StructField) -> Column:
    """Times go in as text and are cast by Spark, which knows the session's zone."""
    literal = F.lit(str(value)) if isinstance(value, datetime) else F.lit(value)
    return literal.cast(field.dataType).alias(field.name)


def freshness(
    frames: Mapping[str, DataFrame], cursors: Mapping[str, str], as_of: datetime
) -> DataFrame:
    """A3: the newest cursor of each table and how many whole hours it lags behind ``as_of``."""
    if not frames:
        raise ValueError("no tables to measure")
    parts = []
    for name, df in frames.items():
        cursor = cursors[name]
        kind = path_type(df, cursor)
        lag = F.timestamp_diff("HOUR", F.col("newest"), typed_literal(as_of, kind))
        parts.append(
            df.agg(F.max(path_col(cursor)).alias("newest")).select(
                F.lit(name).alias("table_name"), "newest", lag.cast("bigint").alias("lag_hours")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def error_metrics(runs: DataFrame, ok: str | Column, by: Sequence[str | Column] = ()) -> DataFrame:
    """A4: runs, errors and error rate per group. A run whose ``ok`` is NULL counts as an error."""
    column = F.col(ok) if isinstance(ok, str) else ok
    failed = F.count_if(~F.coalesce(column, F.lit(False)))
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        failed.alias("errors"),
        F.try_divide(failed.cast("double"), F.count(F.lit(1))).alias("error_rate"),
    )


def sla_misses(
    runs: DataFrame, max_minutes: float, start: str = "start_time", end: str = "end_time"
) -> DataFrame:
    """A5: runs that took longer than ``max_minutes``, to the microsecond; their length in whole minutes."""
    took = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))
    return runs.filter(took > round(max_minutes * 60_000_000)).withColumn(
        "duration_minutes", F.timestamp_diff("MINUTE", F.col(start), F.col(end)).cast("bigint")
    )


def stale_tables(fresh: DataFrame, sla_hours: int, as_of: datetime) -> DataFrame:
    """A5: tables of an A3 frame that lag more than ``sla_hours``, or that are empty.

    The times are compared as they are; the frame's whole hours are for display.
    """
    if sla_hours < 1:
        raise ValueError("SLA hours must be at least 1")
    latest = typed_literal(as_of - timedelta(hours=sla_hours), fresh.schema["newest"].dataType)
    return fresh.filter((F.col("newest") < latest) | F.col("newest").isNull())


def post_load(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    statements: Mapping[str, str],
    params: Mapping[str, Any] | None = None,
) -> dict[str, DataFrame]:
    """``{name: SELECT}`` over the loaded tables, each result visible to later statements.

    Results are lazy; write them with :func:`loadweir.sinks.tables.write_table`. Parameters are
    bound as typed values, never spliced into the text. Names hold while the statements are resolved;
    afterwards the session has the temporary views that it had before, and no others.
    """
    results: dict[str, DataFrame] = {}
    with _NAMES, ExitStack() as undo:
        views = spark.sql("SHOW VIEWS").filter("isTemporary").select("viewName").collect()
        taken = {row.viewName.lower() for row in views}

        def name_it(name: str, df: DataFrame) -> None:
            if name.lower() in taken:
                undo.callback(spark.table(f"`{name}`").createOrReplaceTempView, name)
            else:
                undo.callback(spark.catalog.dropTempView, name)
            df.createOrReplaceTempView(name)

        for table, df in tables.items():
            name_it(table, df)
        for name, text in statements.items():
            results[name] = spark.sql(text, args=dict(params or {}))
            name_it(name, results[name])
    return results


# Loads side by side share a session, and so its names.
_NAMES = Lock()


def missing_slots(
    df: DataFrame, ts: str, start: datetime, end: datetime, step: timedelta
) -> DataFrame:
    """Start times in ``[start, end)``, ``step`` apart from ``start``, that hold no row.

    Slots are generated in parallel by ``range`` rather than exploded out of one row. Filled slots
    are made distinct before the join, so a crowded slot is one row per task.
    """
    width = int(step.total_seconds())
    if width < 1 or step.microseconds:
        raise ValueError("step must be whole seconds, at least one")
    n_slots = -((start - end) // timedelta(seconds=width))
    column, kind = path_col(ts), path_type(df, ts)
    first, last = typed_literal(start, kind), typed_literal(end, kind)
    inside = df.filter((column >= first) & (column < last))
    slot = F.floor(F.timestamp_diff("SECOND", first, column) / width).cast("bigint")
    filled = inside.select(slot.alias("slot_no")).distinct()
    expected = df.sparkSession.range(max(n_slots, 0)).withColumnRenamed("id", "slot_no")
    offset = F.make_dt_interval(secs=(F.col("slot_no") * width).cast("decimal(18,6)"))
    return expected.join(filled, on="slot_no", how="left_anti").select(
        (first + offset).cast(kind).alias("slot_start")
    )
