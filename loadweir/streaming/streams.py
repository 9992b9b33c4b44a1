"""Streaming forms of the table operators (ST1-ST5)."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadweir.operators.columns import quoted
from loadweir.operators.merging import all_set
from loadweir.operators.quality import split_tagged, tag_rows
from loadweir.sinks.tables import append_once_table, merge_table, staged
from loadweir.sinks.target import Target
from loadweir.spec import Check

# Fixed value: take all that has arrived, in as many micro-batches as the source asks for, and stop.
ALL_AVAILABLE = {"availableNow": True}


def _start(writer, checkpoint: str, trigger: dict[str, Any] | None) -> StreamingQuery:
    return (
        writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ALL_AVAILABLE)).start()
    )


def _stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id that a stream's checkpoint keeps; a new checkpoint is another stream."""
    own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return own or sha256(checkpoint.encode()).hexdigest()


def stream_append(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """ST1: append to files, exactly once: the file sink's log names each batch's files."""
    writer = sdf.writeStream.format(fmt).outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, checkpoint, trigger)


def stream_merge(
    sdf: DataFrame,
    target: Target,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    partition_by: Sequence[str] = (),
    rejects: str | None = None,
    partition_fixed: bool = False,
) -> StreamingQuery:
    """ST2: upsert each micro-batch by key.

    Stored rows of the batch's keys compete with the batch, so a late older row never replaces a
    newer one, and a batch that is run again changes nothing. A merge looks at its batch more than
    once, so the batch is staged first and the stream, with whatever state it has, runs once. Give
    ``partition_by`` for a large target: only partitions that change are rewritten. With
    ``partition_fixed`` (a key never changes partition, as an event its day) the others are not read either.

    Rows with a NULL in their key go to the folder ``rejects``, a sub-folder per stream and batch,
    which the same batch run again replaces and no other stream touches. Without that folder such a
    row stops the stream.
    """
    key_set = all_set(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, "stream") as rows:
            keyless = rows.filter(~key_set)
            if not keyless.isEmpty():
                if rejects is None:
                    raise ValueError(f"batch {batch_id} has rows with a NULL key; give a folder for rejects")
                place = f"{rejects}/stream_id={_stream_id(batch, checkpoint)}/batch_id={batch_id}"
                keyless.write.mode("overwrite").parquet(place)
            if not rows.isEmpty():
                merge_table(rows, target, keys, order, partition_by, partition_fixed, keep_newer=True)

    return _start(sdf.writeStream.foreachBatch(write).outputMode("append"), checkpoint, trigger)


def watermarked(sdf: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Put a watermark on ``ts``, which must be a TIMESTAMP: one without a zone is cast first."""
    if sdf.schema[ts].dataType.typeName() == "timestamp_ntz":
        sdf = sdf.withColumn(ts, quoted(ts).cast("timestamp"))
    return sdf.withWatermark(ts, lateness)


def stream_dedup(
    sdf: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    lateness: str,
    hot_key_slots: int | None = None,
) -> DataFrame:
    """ST3: the first row per key; repeats within ``lateness`` of it are dropped.

    A key that floods the stream sends all its copies to one state partition. ``hot_key_slots``
    de-duplicates by ``(key, input slot)`` first, so the flood is spread over that many tasks and
    at most one row per slot goes on to the final step.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    marked = watermarked(sdf, ts, lateness)
    if hot_key_slots:
        slot = F.pmod(F.spark_partition_id(), F.lit(hot_key_slots))
        marked = marked.withColumn("__slot", slot)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "__slot"]).drop("__slot")
    return marked.dropDuplicatesWithinWatermark(keys)


def interval_metrics(
    sdf: DataFrame,
    ts: str,
    width: str = "15 minutes",
    lateness: str = "1 hour",
    error: Column | None = None,
) -> DataFrame:
    """ST4: row and error counts per tumbling window; rows later than the watermark are dropped.

    Counts are added up inside each task before they meet the state, so a busy window is one
    partial row per task.
    """
    failed = F.count_if(error) if error is not None else F.lit(0).cast("bigint")
    return (
        watermarked(sdf, ts, lateness)
        .groupBy(F.window(ts, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("row_count"), failed.alias("error_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "row_count",
            "error_count",
        )
    )


def stream_interval_metrics(
    metrics: DataFrame,
    target: Target,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """ST4's sink: windows that changed replace their old row.

    ``append`` mode would withhold every window that is still open. The target is partitioned by the
    day of the window, which a window never leaves, so a batch reads and rewrites the days it is
    about however long the stream has run; a target from before keeps the layout it has.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, "stream") as rows:
            if not rows.isEmpty():
                merge_table(rows, target, "window_start", "row_count", ["window_start"], True)

    return _start(metrics.writeStream.foreachBatch(write).outputMode("update"), checkpoint, trigger)


def stream_quarantine(
    sdf: DataFrame,
    checks: Sequence[Check],
    good: Target,
    rejects: Target,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    name: str = "stream",
) -> StreamingQuery:
    """ST5: rows that pass the row checks go to ``good``, others to ``rejects`` with their reasons.

    The batch is staged in the shared folder while both are written, so the source is read once.
    Each write carries the stream's id, which its checkpoint keeps, and the batch id as its load id:
    a batch that is run again adds nothing, and another stream's batches are never taken for it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{name}-{_stream_id(batch, checkpoint)}-{batch_id}"
        tagged = tag_rows(batch, checks).withColumn("_load_id", F.lit(load_id))
        with staged(tagged, "quarantine") as held:
            passed, failed = split_tagged(held)
            append_once_table(passed, good, load_id)
            append_once_table(failed, rejects, load_id)

    return _start(sdf.writeStream.foreachBatch(write).outputMode("append"), checkpoint, trigger)
