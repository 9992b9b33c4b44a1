"""Staging, packing and word helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.session import shared_dir
from loadweir.sinks.target import FileTree

#: Bytes that separate words: space and \t \n \v \f \r. ``bytes.split()`` splits on exactly these.
BLANKS = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that travel to a Python worker at once, about; a larger row travels alone.
BATCH_BYTES = 4 << 20
#: Slices in which the values of a bucket are put in order, a power of two.
SLICES = 8


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def tidy_shuffles(spark: SparkSession):
    """Within, Spark drops each query's shuffle files as soon as the query has ended."""
    return _setting(spark, CLEANUP, "true")


def small_batches(spark: SparkSession):
    """Within, queries that run send :data:`BATCH_BYTES` at once to Python, however many parts a task has.

    Both sides hold a batch in whole outside the heap, the JVM's side in buffers of up to twice its size.
    """
    return _setting(spark, BATCH, f"{BATCH_BYTES}b")


def flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of binaries without nulls, as they lie, and where those of each binary end."""
    found = column.combine_chunks().cast(pa.binary())
    offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1].astype(np.int64)
    raw = np.frombuffer(found.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(kind), (offsets[1:] - offsets[0]) // np.dtype(kind).itemsize


def slices(values: np.ndarray) -> Iterator[np.ndarray]:
    """The places of ``values``, equal ones together, in :data:`SLICES` by the lowest bits."""
    of = (values & values.dtype.type(SLICES - 1)).astype(np.uint8)
    for i in range(SLICES):
        yield np.flatnonzero(of == i)


def staged(df: DataFrame, purpose: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that outlives executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.staged_at = path
    return found


def forget(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete staged tables, or folders by path, whose readers have all ended."""
    files = FileTree(spark)
    for table in tables:
        files.delete(table if isinstance(table, str) else table.staged_at)


def lower_ascii(column):
    """``column`` with A-Z, and nothing else, in lower case."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pack(df: DataFrame, text: str, part_bytes: int, purpose: str) -> DataFrame:
    """Rows gathered, as they lie, into parts of about ``part_bytes`` of text, one row per part.

    The parts are written to the shared folder, so that every later pass sees the same ones. A part
    holds at least one row; only a row that is larger than ``part_bytes`` makes a larger part.
    Columns: ``part`` long, unique; ``texts`` array of string (null text: empty); ``rows`` array of
    struct, the other columns. Empty tables give no part.
    """
    others = [c for c in df.columns if c != text]
    rows = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    source = df.select(rows.alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = T.StructType(
        [
            T.StructField("part", T.LongType(), False),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("rows", T.ArrayType(source.schema["row"].dataType)),
        ]
    )

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = TaskContext.get().partitionId() << 32, [], 0

        def closed():
            table = pa.concat_arrays([h.column(1) for h in held]), pa.concat_arrays([h.column(0) for h in held])
            ends = pa.array([0, len(table[0])], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, column) for column in table]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *lists], ["part", "texts", "rows"])

        for batch in batches:
            start = 0
            for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                if size and size + n > part_bytes:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield closed()
                    part, held, size, start = part + 1, [], 0, i
                size += n + 16
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield closed()

    return staged(source.mapInArrow(gather, schema), purpose)


def blocks_for(total: int, per_block: int) -> int:
    """How many blocks hold ``total`` entries at about ``per_block`` each."""
    return max(1, -(-total // per_block))
