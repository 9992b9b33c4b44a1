"""Readers: files, landed JSON bodies, databases and streams (S1-S4), and feeds."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import path_col
from loadweir.operators.columns import quoted

FILE_FORMATS = ("parquet", "orc", "csv", "json")
CORRUPT = "_corrupt_record"


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: T.StructType | str,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Files under a declared schema. Nothing is inferred, so no extra pass over the data."""
    if fmt not in FILE_FORMATS:
        raise ValueError(f"Unsupported file format '{fmt}'. Supported: {list(FILE_FORMATS)}")
    return spark.read.format(fmt).schema(schema).options(**dict(options or {})).load(path)


def _wrap(record: T.StructType, records_path: str | None) -> T.DataType:
    """The type of a body in which ``records_path`` leads to an array of records."""
    if records_path is None:
        return record
    inner: T.DataType = T.ArrayType(record)
    for part in reversed(records_path.split(".")):
        inner = T.StructType([T.StructField(part, inner)])
    return inner


def json_bodies(
    lines: DataFrame, text: str, fields: T.StructType, options: Mapping[str, Any] | None = None
) -> DataFrame:
    """``lines`` with ``_body``, the fields and ``_corrupt_record`` of each body that ``text`` holds.

    A text that is an array gives one row for each of its elements. Every field is parsed whatever is
    selected afterwards, so it never depends on the query whether a body is corrupt: one that is no
    record, or holds a value of another type, keeps its own text as the mark.
    """
    value = quoted(text)
    listed = F.coalesce(F.from_json(value, "array<string>"), F.array(value))
    each = F.when(value.rlike(r"^\s*\["), listed).otherwise(F.array(value))
    declared = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    # With options given, Spark does not prune the parsed fields to the selected ones.
    given = {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.withColumn("_text", F.explode(each))
    return rows.withColumn("_body", F.from_json("_text", declared, given)).drop("_text")


def read_lines(spark: SparkSession, path: str | list[str], whole: bool = False) -> DataFrame:
    """``_line`` and ``_source_file`` of text files, compressed or not, without blank lines."""
    lines = spark.read.text(path, wholetext=whole)
    lines = lines.select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_source_file"))
    return lines.filter(F.col("_line").rlike(r"\S"))


def read_json_records(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    records_path: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Landed response bodies to one typed row per record.

    A body is a record, an array of records, or an object holding that array at ``records_path``.
    A body that cannot be parsed gives one row with its text in ``_corrupt_record``, and the rest of
    its array is kept. Land one body per line: ``multi_line`` files are read whole by one task each.
    """
    lines = read_lines(spark, path, multi_line)
    return parse_json_records(lines, "_line", schema, records_path)


def parse_json_records(
    df: DataFrame,
    col: str,
    schema: T.StructType | str,
    records_path: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The same for bodies held in a string column; ``keep`` carries other columns along."""
    record = _struct(schema)
    parsed = json_bodies(df, col, _struct(_wrap(record, records_path)))
    corrupt = F.col(f"_body.{CORRUPT}")
    kept = [quoted(k) for k in keep]
    if records_path is None:
        fields = [F.col("_body")[name].alias(name) for name in record.names]
        return parsed.select(*kept, *fields, corrupt.alias(CORRUPT))
    return _records(parsed, path_col(f"_body.{records_path}"), corrupt, kept)


def _records(df: DataFrame, records: Column, corrupt: Column, keep: list[Column] | None = None):
    """One row per record; a body without any stays only if it could not be parsed."""
    rows = df.select(
        *(keep or []),
        corrupt.alias(CORRUPT),
        F.explode_outer(records).alias("_record"),
    ).filter(F.col("_record").isNotNull() | F.col(CORRUPT).isNotNull())
    names = [c for c in rows.columns if c not in (CORRUPT, "_record")]
    return rows.select(*map(quoted, names), "_record.*", CORRUPT)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    part_col: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 8,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """S3: a database table, read by ``partitions`` tasks over ranges of a numeric key.

    The bounds only set the stride; rows outside them are read by the first and last task.
    """
    options = dict(properties or {})
    if part_col is None:
        return spark.read.jdbc(url, table, properties=options)
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs lower and upper")
    return spark.read.jdbc(
        url,
        table,
        column=part_col,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )


def read_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Files as they arrive, at most ``max_files`` per micro-batch."""
    if fmt not in FILE_FORMATS:
        raise ValueError(f"Unsupported file format '{fmt}'. Supported: {list(FILE_FORMATS)}")
    reader = spark.readStream.format(fmt).schema(schema).options(**dict(options or {}))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def feed_from_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose foreign key occurs in the parent resource.

    Parent keys are made distinct first: a semi join cannot split a key repeated on its right
    side, while a hot key on the child side is split by adaptive execution.
    """
    keys = parent.select(quoted(pk).alias("_parent_key")).distinct()
    return child.join(keys, quoted(fk) == F.col("_parent_key"), "left_semi")
