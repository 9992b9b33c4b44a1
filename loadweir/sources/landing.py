"""A landing folder of JSON records as a source type, through Spark's own reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.sources.readers import CORRUPT, json_bodies, read_lines


def open_landing(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> DataFrame:
    """The records of ``path`` with the fields of ``schema``, ``_corrupt_record`` and ``_source_file``.

    Lines may be compressed, and hold a record or an array of records. One that is no record, or that
    holds a value of another type, keeps its raw text in ``_corrupt_record`` and is never dropped,
    whichever columns are selected; what can be read of it is read. ``options`` are those of Spark's
    JSON reader; with ``multiLine`` a file is one text.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    own = T.StructType([f for f in fields if f.name not in (CORRUPT, "_source_file")])
    whole = str(options.pop("multiLine", False)).lower() == "true"
    bodies = json_bodies(read_lines(spark, path, whole), "_line", own, options)
    return bodies.select(*[F.col("_body")[f.name].alias(f.name) for f in own], F.col("_body")[CORRUPT].alias(CORRUPT), "_source_file")
