"""What a dataset remembers between loads: high-water marks, audit rows, rejects."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from threading import Lock
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.operators.metrics import load_audit
from loadweir.sinks.tables import append_fixed, append_once_table
from loadweir.sinks.target import Dataset

# Two appends to one folder at a time would remove each other's temporary files, so loads that run
# side by side in this driver take turns on the tables they share.
_ONE_WRITER = Lock()

CURSOR_SCHEMA = (
    "resource string, cursor string, high_water string, load_id string, extracted_at timestamp"
)
BOUNDARY_SCHEMA = (
    "resource string, high_water string, micros bigint, load_id string, extracted_at timestamp, "
    "seen_a bigint, seen_b bigint"
)


def derive_load_id(resource: str, state: Any, upper: Any) -> str:
    """A load id that a retry of the same load derives again, never a clock or a random number."""
    return hashlib.sha256(f"{resource}|{as_text(state)}|{as_text(upper)}".encode()).hexdigest()[:32]


def as_text(value: Any) -> str | None:
    """A cursor value as text that casts back to its own type."""
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return None if value is None else str(value)


def high_water(spark: SparkSession, dataset: Dataset, resource: str) -> str | None:
    """The last saved cursor of a resource, or None before its first load."""
    target = dataset.bookkeeping("cursors")
    if not target.exists(spark):
        return None
    saved = target.read(spark, schema=T.StructType.fromDDL(CURSOR_SCHEMA))
    newest = F.max_by("high_water", F.struct("extracted_at", "load_id")).alias("high_water")
    return saved.filter(F.col("resource") == resource).agg(newest).first()[0]


def save_cursor(
    spark: SparkSession,
    dataset: Dataset,
    resource: str,
    cursor: str,
    value: Any,
    load_id: str,
    extracted_at: datetime,
) -> None:
    """append one row; called only after the rows themselves are written."""
    row = [resource, cursor, as_text(value), load_id, as_text(extracted_at)]
    fields = T.StructType.fromDDL(CURSOR_SCHEMA).fields
    values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]
    with _ONE_WRITER:
        append_fixed(spark.range(0, 1, 1, 1).select(*values), dataset.bookkeeping("cursors"))


def boundary(
    spark: SparkSession, dataset: Dataset, resource: str, state: str | None
) -> tuple[int | None, DataFrame] | None:
    """What was read at the high-water mark ``state``: its microseconds, if it is an instant, and the rows' identities.

    None if no load has saved any, as before the first one. An instant is known by its microseconds
    and not by its text, which depends on the session's zone.
    """
    target = dataset.bookkeeping("boundaries")
    if state is None or not target.exists(spark):
        return None
    saved = target.read(spark, schema=T.StructType.fromDDL(BOUNDARY_SCHEMA))
    saved = saved.filter(F.col("resource") == resource)
    at = saved.filter(F.col("high_water") == state)
    newest = at.agg(F.count(F.lit(1)).alias("n"), F.max_by("micros", F.struct("extracted_at", "load_id")).alias("micros")).first()
    if newest["n"] == 0:
        return None
    if newest["micros"] is not None:
        at = saved.filter(F.col("micros") == newest["micros"])
    return newest["micros"], at.select("seen_a", "seen_b")


def save_boundary(
    seen: DataFrame,
    dataset: Dataset,
    resource: str,
    value: str,
    micros: int | None,
    load_id: str,
    extracted_at: datetime,
) -> None:
    """Append the identities ``seen`` of the rows at ``value``; a replay adds equal ones, which change nothing.

    Saved after the rows and before the cursor, so a saved cursor always has its boundary.
    """
    row = [resource, value, micros, load_id, as_text(extracted_at)]
    fields = T.StructType.fromDDL(BOUNDARY_SCHEMA).fields
    values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]
    with _ONE_WRITER:
        append_fixed(seen.select(*values, "seen_a", "seen_b"), dataset.bookkeeping("boundaries"))


def save_audit(
    spark: SparkSession, dataset: Dataset, results: Sequence[Mapping[str, Any]]
) -> DataFrame:
    """A2: append audit rows and return them."""
    audit = load_audit(spark, results)
    with _ONE_WRITER:
        append_fixed(audit, dataset.bookkeeping("loads"))
    return audit


def save_rejects(rejects: DataFrame, dataset: Dataset, load_id: str) -> None:
    """Append rejected rows. The id names the resource as well, so a replay adds nothing."""
    with _ONE_WRITER:
        append_once_table(rejects, dataset.bookkeeping("rejects"), load_id)
