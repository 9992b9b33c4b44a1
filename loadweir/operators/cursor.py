"""Cursors: what is new, what to remember, and which rows to keep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweir.functions.columns import is_sortable, orderable, path_col, path_type, typed_literal
from loadweir.operators.columns import quoted


def past_cursor(
    df: DataFrame, cursor: str, state: Any, initial: Any, inclusive: bool = False
) -> Column | None:
    """The predicate of F1, or None when there is neither a state nor an initial value."""
    if not cursor:
        raise ValueError("incremental is enabled but cursor_field is empty")
    bound = initial if state is None else state
    if bound is None:
        return None
    column = path_col(cursor)
    limit = typed_literal(bound, path_type(df, cursor))
    return column >= limit if state is None or inclusive else column > limit


def incremental(
    df: DataFrame, cursor: str, state: Any, initial: Any = None, inclusive: bool = False
) -> DataFrame:
    """rows past the saved ``state``, or from ``initial`` (inclusive) on the first run.

    After the first run the bound is strict; ``inclusive`` re-reads rows that tie with it, which a
    merge absorbs. Rows without a cursor are not returned: see :func:`without_cursor`. The bare
    column is compared with a literal of its own type, so the filter reaches the scan.
    """
    predicate = past_cursor(df, cursor, state, initial, inclusive)
    return df.filter(path_col(cursor).isNotNull() if predicate is None else predicate)


def row_identity(df: DataFrame, paths: Sequence[str]) -> tuple[Column, Column]:
    """128 bits, as two longs, of what a row holds at ``paths``: equal for equal rows alone.

    Whether a value is NULL counts as well, so a value does not pass for its neighbour's.
    """
    values = []
    for path in paths:
        value = path_col(path)
        if not is_sortable(path_type(df, path)):
            value = F.to_json(F.struct(value.alias("v")))
        values += [value.isNull(), value]
    return F.xxhash64(*values), F.xxhash64(F.lit("b"), *reversed(values))


def past_boundary(
    df: DataFrame, cursor: str, bound: Column, known: DataFrame, paths: Sequence[str]
) -> DataFrame:
    """F1 with ties: rows at ``bound`` or past it, less those at it that are ``known``; rows without a cursor stay.

    ``known`` has ``seen_a`` and ``seen_b``, the identities of rows read at the bound before. A row that
    came later with the same cursor is new, however long after. Rows past the bound keep keys of
    their own in the join, so they spread over its tasks and match nothing.
    """
    place = path_col(cursor)
    a, b = row_identity(df, paths)
    rows = df.filter((place >= bound) | place.isNull())
    rows = rows.withColumns({"__tie": F.coalesce(place == bound, F.lit(False)), "__a": a, "__b": b})
    met = known.select(F.lit(True).alias("__tie"), F.col("seen_a").alias("__a"), F.col("seen_b").alias("__b"))
    return rows.join(met.distinct(), ["__tie", "__a", "__b"], "left_anti").select(*map(quoted, df.columns))


def without_cursor(df: DataFrame, cursor: str) -> DataFrame:
    """F1's rejects: rows whose cursor is NULL, which no high-water mark can place."""
    return df.filter(path_col(cursor).isNull())


def advance_cursor(df: DataFrame, cursor: str, old: Any = None) -> DataFrame:
    """one row ``high_water``: the larger of ``old`` and the rows' maximum.

    An empty batch leaves ``old``. Save it only after the rows themselves are written.
    """
    newest = F.max(path_col(cursor))
    if old is not None:
        newest = F.greatest(newest, typed_literal(old, path_type(df, cursor)))
    return df.agg(newest.alias("high_water"))


def backfill(df: DataFrame, cursor: str, days: int, as_of: datetime) -> DataFrame:
    """rows in ``[as_of - days, as_of)``, whatever the saved state is."""
    return df.filter(within_backfill(df, cursor, days, as_of))


def within_backfill(df: DataFrame, cursor: str, days: int, as_of: datetime) -> Column:
    """The predicate of F3; NULL for a row without a cursor."""
    if days < 1:
        raise ValueError("backfill needs at least one day")
    column, kind = path_col(cursor), path_type(df, cursor)
    start = typed_literal(as_of - timedelta(days=days), kind)
    return (column >= start) & (column < typed_literal(as_of, kind))


def apply_retention(df: DataFrame, column: str, as_of: datetime, days: int = 7) -> DataFrame:
    """drop rows older than ``days`` before ``as_of``; rows without a date are kept."""
    if days < 0:
        raise ValueError("retention days cannot be negative")
    oldest = typed_literal(as_of - timedelta(days=days), path_type(df, column))
    return df.filter((path_col(column) >= oldest) | path_col(column).isNull())


def latest(df: DataFrame, order: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """the newest ``n`` rows. ``tie`` breaks ties, then every other column does.

    Spark plans this as one top-n per task and a merge of those, with no sort of the table.
    """
    named = {order, *tie}
    rest = [orderable(f).desc_nulls_last() for f in df.schema.fields if f.name not in named]
    keys = [path_col(order).desc_nulls_last(), *[quoted(t).asc_nulls_last() for t in tie]]
    return df.orderBy(*keys, *rest).limit(n)


def scan(
    df: DataFrame,
    where: str | Column | None = None,
    order_by: Sequence[str | Column] = (),
    limit: int | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The filter, sort and page size a source is asked for, applied where the rows are.

    ``where`` may be SQL text with ``:name`` parameters taken from ``args``.
    """
    if isinstance(where, str) and args:
        df = df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {where}", args=dict(args), rows=df)
    elif where is not None:
        df = df.filter(where)
    if order_by:
        df = df.orderBy(*order_by)
    return df if limit is None else df.limit(limit)
