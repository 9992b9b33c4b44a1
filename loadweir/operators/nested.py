"""Nested data: flatten structs and turn arrays into child rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.operators.columns import quoted


def flatten(df: DataFrame, sep: str = "__", max_depth: int | None = None) -> DataFrame:
    """Structs become columns named ``parent<sep>child``, in one projection.

    ``max_depth`` stops after that many levels. Two leaves that get the same name raise.
    """
    leaves: list[tuple[str, Column]] = []

    def walk(prefix: str, column: Column, data_type: T.DataType, depth: int) -> None:
        if isinstance(data_type, T.StructType) and (max_depth is None or depth < max_depth):
            for field in data_type.fields:
                walk(f"{prefix}{sep}{field.name}", column[field.name], field.dataType, depth + 1)
        else:
            leaves.append((prefix, column))

    for field in df.schema.fields:
        walk(field.name, quoted(field.name), field.dataType, 0)
    names = [name.lower() for name, _ in leaves]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Flattening gives the same name more than once: {twice}")
    return df.select(*[column.alias(name) for name, column in leaves])


def explode_children(
    df: DataFrame, key: str | Sequence[str], array_col: str, value_name: str = "value"
) -> DataFrame:
    """P10: one row per array element with the parent key and its position from 0.

    NULL and empty arrays give no rows. There is no shuffle, so one huge array costs only the task
    that reads it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(
        *[quoted(k) for k in keys], F.posexplode(quoted(array_col)).alias("pos", value_name)
    )
