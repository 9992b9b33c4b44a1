"""Column-level operators: resolve, rename, protect and stamp."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import hash_text, mask_text, path_col, typed_literal
from loadweir.functions.naming import to_case
from loadweir.spec import PII_MODES


def quoted(name: str):
    """A top-level column by its exact name, dots and all."""
    return F.col(f"`{name}`")


def match_names(
    have: Iterable[str], wanted: Iterable[str], case_sensitive: bool = False
) -> dict[str, str | None]:
    """P5: for each wanted name the column that answers to it, or None.

    An exact match wins. Without one, two columns that differ only in case are an error, because
    picking either would be a guess.
    """
    have = list(have)
    found: dict[str, str | None] = {}
    for name in wanted:
        if name in have:
            found[name] = name
            continue
        alike = [] if case_sensitive else [h for h in have if h.lower() == name.lower()]
        if len(alike) > 1:
            raise ValueError(f"Column '{name}' is ambiguous: {alike}")
        found[name] = alike[0] if alike else None
    return found


def resolve_columns(
    df: DataFrame, names: Iterable[str], case_sensitive: bool = False
) -> DataFrame:
    """P5: select ``names`` as spelled in the contract, whatever their case in ``df``."""
    found = match_names(df.columns, names, case_sensitive)
    absent = [name for name, column in found.items() if column is None]
    if absent:
        raise ValueError(f"Columns {absent} not found. Available: {df.columns}")
    return df.select(*[quoted(column).alias(name) for name, column in found.items()])


def apply_aliases(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``old -> new``; an unknown old name or a clash of new names raises."""
    absent = [old for old in mapping if old not in df.columns]
    if absent:
        raise ValueError(f"Cannot alias unknown columns {absent}. Available: {df.columns}")
    return _rename(df, {name: mapping.get(name, name) for name in df.columns})


def normalise_columns(df: DataFrame, case: str = "snake_case") -> DataFrame:
    """Every column name in one case; two columns that normalise alike raise."""
    return _rename(df, {name: to_case(name, case) for name in df.columns})


def _rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    taken: dict[str, str] = {}
    for old, new in names.items():
        if new.lower() in taken:
            raise ValueError(f"Columns '{taken[new.lower()]}' and '{old}' both become '{new}'")
        taken[new.lower()] = old
    return df.select(*[quoted(old).alias(new) for old, new in names.items()])


def protect_pii(
    df: DataFrame, fields: Iterable[str], mode: str = "hash", salt: str = "", keep: int = 4
) -> DataFrame:
    """Hash, mask or drop the listed fields in place; NULL stays NULL.

    A field is a column, or a dotted path into one, through structs and on its way through the
    elements of arrays and the values of maps. All leaves below a field are protected.
    """
    if mode not in PII_MODES:
        raise ValueError(f"Unknown protection mode '{mode}'. Known modes: {list(PII_MODES)}")
    fields = list(fields)
    found = match_names(df.columns, fields)
    heads = match_names(df.columns, [f.split(".")[0] for f in fields])
    absent = [f for f in fields if found[f] is None and heads[f.split(".")[0]] is None]
    if absent:
        raise ValueError(f"Protected fields {absent} not found. Available: {df.columns}")
    if mode == "drop":
        leaf = None
    elif mode == "hash":
        leaf = partial(hash_text, salt=salt)
    else:
        leaf = partial(mask_text, keep=keep)
    for field in fields:
        column, path = found[field], []
        if column is None:
            column, path = heads[field.split(".")[0]], field.split(".")[1:]
        if leaf is None and not path:
            df = df.drop(column)
        else:
            df = df.withColumn(column, protected(quoted(column), df.schema[column].dataType, path, leaf))
    return df


def protected(
    value: SparkColumn, kind: T.DataType, path: Sequence[str], leaf: Callable[[SparkColumn], SparkColumn] | None
) -> SparkColumn:
    """``value`` with the leaves at ``path`` below it put through ``leaf``, or dropped if that is None."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: protected(x, kind.elementType, path, leaf))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: protected(v, kind.valueType, path, leaf))
    if isinstance(kind, T.StructType):
        if not path:
            for f in kind.fields:
                value = value.withField(f"`{f.name}`", protected(value.getField(f.name), f.dataType, [], leaf))
            return value
        name = match_names(kind.names, path[:1])[path[0]]
        if name is not None:
            if leaf is None and len(path) == 1:
                return value.dropFields(f"`{name}`") if len(kind.fields) > 1 else F.lit(None).cast(kind)
            below = protected(value.getField(name), kind[name].dataType, path[1:], leaf)
            return value.withField(f"`{name}`", below)
    if path:
        raise ValueError(f"Protected field '{path[0]}' not found in {kind.simpleString()}")
    return F.lit(None).cast(kind) if leaf is None else leaf(value)


def stamp(
    df: DataFrame, load_id: str, extracted_at: datetime | str, time_type: T.DataType | None = None
) -> DataFrame:
    """Add ``_load_id`` and ``_extracted_at``. Both are arguments, so a retry stamps alike."""
    return df.withColumns(
        {
            "_load_id": F.lit(load_id),
            "_extracted_at": typed_literal(extracted_at, time_type or T.TimestampType()),
        }
    )


def select_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Nested paths as flat columns, ``{name: path}``; only those leaves are read."""
    return df.select(*[path_col(path).alias(name) for name, path in paths.items()])
