"""Column expressions shared by the operators. All of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_col(path: str) -> Column:
    """A dotted path such as ``snippet.publishedAt``, each part quoted so odd names work."""
    return F.col(".".join(f"`{part.strip('`')}`" for part in path.split(".")))


def path_type(df: DataFrame, path: str) -> T.DataType:
    """The type a path has in ``df``; plan-time only."""
    kind: T.DataType = df.schema
    for part in path.split("."):
        name = part.strip("`").lower()
        fields = kind.fields if isinstance(kind, T.StructType) else []
        found = [f for f in fields if f.name.lower() == name]
        if len(found) != 1:
            # An array of structs, a map or a name in doubt: let Spark resolve it or say why not.
            return df.select(path_col(path).alias("v")).schema["v"].dataType
        kind = found[0].dataType
    return kind


def json_get(col: str | Column, path: str, sql_type: str) -> Column:
    """The value at ``path`` of a JSON string; malformed JSON or no such path gives NULL."""
    column = F.col(col) if isinstance(col, str) else col
    return F.try_variant_get(F.try_parse_json(column), path, sql_type)


def typed_literal(value: object, data_type: T.DataType) -> Column:
    """A literal of the column's own type, so the bare column stays comparable at the scan.

    Times go in as text: a Python datetime literal would be shifted by the driver's own zone.
    """
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc)
            if isinstance(data_type, T.TimestampNTZType):
                value = value.replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    elif isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast(data_type)


def hash_text(col: Column, salt: str = "") -> Column:
    """SHA-256 hex of the salted string form; NULL stays NULL."""
    text = col.cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


def mask_text(col: Column, keep: int = 4) -> Column:
    """Mask all but the last ``keep`` characters; a value no longer than that is masked whole."""
    text = col.cast("string")
    hidden = F.mask(text, F.lit("*"), F.lit("*"), F.lit("*"), F.lit("*"))
    split = F.length(text) - keep
    tail = F.concat(
        F.mask(F.substring(text, F.lit(1), split), F.lit("*"), F.lit("*"), F.lit("*"), F.lit("*")),
        F.substring(text, split + 1, F.lit(keep)),
    )
    return F.when(split > 0, tail).otherwise(hidden)


def failed_texts(rules: Sequence[tuple[Column, str]]) -> Column:
    """The texts of the rules a row fails, as an array; a rule that is NULL is not failed.

    The array is built for failing rows only: for all others one compiled condition is enough. Texts
    differ from each other, so taking NULL out by ``array_except`` loses none of them, and unlike a
    filter with a lambda it stays inside generated code.
    """
    none = F.array().cast("array<string>")
    if not rules:
        return none
    any_failed = reduce(or_, [failed for failed, _ in rules])
    nothing = F.array(F.lit(None).cast("string"))
    texts = F.array(*[F.when(failed, F.lit(text)) for failed, text in rules])
    return F.when(any_failed, F.array_except(texts, nothing)).otherwise(none)


def orderable(field: T.StructField) -> Column:
    """A column in a form that can be sorted: maps and variants have no order of their own."""
    column = F.col(f"`{field.name}`")
    return column if is_sortable(field.dataType) else F.to_json(F.struct(column))


def is_sortable(data_type: T.DataType) -> bool:
    """Whether values of a type can be sorted and hashed: no map or variant is in it."""
    if isinstance(data_type, T.ArrayType):
        return is_sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(is_sortable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))
