"""Column contracts: conform, split off what does not conform, evolve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import failed_texts, path_col, path_type
from loadweir.operators.columns import match_names, quoted
from loadweir.spec import Column

REASONS = "_reasons"

# Numeric types from narrow to wide. A float is placed below double only; an
# integer meets it at double, so that no digits are lost to a float.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_REALS = ("float", "double")


def _value(source: SparkColumn, source_type: T.DataType, column: Column) -> SparkColumn:
    """The contract's typed value, NULL where the cast fails."""
    nested = isinstance(source_type, (T.StructType, T.ArrayType, T.MapType))
    if column.data_type == "json":
        if isinstance(source_type, T.VariantType):
            return source
        if nested:
            return F.to_variant_object(source)
        return F.try_parse_json(source.cast("string"))
    if isinstance(source_type, T.VariantType):
        return F.try_variant_get(source, "$", column.sql_type)
    if column.data_type == "string" and nested:
        return F.to_json(source)
    return source.try_cast(column.sql_type)


def _bind(df: DataFrame, columns: Sequence[Column]):
    """Pair each contract column with its source expression, or with None when it is absent."""
    top = match_names(df.columns, [c.source.split(".")[0] for c in columns])
    bound: list[tuple[Column, SparkColumn | None, T.DataType | None]] = []
    for column in columns:
        head, *rest = column.source.split(".")
        if top[head] is None:
            bound.append((column, None, None))
            continue
        path = ".".join([top[head], *rest])
        bound.append((column, path_col(path), path_type(df, path)))
    absent = [c.name for c, source, _ in bound if source is None and not c.nullable]
    if absent:
        raise ValueError(f"Required columns {absent} are missing. Available: {df.columns}")
    return bound


def conformed_columns(
    df: DataFrame, columns: Sequence[Column], extra: str = "drop"
) -> list[SparkColumn]:
    """The select list of a contract: declared columns in order, then kept extras."""
    if extra not in ("drop", "keep"):
        raise ValueError(f"extra must be 'drop' or 'keep', not '{extra}'")
    out = []
    for column, source, source_type in _bind(df, columns):
        value = F.lit(None).cast(column.sql_type) if source is None else _value(source, source_type, column)
        out.append(value.alias(column.name))
    if extra == "keep":
        used = {name.lower() for c in columns for name in (c.source, c.name)}
        out += [quoted(name) for name in df.columns if name.lower() not in used]
    return out


def conform(df: DataFrame, columns: Sequence[Column], extra: str = "drop") -> DataFrame:
    """Declared columns, in order and typed.

    A failed cast gives NULL. A missing nullable column is filled with typed NULLs; a missing
    required one raises. Undeclared columns are dropped, or kept after the declared ones.
    """
    return df.select(*conformed_columns(df, columns, extra))


def contract_rules(df: DataFrame, columns: Sequence[Column]) -> list[tuple[SparkColumn, str]]:
    """``(a row breaks it, what to say)`` for every rule a contract makes."""
    rules = []
    for column, source, source_type in _bind(df, columns):
        if source is None:
            continue
        if source_type.simpleString() != column.sql_type:
            value = _value(source, source_type, column)
            failed = source.isNotNull() & value.isNull()
            if isinstance(source_type, T.FractionalType) and column.sql_type in _INTEGERS:
                failed = failed | (value.isNotNull() & (F.floor(source) != F.ceil(source)))
            rules.append((failed, f"{column.name}: not a valid {column.data_type}"))
        if not column.nullable:
            rules.append((source.isNull(), f"{column.name}: null"))
    return rules


def split_rejects(
    df: DataFrame, columns: Sequence[Column], extra: str = "drop"
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; together they hold every input row.

    Good rows are conformed. Rejects keep their raw values, since a failed cast would erase the
    very value someone needs to see, and gain an array of reasons.
    """
    judged = df.withColumn(REASONS, failed_texts(contract_rules(df, columns)))
    good = judged.filter(F.size(REASONS) == 0).select(*conformed_columns(df, columns, extra))
    return good, judged.filter(F.size(REASONS) > 0)


def _wider(name: str, left: T.DataType, right: T.DataType) -> T.DataType:
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    a, b = left.simpleString(), right.simpleString()
    if a in _INTEGERS and b in _INTEGERS:
        return left if _INTEGERS.index(a) > _INTEGERS.index(b) else right
    if {a, b} <= set(_INTEGERS + _REALS):
        return T.DoubleType()
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(_wider(f"{name}[]", left.elementType, right.elementType))
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return _merged_struct(left, right, f"{name}.")
    raise ValueError(f"Column '{name}' cannot change from {a} to {b}")


def _merged_struct(left: T.StructType, right: T.StructType, prefix: str = "") -> T.StructType:
    twins = match_names(right.names, left.names)
    fields = [
        T.StructField(
            f.name,
            f.dataType
            if twins[f.name] is None
            else _wider(prefix + f.name, f.dataType, right[twins[f.name]].dataType),
        )
        for f in left.fields
    ]
    known = {name for name in twins.values() if name}
    return T.StructType(fields + [f for f in right.fields if f.name not in known])


def _fit(column: SparkColumn, have: T.DataType, want: T.DataType) -> SparkColumn:
    """Cast ``column`` to a type it can widen to, adding absent struct fields as NULL."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        twins = match_names(have.names, want.names)
        parts = [
            (
                F.lit(None).cast(f.dataType)
                if twins[f.name] is None
                else _fit(column[twins[f.name]], have[twins[f.name]].dataType, f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: _fit(x, have.elementType, want.elementType))
    return column.cast(want)


def merged_schema(left: T.StructType, right: T.StructType) -> T.StructType:
    """The narrowest schema both sides fit, with ``left``'s names and order first."""
    return _merged_struct(left, right)


def fit_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` under a schema it can widen to; columns it lacks are typed NULLs."""
    twins = match_names(df.columns, schema.names)
    return df.select(
        *[
            (
                F.lit(None).cast(f.dataType)
                if twins[f.name] is None
                else _fit(quoted(twins[f.name]), df.schema[twins[f.name]].dataType, f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def evolve_union(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, under a schema wide enough for both.

    Columns new to either side are NULL on the other, integers and reals widen, and any other
    change of type raises. Names match without regard to case; the target's spelling wins.
    """
    schema = merged_schema(target.schema, batch.schema)
    return fit_columns(target, schema).union(fit_columns(batch, schema))
