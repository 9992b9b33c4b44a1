"""Write dispositions as frames: what the target holds after a load.

The sinks write the frames returned here, so the semantics can be checked without storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadweir.functions.columns import orderable
from loadweir.operators.columns import quoted
from loadweir.operators.conform import evolve_union


def _keys(keys: str | Sequence[str]) -> list[str]:
    out = [keys] if isinstance(keys, str) else list(keys)
    if not out:
        raise ValueError("a merge needs a primary key")
    return out


def all_set(keys: str | Sequence[str]) -> Column:
    """True where no part of the key is NULL."""
    condition = F.lit(True)
    for key in _keys(keys):
        condition = condition & quoted(key).isNotNull()
    return condition


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str] = ()
) -> DataFrame:
    """One row per key, the one with the greatest ``order``.

    Ties are broken by all remaining columns, so the result never depends on the order of arrival.
    Because the filter asks for the first row only, Spark drops all but one row per key *before*
    the shuffle as well: a key that holds a third of the table sends one row per task.
    """
    keys = _keys(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [f for f in df.schema.fields if f.name not in {*keys, *order}]
    ranking = [quoted(o).desc_nulls_last() for o in order]
    ranking += [orderable(f).desc_nulls_last() for f in rest]
    if not ranking:
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*ranking)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both. Duplicates stay, with or without a primary key."""
    return evolve_union(target, batch)


def replace(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The batch alone."""
    return batch


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str] = (),
) -> DataFrame:
    """Batch rows replace whole target rows with the same key; the rest is kept or added.

    The batch is reduced by W4 first, and its rows with a NULL key part are left out (the caller
    rejects them). The anti join sees distinct batch keys only, so a key repeated in the batch
    cannot skew it, and Spark broadcasts those keys whenever they measure small enough.
    """
    keys = _keys(keys)
    usable = batch.filter(all_set(keys))
    arriving = usable.select(*map(quoted, keys)).distinct()
    kept = target.join(arriving, on=keys, how="left_anti").select(*map(quoted, target.columns))
    return evolve_union(kept, latest_per_key(usable, keys, order))


def append_once(target: DataFrame, batch: DataFrame, id_column: str = "_load_id") -> DataFrame:
    """Append, but a batch whose load id the target already holds adds nothing.

    Load ids are few and their rows many, so a join of rows on the id would send a whole batch to
    one task. Instead both sides are first reduced to their distinct ids; adaptive execution then
    broadcasts the ids in both if they measure small.
    """
    mine = batch.select(quoted(id_column)).distinct()
    seen = target.select(quoted(id_column)).distinct().join(mine, on=id_column, how="left_semi")
    fresh = batch.join(seen, on=id_column, how="left_anti")
    return evolve_union(target, fresh.select(*map(quoted, batch.columns)))
