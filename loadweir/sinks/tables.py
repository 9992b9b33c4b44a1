"""Table sinks: append, replace, merge, layout, retention and compaction."""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta
from functools import reduce
from operator import and_
from threading import Lock
from uuid import uuid4

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import typed_literal
from loadweir.operators.columns import match_names, quoted
from loadweir.operators.conform import evolve_union, fit_columns, merged_schema
from loadweir.operators.merging import all_set, latest_per_key, merge
from loadweir.session import shared_dir
from loadweir.sinks.ledger import LoadLedger
from loadweir.sinks.target import NULL_PARTITION, ROW_LEVEL_FORMATS, VERSION, FileTree, Target, unversioned


#: Tasks that a compaction's shuffle has at most; a task writes several files beyond that.
MOST_TASKS = 20_000
#: Bytes of rows that one task of a clustered write sorts, about.
RANGE_BYTES = 128 << 20


def date_partitions(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns to partition by; a timestamp is reduced to ``<name>_date``.

    A folder per instant would be a folder per load or per row.
    """
    found = match_names(df.columns, partition_by)
    absent = [name for name, column in found.items() if column is None]
    if absent:
        raise ValueError(f"Partition columns {absent} not found. Available: {df.columns}")
    names = []
    for column in found.values():
        if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(f"{column}_date", F.to_date(quoted(column)))
            column = f"{column}_date"
        names.append(column)
    return df, names


def _derive_partitions(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """``df`` with the partition columns of the table it goes into.

    ``<name>_date`` is derived from a time column ``<name>``. What cannot be derived is an error: the
    rows would all land in the partition of NULL.
    """
    found = match_names(df.columns, partitions)
    for name in [n for n, column in found.items() if column is None]:
        times = match_names(df.columns, [name.removesuffix("_date")])
        source = next(iter(times.values()))
        kind = None if source is None else df.schema[source].dataType
        if not (name.endswith("_date") and isinstance(kind, (T.TimestampType, T.TimestampNTZType))):
            raise ValueError(f"The rows lack the partition column '{name}'. Available: {df.columns}")
        df = df.withColumn(name, F.to_date(quoted(source)))
    return df


def _range_count(df: DataFrame, least: int) -> int:
    """How many ranges keep each at about ``RANGE_BYTES``, as Spark sorts rows; ``least`` or more."""
    width = F.lit(40 + 8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        text = quoted(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(text)
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    total = df.agg(F.sum(width)).first()[0] or 0
    return max(least, -(-total // RANGE_BYTES))


def lay_out(
    df: DataFrame,
    partitions: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    parallelism: int | None = None,
) -> DataFrame:
    """Distribute rows for writing.

    Partitioned writes are rebalanced by partition: small partitions share a task and a crowded one
    is split over many. Clustered writes are range-partitioned; a spread column behind the cluster
    columns lets one value that fills much of the table span several ranges. They have ``parallelism``
    ranges at least, and more where those would be larger than a task should sort: one more pass over
    ``df`` measures that.
    """
    if cluster_by:
        order = [*partitions, *cluster_by]
        spread = df.withColumn("__spread", F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
        ranges = [*map(quoted, order), F.col("__spread")]
        placed = (
            spread.repartitionByRange(_range_count(df, parallelism), *ranges)
            if parallelism
            else spread.repartitionByRange(*ranges)
        )
        return placed.sortWithinPartitions(*map(quoted, order)).drop("__spread")
    if partitions:
        tasks = [parallelism] if parallelism else []
        return df.hint("rebalance", *tasks, *map(quoted, partitions))
    return df.repartition(parallelism) if parallelism else df


def _writer(df: DataFrame, target: Target, mode: str, partitions: Sequence[str], rows_per_file):
    writer: DataFrameWriter = df.write.format(target.fmt).mode(mode)
    if partitions:
        writer = writer.partitionBy(*partitions)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    return writer


def _save(writer: DataFrameWriter, target: Target) -> None:
    if target.is_folder:
        writer.save(target.location)
    else:
        writer.saveAsTable(target.location)


def write_table(
    df: DataFrame,
    target: Target,
    disposition: str = "append",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    rows_per_file: int | None = None,
    parallelism: int | None = None,
    stage: bool = True,
) -> None:
    """Append to or replace a table, laid out as asked.

    ``replace`` drops old partitions too, which dynamic overwrite would keep. ``stage=False`` saves a
    copy when a catalog table of another schema is replaced by rows that are stored elsewhere already.
    """
    spark = df.sparkSession
    if disposition not in ("append", "replace"):
        raise ValueError(f"write_table cannot '{disposition}'; use merge_table")
    exists = target.exists(spark)
    if disposition == "append" and exists:
        df, _ = date_partitions(df, partition_by)
        partition_by = target.partition_columns(spark)
        df = _derive_partitions(df, partition_by)
        df = _fit_table(df, target)
    df, partitions = date_partitions(df, partition_by)
    if disposition == "replace":
        _replace(
            df, target, exists, partitions, cluster_by, parallelism, rows_per_file, stage
        )
    else:
        laid = lay_out(df, partitions, cluster_by, parallelism)
        if target.is_folder and exists:
            _widen_schema(spark, target, df.schema)
        _save(_writer(laid, target, "append", partitions, rows_per_file), target)
        if target.is_folder and not exists:
            target.save_schema(spark, df.schema)


def _widen_schema(spark: SparkSession, target: Target, schema: T.StructType) -> None:
    """Add columns that are new to the schema a folder keeps of itself, if it keeps one."""
    saved = target.saved_schema(spark)
    if saved is None:
        return
    known = {name.lower() for name in saved.names}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        target.save_schema(spark, T.StructType([*saved.fields, *new]))


def append_fixed(df: DataFrame, target: Target) -> None:
    """Append rows of a schema that never changes: nothing about the table is read first."""
    _save(_writer(df, target, "append", (), None), target)


def _fit_table(df: DataFrame, target: Target) -> DataFrame:
    """P12 for an append: stored columns keep their types, and new ones are added to the table."""
    spark = df.sparkSession
    stored = target.read(spark)
    wide = merged_schema(stored.schema, df.schema)
    # Types of partition columns are read off folder names, so they say nothing about the data.
    folders = set(target.partition_columns(spark)) if target.is_folder else set()
    changed = [
        f.name
        for f in stored.schema.fields
        if wide[f.name].dataType != f.dataType and f.name not in folders
    ]
    if changed:
        raise ValueError(f"Columns {changed} would widen; merge or replace the table to do that")
    new = [f for f in wide.fields if f.name not in stored.columns]
    if new and not target.is_folder:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {target.location} ADD COLUMNS ({added})")
    return fit_columns(df, wide)


def _replace(
    df: DataFrame,
    target: Target,
    exists: bool,
    partitions: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    parallelism: int | None = None,
    rows_per_file: int | None = None,
    stage: bool = True,
    keep_ledger: bool = False,
) -> None:
    """Put ``df`` in the place of the table, which ``df`` itself may read.

    A folder is written beside the old one and swapped in by two renames, and a plain catalog table
    is moved to a new location (:func:`_move_table`), so a failed write leaves the old table whole. A
    catalog table that changes its types, partitions or format is dropped before it is written
    again, so its new rows are staged first, unless they come from a staged table already. Formats
    with row-level operations replace a table atomically themselves. Marks of loads go with the rows
    they are about, unless ``keep_ledger`` says that the new rows are the old ones.
    """
    spark = df.sparkSession
    if exists and not keep_ledger:
        LoadLedger(spark, target).clear()

    def save(rows: DataFrame, to: Target, mode: str) -> None:
        laid = lay_out(rows, partitions, cluster_by, parallelism)
        _save(_writer(laid, to, mode, partitions, rows_per_file), to)

    if not exists:
        save(df, target, "errorifexists")
        if target.is_folder:
            target.save_schema(spark, df.schema)
    elif _can_move(spark, target, df.schema, partitions):
        _move_table(df, target, partitions, save)
    elif target.fmt in ROW_LEVEL_FORMATS or not (target.is_folder or stage):
        save(df, target, "overwrite")
    elif target.is_folder:
        fresh = Target.folder(f"{target.location}__next-{uuid4().hex}", target.fmt)
        save(df, fresh, "errorifexists")
        fresh.save_schema(spark, df.schema)
        target.swap_in(spark, fresh.location)
    else:
        path = shared_dir(spark, "replace")
        df.write.parquet(path)
        try:
            save(spark.read.schema(df.schema).parquet(path), target, "overwrite")
        except Exception as error:
            error.add_note(f"The new rows of {target.location} are kept in {path}")
            raise
        FileTree(spark).delete(path)


def _can_move(spark: SparkSession, target: Target, schema: T.StructType, partitions) -> bool:
    """Whether a catalog table can hold rows of ``schema`` by a change of its location and new columns alone."""
    if target.is_folder or target.fmt in ROW_LEVEL_FORMATS:
        return False
    facts = target.described(spark)
    if facts.get("Provider", "").lower() != target.fmt or facts.get("Bucket Columns", "[]") != "[]":
        return False
    if target.partition_columns(spark) != list(partitions) or (partitions and not _owned(facts)):
        return False
    new = {f.name: f.dataType.simpleString() for f in schema.fields}
    return all(new.get(f.name) == f.dataType.simpleString() for f in spark.table(target.location).schema)


def _owned(facts: dict[str, str]) -> bool:
    """Whether the folder of a table belongs to it, so that nobody else misses it."""
    return facts.get("Type") == "MANAGED" or unversioned(facts["Location"]) != facts["Location"]


def _move_table(df: DataFrame, target: Target, partitions: Sequence[str], save) -> None:
    """Write ``df`` once, to a new location, and let the table point there.

    ``df`` may read the table. Until the pointer moves, which is one change in the catalog, the table
    is as it was; a write that fails is deleted. Then the old folder goes, unless a user chose it for
    an external table. A partitioned table's list of partitions follows: after a stop in between
    ``MSCK REPAIR TABLE ... SYNC PARTITIONS`` completes it.
    """
    spark, files = df.sparkSession, FileTree(df.sparkSession)
    facts, known = target.described(spark), set(spark.table(target.location).columns)
    old = facts["Location"].rstrip("/")
    fresh = Target.folder(f"{unversioned(old)}{VERSION}{uuid4().hex}", target.fmt)
    try:
        save(df, fresh, "errorifexists")
    except Exception:
        files.delete(fresh.location)
        raise
    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in known)
    if added:
        spark.sql(f"ALTER TABLE {target.location} ADD COLUMNS ({added})")
    spark.sql(f"ALTER TABLE {target.location} SET LOCATION {_sql_text(fresh.location)}")
    if _owned(facts):
        files.delete(old)
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {target.location} SYNC PARTITIONS")
    spark.catalog.refreshTable(target.location)


@contextmanager
def staged(df: DataFrame, purpose: str):
    """Hold ``df`` as a parquet table in the shared folder while the block runs.

    The source is then read once, later passes read only the columns they need, and a lost
    executor re-reads the folder and not the source.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        FileTree(spark).delete(path)


def append_once_table(
    df: DataFrame,
    target: Target,
    load_id: str,
    id_column: str = "_load_id",
    extracted_at: datetime | None = None,
    **layout,
) -> bool:
    """Append ``df`` unless the table already holds the whole load ``load_id``; True if it wrote.

    All rows of ``df`` must carry ``load_id``. A mark is set before the rows are written and another
    one after, so a replay knows at the cost of two look-ups by name whether the load ended, stopped
    half way or never began. What a stopped one left is deleted before it is written again: a commit
    that was torn between two files neither loses rows nor doubles them. A table without any mark
    is searched for the id once. ``extracted_at``, if a replay is known to carry the same, prunes
    that search. Formats whose appends are atomic are only asked for a row of the id.
    """
    spark = df.sparkSession
    exists = target.exists(spark)
    mine = quoted(id_column) == load_id
    if exists and target.fmt in ROW_LEVEL_FORMATS:
        if not target.read(spark).filter(mine).isEmpty():
            return False
        write_table(df, target, "append", **layout)
        return True
    if exists:
        ledger = LoadLedger(spark, target)
        if ledger.is_committed(load_id):
            return False
        stored = target.read(spark)
        if ledger.may_hold(load_id) and id_column in stored.columns:
            if extracted_at is not None and "_extracted_at" in stored.columns:
                at = typed_literal(extracted_at, stored.schema["_extracted_at"].dataType)
                mine = mine & (quoted("_extracted_at") == at)
                if "_extracted_at_date" in stored.columns:
                    mine = mine & (quoted("_extracted_at_date") == F.to_date(at))
            delete_rows(spark, target, mine)
        ledger.begin(load_id)
    write_table(df, target, "append", **layout)
    LoadLedger(spark, target).commit(load_id)
    return True


def delete_rows(spark: SparkSession, target: Target, doomed: Column) -> None:
    """Delete the stored rows for which ``doomed`` is true.

    The condition is pushed down to the files' statistics, so files that cannot hold such a row are
    not read, and if there is none, nothing changes. Files that hold such rows alone are deleted as
    they are; only the partitions of files that hold others as well are written again. Formats with
    row-level operations are best asked with their own ``DELETE``.
    """
    partitions = target.partition_columns(spark)
    stored = _with_text_partitions(spark, target, partitions)
    where = {f"__p{i}": _as_text(p) for i, p in enumerate(partitions)}
    located = stored.withColumns({"__path": F.col("_metadata.file_path"), **where})
    names = ["__path", *where]
    hits = located.filter(doomed).groupBy(*names).agg(F.count(F.lit(1)).alias("__hit"))
    with staged(hits, "doomed") as hits:
        if hits.isEmpty():
            return
        # Rows per file come from the footers: no column is read for them.
        sizes = located.groupBy("__path").agg(F.count(F.lit(1)).alias("__all"))
        counted = hits.join(sizes, "__path").withColumn("__mixed", F.col("__hit") < F.col("__all"))
        with staged(counted, "doomed") as counted:
            mixed = counted.filter("__mixed")
            kept = F.coalesce(~doomed, F.lit(True))
            if mixed.isEmpty():
                whole = counted
            elif not partitions:
                _replace(stored.filter(kept), target, True, keep_ledger=True)
                return
            else:
                touched = mixed.groupBy(*where).agg(F.lit(1).alias("__touched"))
                with staged(touched, "touched") as touched:
                    rows = _in_partitions(stored, touched, partitions).filter(kept)
                    _overwrite_partitions(rows, target, partitions, None)
                whole = counted.join(mixed.select(*where).distinct(), list(where), "left_anti")
            files = FileTree(spark)
            for row in whole.select("__path").toLocalIterator():
                files.delete_uri(row[0])
    if not target.is_folder:
        spark.catalog.refreshTable(target.location)


def merge_table(
    batch: DataFrame,
    target: Target,
    keys: str | Sequence[str],
    order: str | Sequence[str] = (),
    partition_by: Sequence[str] = (),
    partition_fixed: bool = False,
    rows_per_file: int | None = None,
    keep_newer: bool = False,
    cluster_by: Sequence[str] = (),
) -> None:
    """Upsert ``batch`` by key.

    A table format with row-level operations merges in place. A plain partitioned table rewrites
    only the partitions that hold an old version of an arriving key or that receive a row; with
    ``partition_fixed`` (a key never changes partition) the first kind need not be searched for.
    ``keep_newer`` lets a stored row with a greater ``order`` win over an arriving one.
    """
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("a merge needs a primary key")
    if not target.exists(spark):
        batch = latest_per_key(batch.filter(all_set(keys)), keys, order)
        write_table(batch, target, "replace", partition_by, cluster_by, rows_per_file)
        return
    if target.fmt in ROW_LEVEL_FORMATS and not target.is_folder:
        _merge_in_place(batch, target, keys, order, keep_newer)
        return
    partitions = target.partition_columns(spark)
    if partition_by:
        batch, _ = date_partitions(batch, partition_by)
    batch = _derive_partitions(batch, partitions)
    kinds = {f.name: f.dataType for f in batch.schema.fields if f.name in partitions}
    stored = target.read(spark, kinds)
    if partitions and len(kinds) == len(partitions) and not _widened(stored, batch):
        stored = _with_new_columns(stored, batch, target, kinds)
        contenders = _contenders(stored, batch, keys, keep_newer)
        marks = _partitions_to_rewrite(stored, contenders, keys, order, partitions, partition_fixed)
        with staged(marks, "touched") as touched:
            _merge_partitions(
                batch, target, stored, keys, order, partitions, touched, rows_per_file, keep_newer,
                cluster_by,
            )
        return
    merged = merge(stored, _contenders(stored, batch, keys, keep_newer), keys, order)
    _replace(
        merged, target, True, partitions, cluster_by, rows_per_file=rows_per_file, keep_ledger=True
    )


def _contenders(stored, batch, keys, keep_newer) -> DataFrame:
    """The rows that compete for the batch's keys: the batch, and with ``keep_newer`` stored ones.

    Columns stay in the batch's order, which ties are broken by; a stored table has its partition
    columns last.
    """
    usable = batch.filter(all_set(keys))
    if not keep_newer:
        return usable
    arriving = usable.select(*map(quoted, keys)).distinct()
    rivals = stored.join(arriving, on=keys, how="left_semi").select(*map(quoted, stored.columns))
    return evolve_union(usable, rivals)


def _widened(stored: DataFrame, batch: DataFrame) -> bool:
    """Whether a stored column gets another type, which its files in every partition would need."""
    wide = merged_schema(stored.schema, batch.schema)
    return any(wide[f.name].dataType != f.dataType for f in stored.schema.fields)


def _with_new_columns(stored: DataFrame, batch: DataFrame, target: Target, kinds) -> DataFrame:
    """``stored`` with the batch's new columns, all NULL; old files stay as they are without them."""
    spark = batch.sparkSession
    wide = merged_schema(stored.schema, batch.schema)
    new = [f for f in wide.fields if f.name not in stored.columns]
    if not new:
        return stored
    if target.is_folder:
        _widen_schema(spark, target, T.StructType(new))
        return stored.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})
    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
    spark.sql(f"ALTER TABLE {target.location} ADD COLUMNS ({added})")
    return target.read(spark, kinds)


def _partitions_to_rewrite(stored, contenders, keys, order, partitions, fixed) -> DataFrame:
    """The partitions a merge touches: ``__p0``, ``__p1`` ... as text, ``__touched`` = 1, ``__left``.

    ``__left`` is 0 where no row is left. One pass over the keys and partition columns of the
    table; rows are reduced to one per partition inside each task, and none reaches the driver.
    """
    where = {f"__p{i}": _as_text(p) for i, p in enumerate(partitions)}
    flags = ("replaced", "kept", "landing")

    def flagged(df: DataFrame, *values: Column) -> DataFrame:
        named = [v.cast("int").alias(f"__{n}") for v, n in zip(values, flags)]
        return df.select(*[text.alias(name) for name, text in where.items()], *named)

    winners = latest_per_key(contenders, keys, order)
    marks = flagged(winners, F.lit(0), F.lit(0), F.lit(1))
    if not fixed:
        arriving = contenders.select(*map(quoted, keys)).distinct().withColumn("__hit", F.lit(1))
        old = stored.select(*[quoted(c) for c in dict.fromkeys([*keys, *partitions])])
        hit = F.col("__hit").isNotNull()
        found = flagged(old.join(arriving, on=keys, how="left"), hit, ~hit, F.lit(0))
        marks = marks.unionByName(found)
    sums = marks.groupBy(*where).agg(*[F.max(f"__{n}").alias(f"__{n}") for n in flags])
    touched = sums.filter("__replaced = 1 OR __landing = 1")
    return touched.select(*where, F.lit(1).alias("__touched"), F.expr("__kept + __landing").alias("__left"))


def _with_text_partitions(spark: SparkSession, target: Target, partitions) -> DataFrame:
    """The stored rows; partition values of a folder as the text they have, not as Spark reads it."""
    if not (target.is_folder and partitions):
        return target.read(spark)
    return target.read(spark, {p: T.StringType() for p in partitions})


def _as_text(partition: str) -> Column:
    """A partition value as text that compares equal to itself, NULL included."""
    return F.coalesce(quoted(partition).cast("string"), F.lit(NULL_PARTITION))


def _in_partitions(stored: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The stored rows of the partitions in ``touched`` (``__p0`` ..., ``__touched``), a frame of any size.

    A semi-join on the partition columns. While ``touched`` measures small enough to be broadcast,
    Spark prunes the folders by it before it lists their files; beyond that it is a plain join.
    """
    wanted = touched.filter("__touched = 1").select(*[f"__p{i}" for i in range(len(partitions))])
    same = [_as_text(p) == F.col(f"__p{i}") for i, p in enumerate(partitions)]
    return stored.join(wanted, reduce(and_, same), "left_semi")


def _merge_partitions(
    batch, target, stored, keys, order, partitions, touched, rows_per_file, keep_newer, cluster_by
) -> None:
    """Rewrite the touched partitions, which are swapped in when the whole write has succeeded.

    New files are written beside those being read, so no copy is staged. A partition that lost its
    last row to another one gets no new files and is dropped afterwards. A stop in between leaves
    old versions, which the next run of the same batch replaces.
    """
    if touched.isEmpty():
        return
    part = _in_partitions(stored, touched, partitions)
    merged = merge(part, _contenders(part, batch, keys, keep_newer), keys, order)
    merged = merged.select(*map(quoted, stored.columns))
    _overwrite_partitions(merged, target, partitions, rows_per_file, cluster_by)
    _drop_partitions(batch.sparkSession, target, partitions, touched.filter("__left = 0"))


def _overwrite_partitions(
    df: DataFrame,
    target: Target,
    partitions,
    rows_per_file,
    cluster_by: Sequence[str] = (),
    laid_out: bool = False,
) -> None:
    """Replace exactly the partitions ``df`` has rows for. Its columns are in the table's order."""
    out = df if laid_out else lay_out(df, partitions, cluster_by)
    if target.is_folder:
        fresh = Target.folder(f"{target.location}__next-{uuid4().hex}", target.fmt)
        _save(_writer(out, fresh, "errorifexists", partitions, rows_per_file), fresh)
        target.swap_in_partitions(df.sparkSession, fresh.location)
    else:
        with _dynamic_overwrite(df.sparkSession):
            _writer(out, target, "overwrite", (), rows_per_file).insertInto(target.location, True)


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Overwrite only the partitions that get rows, for writes into a catalog table.

    Those ignore the writer's option of that name and would empty the table, so the session's
    setting has to hold it. Loads side by side share a session: the first one to need the setting
    makes it and the last one to finish puts the old value back.
    """
    name, session = "spark.sql.sources.partitionOverwriteMode", spark._jsparkSession.hashCode()
    with _SETTING:
        if session not in _WRITING:
            _WRITING[session] = [0, spark.conf.get(name)]
            spark.conf.set(name, "dynamic")
        _WRITING[session][0] += 1
    try:
        yield
    finally:
        with _SETTING:
            _WRITING[session][0] -= 1
            if _WRITING[session][0] == 0:
                spark.conf.set(name, _WRITING.pop(session)[1])


_SETTING = Lock()
_WRITING: dict[int, list] = {}


def _drop_partitions(spark: SparkSession, target: Target, partitions, gone: DataFrame) -> None:
    """Drop the partitions of ``gone`` (``__p0`` ... as text), which arrive one by one."""
    files = FileTree(spark)
    for row in gone.select(*[f"__p{i}" for i in range(len(partitions))]).toLocalIterator():
        if target.is_folder:
            steps = "/".join(f"{n}={_folder_text(v)}" for n, v in zip(partitions, row))
            files.delete(f"{target.location}/{steps}")
        else:
            spec = ", ".join(f"`{n}` = {_sql_text(v)}" for n, v in zip(partitions, row))
            spark.sql(f"ALTER TABLE {target.location} DROP IF EXISTS PARTITION ({spec})")


def _sql_text(value: str) -> str:
    if value == NULL_PARTITION:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _folder_text(value: str) -> str:
    """A partition value as Spark spells it in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in value)


# Characters that are escaped in partition folder names.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _merge_in_place(batch: DataFrame, target: Target, keys, order, keep_newer: bool) -> None:
    """W3 on a format with row-level operations: Spark's own MERGE."""
    source = latest_per_key(batch.filter(all_set(keys)), keys, order).alias("source")
    order = [order] if isinstance(order, str) else list(order)

    def side(name: str, column: str) -> Column:
        return F.col(f"{name}.`{column}`")

    same = F.lit(True)
    for key in keys:
        same = same & (side(target.location, key) == side("source", key))
    newer = None
    if keep_newer and order:
        arriving = F.struct(*[side("source", o).alias(o) for o in order])
        newer = arriving >= F.struct(*[side(target.location, o).alias(o) for o in order])
    into = source.mergeInto(target.location, same)
    matched = into.whenMatched() if newer is None else into.whenMatched(newer)
    matched.updateAll().whenNotMatched().insertAll().merge()


def retain_table(
    spark: SparkSession, target: Target, column: str, as_of: datetime, days: int = 7
) -> None:
    """drop stored rows older than ``days``; rows without a date stay.

    If the table is partitioned by that date alone, whole partitions before the cut-off day are
    dropped without reading a row. Other rows are found by the files' own statistics
    (:func:`delete_rows`): when nothing has expired no row is read and no file is touched, and a
    file whose rows have all expired is deleted and not rewritten.
    """
    if days < 0:
        raise ValueError("retention days cannot be negative")
    stored = target.read(spark)
    partitions = target.partition_columns(spark)
    day = next((p for p in (f"{column}_date", column) if partitions == [p]), None)
    oldest = as_of - timedelta(days=days)
    expired = quoted(column) < typed_literal(oldest, stored.schema[column].dataType)
    if day is None:
        delete_rows(spark, target, expired)
        return
    cutoff = F.lit(oldest.date().isoformat()).cast("date")
    gone = stored.filter(quoted(day) < cutoff).select(_as_text(day).alias("__p0")).distinct()
    with staged(gone, "expired") as gone:
        _drop_partitions(spark, target, partitions, gone)
    if day != column:
        edge = quoted(day) == cutoff
        delete_rows(spark, target, edge & expired)
        if target.read(spark).filter(edge).isEmpty():
            one = spark.range(1).select(cutoff.cast("string").alias("__p0"))
            _drop_partitions(spark, target, partitions, one)


def stored_files(spark: SparkSession, target: Target, partitions: Sequence[str] = ()) -> DataFrame:
    """``path``, ``length`` and ``__p0`` ... of a table's files, from one listing; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = listed.load(target.path(spark)).select("path", "length")
    values = {}
    for i, name in enumerate(partitions):
        found = F.regexp_extract("path", "/" + re.escape(name) + "=([^/]*)/", 1)
        values[f"__p{i}"] = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    return listed.withColumns(values) if values else listed


def compact(
    spark: SparkSession,
    target: Target,
    target_bytes: int = 256 * 1024 * 1024,
    cluster_by: Sequence[str] = (),
) -> None:
    """Rewrite small files into files of about ``target_bytes``; the rows do not change.

    A table, or a partition of one, is left alone unless it holds more than twice the files it
    needs. That is found from a listing of names and sizes alone, which stays a frame: the crowded
    partitions, however many, are read by a semi-join and dealt to as many files as each needs.
    """
    partitions = target.partition_columns(spark)
    places = [f"__p{i}" for i in range(len(partitions))]
    needed = F.greatest(F.lit(1), F.ceil(F.sum("length") / target_bytes)).alias("__needed")
    per = stored_files(spark, target, partitions).groupBy(*places)
    crowded = per.agg(F.count(F.lit(1)).alias("__files"), needed, F.lit(1).alias("__touched"))
    with staged(crowded.filter("__files > 2 * __needed"), "crowded") as crowded:
        if crowded.isEmpty():
            return
        stored = _with_text_partitions(spark, target, partitions)
        if not partitions:
            files = crowded.first()["__needed"]
            _replace(stored, target, True, (), cluster_by, int(files), keep_ledger=True)
            return
        rows = _in_partitions(stored, crowded, partitions)
        if cluster_by:
            _overwrite_partitions(rows, target, partitions, None, cluster_by)
            return
        same = [_as_text(p) == F.col(place) for p, place in zip(partitions, places)]
        bins = crowded.select(*places, "__needed")
        dealt = rows.join(bins, reduce(and_, same)).drop(*places)
        bin_of = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__needed"))
        dealt = dealt.withColumn("__bin", bin_of).drop("__needed")
        # A number of its own keeps adaptive execution from joining the bins again.
        tasks = min(2 * crowded.agg(F.sum("__needed")).first()[0], MOST_TASKS)
        dealt = dealt.repartition(tasks, *map(quoted, partitions), F.col("__bin")).drop("__bin")
        _overwrite_partitions(dealt, target, partitions, None, laid_out=True)
