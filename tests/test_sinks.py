from datetime import date, datetime
from random import Random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from loadweir.sinks import jdbc
from loadweir.sinks import tables as sink
from loadweir.sinks.ledger import LoadLedger
from loadweir.sinks.target import PREVIOUS, Dataset, FileTree, Target

SCHEMA = "id int, ts int, p string, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture(params=["folder", "table"])
def target(request, folder):
    if request.param == "folder":
        return Target.folder(folder)
    return Target.table(f"{request.getfixturevalue('schema')}.t")


def test_append_and_replace(spark, target, rows):
    one, two = frame(spark, (1, 1, "a", "x")), frame(spark, (2, 1, "b", "y"))
    sink.write_table(one, target, partition_by=["p"])
    sink.write_table(two, target)
    assert rows(target.read(spark), "id", "p") == [(1, "a"), (2, "b")]
    assert target.partition_columns(spark) == ["p"]
    # A replace drops partitions the batch does not have.
    sink.write_table(two, target, "replace", partition_by=["p"])
    assert rows(target.read(spark), "id", "p") == [(2, "b")]


def test_append_evolves_the_table(spark, target, rows):
    sink.write_table(spark.sql("SELECT 1L AS id"), target)
    sink.write_table(spark.sql("SELECT 2 AS ID, 'x' AS extra"), target)
    sink.write_table(spark.sql("SELECT 3L AS id"), target)
    assert rows(target.read(spark), "id", "extra") == [(1, None), (2, "x"), (3, None)]
    with pytest.raises(ValueError, match="would widen"):
        sink.write_table(spark.sql("SELECT 4.5D AS id"), target)


def test_replace_may_read_its_own_target(spark, target, rows):
    sink.write_table(frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y")), target)
    sink.write_table(target.read(spark).filter("id = 2"), target, "replace")
    assert rows(target.read(spark), "id") == [(2,)]


def test_swap_recovers_from_a_stop_in_between(spark, folder, rows):
    target, files = Target.folder(folder), FileTree(spark)
    sink.write_table(frame(spark, (1, 1, "a", "x")), target)
    files.move(folder, folder + PREVIOUS)
    assert target.exists(spark)
    assert rows(target.read(spark), "id") == [(1,)]
    # Stopped after the second rename: the old rows go.
    sink.write_table(frame(spark, (9, 9, "z", "old")), Target.folder(folder + PREVIOUS))
    assert target.exists(spark)
    assert not files.exists(folder + PREVIOUS)
    assert rows(target.read(spark), "id") == [(1,)]


def test_a_stopped_partition_swap_loses_nothing(spark, folder, rows, monkeypatch):
    target = Target.folder(folder)
    start = frame(spark, (1, 1, "a", "x"), (2, 1, "a", "kept"), (3, 1, "b", "x"), (4, 1, "b", "kept"))
    batch = frame(spark, (1, 2, "a", "new"), (3, 2, "b", "new"))
    want = [(1, "new"), (2, "kept"), (3, "new"), (4, "kept")]
    for stop_after in (1, 2, 3):
        sink.write_table(start, target, "replace", partition_by=["p"])
        moves, move = [], FileTree.move

        def stopping(self, old, new):
            if len(moves) == stop_after:
                raise RuntimeError("driver lost")
            moves.append(new)
            move(self, old, new)

        with monkeypatch.context() as broken:
            broken.setattr(FileTree, "move", stopping)
            with pytest.raises(RuntimeError, match="driver lost"):
                sink.merge_table(batch, target, "id", "ts", ["p"])
        sink.merge_table(batch, target, "id", "ts", ["p"])
        assert rows(target.read(spark), "id", "v") == want


def test_a_failed_replace_leaves_the_table_whole(spark, target, rows):
    sink.write_table(frame(spark, (1, 1, "a", "x")), target)
    broken = frame(spark, (2, 0, "b", "y")).withColumn("ts", F.expr("1 div ts"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sink.write_table(broken, target, "replace")
    assert rows(target.read(spark), "id") == [(1,)]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_a_replaced_catalog_table_moves(spark, schema, rows, partition_by):
    target = Target.table(f"{schema}.moved")
    sink.write_table(frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y")), target, partition_by=partition_by)
    first = target.path(spark)
    # It may read itself, bring a new column, and keeps its kind.
    wide = target.read(spark).filter("id = 2").selectExpr("id", "ts", "p", "v", "id * 2 AS extra")
    sink.write_table(wide, target, "replace", partition_by)
    second = target.path(spark)
    assert rows(target.read(spark), "id", "p", "v", "extra") == [(2, "b", "y", 4)]
    assert second != first and not FileTree(spark).exists(first)
    assert (target.described(spark)["Type"], target.partition_columns(spark)) == ("MANAGED", partition_by)
    # A write that fails changes nothing and leaves nothing.
    broken = frame(spark, (3, 1, "c", "z")).selectExpr("raise_error('no') AS id", "ts", "p", "v", "1 AS extra")
    with pytest.raises(Exception, match="no"):
        sink.write_table(broken.withColumn("id", F.col("id").cast("int")), target, "replace", partition_by)
    assert target.path(spark) == second and rows(target.read(spark), "id") == [(2,)]
    parent, name = first.rsplit("/", 1)
    files, where = FileTree(spark)._open(parent)
    assert [x.getPath().getName() for x in files.listStatus(where) if x.getPath().getName().startswith(name)] == [
        second.rsplit("/", 1)[1]
    ]
    # Later writes follow it, and its marks of loads do too.
    load = frame(spark, (5, 1, "b", "w")).withColumns({"extra": F.lit(1), "_load_id": F.lit("l1")})
    assert sink.append_once_table(load, target, "l1")
    sink._replace(target.read(spark), target, True, partition_by, keep_ledger=True)
    assert target.path(spark) != second and not sink.append_once_table(load, target, "l1")
    sink.merge_table(frame(spark, (5, 2, "a", "new")), target, "id")
    assert rows(target.read(spark), "id", "v") == [(2, "y"), (5, "new")]
    spark.sql(f"DROP TABLE {target.location}")
    sink.write_table(frame(spark, (1, 1, "a", "x")), target)
    assert rows(target.read(spark), "id") == [(1,)]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_replaced_external_table_leaves_its_first_folder(spark, schema, folder, rows, fmt):
    target = Target.table(f"{schema}.outside_{fmt}", fmt)
    frame(spark, (1, 1, "a", "x")).write.format(fmt).option("path", folder).saveAsTable(target.location)
    for n in (2, 3):
        before = target.path(spark)
        sink.write_table(frame(spark, (n, 1, "a", "x")), target, "replace")
        assert rows(target.read(spark), "id") == [(n,)]
        assert FileTree(spark).exists(before) == (n == 2)


def test_a_catalog_table_of_other_types_is_written_again(spark, schema, rows):
    target = Target.table(f"{schema}.retyped")
    sink.write_table(frame(spark, (1, 1, "a", "x")), target)
    sink.write_table(spark.sql("SELECT 'one' AS id"), target, "replace")
    assert rows(target.read(spark), "id") == [("one",)]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_merge_is_idempotent(spark, target, rows, partition_by):
    start = frame(spark, (1, 1, "a", "keep"), (2, 1, "a", "old"), (3, 1, "b", "moves"), (4, 1, None, "n"))
    batch = frame(
        spark, (2, 2, "a", "new"), (2, 3, "a", "newer"), (3, 2, "c", "moved"), (5, 1, "d", "add"),
        (4, 2, "a", "named"), (None, 1, "a", "rejected"),
    )
    sink.merge_table(start, target, "id", "ts", partition_by)
    want = [
        (1, 1, "a", "keep"), (2, 3, "a", "newer"), (3, 2, "c", "moved"), (4, 2, "a", "named"),
        (5, 1, "d", "add"),
    ]
    for _ in range(2):
        sink.merge_table(batch, target, "id", "ts", partition_by)
        assert rows(target.read(spark), "id", "ts", "p", "v") == want


@pytest.mark.parametrize("keep_newer", [False, True])
@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_merges_agree_with_a_dictionary(spark, folder, rows, partition_by, keep_newer):
    """Random batches with repeated keys, ties, NULL keys and partitions that empty and return."""
    random = Random(7)
    target, model = Target.folder(folder), {}

    def rank(row):  # greatest first by time, then by the other columns; NULL is the least
        return [(x is not None, x if x is not None else 0) for x in (row[1], row[2], row[3])]

    for _ in range(4):
        batch = [
            (
                random.choice([None, *range(12)]),
                random.choice([None, *range(4)]),
                random.choice(["a", "b", "c", "d", None]),
                random.choice("xyz"),
            )
            for _ in range(25)
        ]
        best = {}
        for row in batch:
            if row[0] is not None and (row[0] not in best or rank(row) > rank(best[row[0]])):
                best[row[0]] = row
        for key, row in best.items():
            if not keep_newer or key not in model or rank(row) > rank(model[key]):
                model[key] = row
        sink.merge_table(frame(spark, *batch), target, "id", "ts", partition_by, keep_newer=keep_newer)
        assert rows(target.read(spark), "id", "ts", "p", "v") == sorted(model.values(), key=repr)


def test_merge_leaves_other_partitions_alone(spark, folder):
    target = Target.folder(folder)
    sink.write_table(
        frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y")), target, "replace", partition_by=["p"]
    )
    before = {f for f in target.read(spark).inputFiles() if "p=b" in f}
    sink.merge_table(frame(spark, (1, 2, "a", "z")), target, "id", "ts", ["p"])
    assert {f for f in target.read(spark).inputFiles() if "p=b" in f} == before


def test_touched_partitions_prune_folders(spark, target):
    sink.write_table(frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y")), target, partition_by=["p"])
    stored = target.read(spark)
    wanted = spark.sql("SELECT 'a' AS __p0, 1 AS __touched")
    with sink.staged(wanted, "touched") as touched:
        part = sink._in_partitions(stored, touched, ["p"])
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan and [r.id for r in part.collect()] == [1]


@pytest.mark.parametrize("touched", [3, 40])
def test_merge_rewrites_touched_partitions_alone(spark, folder, touched):
    """However many partitions a merge touches, the files of the others stay."""
    target = Target.folder(folder)
    start = spark.range(touched + 3).selectExpr("id", "1 AS ts", "CAST(id AS STRING) AS p", "'old' AS v")
    sink.write_table(start.coalesce(4), target, partition_by=["p"])
    before = set(target.read(spark).inputFiles())
    batch = start.filter(f"id < {touched}").withColumns({"ts": F.lit(2), "v": F.lit("new")})
    sink.merge_table(batch, target, "id", "ts", ["p"])
    stored = target.read(spark)
    left = {f for f in stored.inputFiles() if f in before}
    assert len(left) == 3 and {f.split("/p=")[1].split("/")[0] for f in left} == {str(touched + i) for i in range(3)}
    assert {r.v: r["count"] for r in stored.groupBy("v").count().collect()} == {"new": touched, "old": 3}


def test_merge_drops_an_emptied_partition(spark, target, rows):
    sink.write_table(frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y")), target, partition_by=["p"])
    sink.merge_table(frame(spark, (1, 2, "b", "z")), target, "id", "ts", ["p"])
    assert rows(target.read(spark), "id", "p", "v") == [(1, "b", "z"), (2, "b", "y")]


def test_merge_when_partitions_are_fixed_per_key(spark, target, rows):
    sink.write_table(frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y")), target, partition_by=["p"])
    batch = frame(spark, (1, 2, "a", "z"))
    sink.merge_table(batch, target, "id", "ts", ["p"], partition_fixed=True)
    assert rows(target.read(spark), "id", "v") == [(1, "z"), (2, "y")]


def test_merge_with_odd_partition_values(spark, folder, rows):
    target = Target.folder(folder)
    start = frame(spark, (1, 1, "007", "x"), (2, 1, "a/b=c", "y"), (3, 1, "50%", "z"))
    sink.write_table(start, target, partition_by=["p"])
    sink.merge_table(frame(spark, (2, 2, "007", "moved")), target, "id", "ts", ["p"])
    kinds = {"p": start.schema["p"].dataType}
    assert rows(target.read(spark, kinds), "id", "p") == [(1, "007"), (2, "007"), (3, "50%")]


def test_merge_with_two_partition_columns(spark, target, rows):
    def cells(*values):
        return spark.createDataFrame(list(values), "id int, v string, p string, d date")

    day, other = date(2024, 1, 1), date(2024, 1, 2)
    start = cells(
        (1, "x", "o'b", day), (2, "x", "o'b", other), (3, "x", None, day), (4, "x", "c\\d", None),
        (5, "kept", "o'b", day), (6, "far", "z", other),
    )
    sink.write_table(start, target, partition_by=["p", "d"])
    far = {f for f in target.read(spark).inputFiles() if "p=z" in f}
    batch = cells((1, "y", "o'b", day), (2, "y", None, day), (4, "y", "c\\d", None), (7, "new", "n", None))
    sink.merge_table(batch, target, "id", [], ["p", "d"])
    assert rows(target.read(spark), "id", "v", "p", "d") == [
        (1, "y", "o'b", day), (2, "y", None, day), (3, "x", None, day), (4, "y", "c\\d", None),
        (5, "kept", "o'b", day), (6, "far", "z", other), (7, "new", "n", None),
    ]
    assert {f for f in target.read(spark).inputFiles() if "p=z" in f} == far


def test_merge_with_a_new_column(spark, target, rows):
    sink.write_table(frame(spark, (1, 1, "a", "x")), target, partition_by=["p"])
    batch = frame(spark, (2, 1, "b", "y")).withColumn("flag", F.lit(True))
    sink.merge_table(batch, target, "id", "ts", ["p"])
    assert rows(target.read(spark), "id", "p", "flag") == [(1, "a", None), (2, "b", True)]


def test_merge_with_a_new_column_rewrites_touched_partitions_alone(spark, target, rows):
    sink.write_table(frame(spark, (1, 1, "a", "x"), (2, 1, "b", "y"), (3, 1, "c", "z")), target, partition_by=["p"])
    far = {f for f in target.read(spark).inputFiles() if "p=c" in f}
    batch = frame(spark, (1, 2, "a", "new"), (4, 1, "b", "add")).withColumn("flag", F.lit(True))
    sink.merge_table(batch, target, "id", "ts", ["p"])
    stored = target.read(spark)
    assert rows(stored, "id", "v", "flag") == [(1, "new", True), (2, "y", None), (3, "z", None), (4, "add", True)]
    assert {f for f in stored.inputFiles() if "p=c" in f} == far
    sink.merge_table(frame(spark, (3, 2, "c", "last")), target, "id", "ts", ["p"])
    assert rows(target.read(spark), "id", "flag") == [(1, True), (2, None), (3, None), (4, True)]


def test_a_folder_keeps_its_schema(spark, folder, rows):
    """Reads are planned without opening files, and partition values keep their type."""
    target = Target.folder(folder)
    sink.write_table(frame(spark, (1, 1, "007", "x")), target, partition_by=["p"])
    sink.write_table(frame(spark, (2, 1, "08", "y")).withColumn("extra", F.lit(1.5)), target)
    stored = target.read(spark)
    assert stored.schema["p"].dataType.simpleString() == "string" and "extra" in stored.columns
    assert rows(stored, "id", "p", "extra") == [(1, "007", None), (2, "08", 1.5)]
    sink.write_table(spark.range(1), target, "replace")
    assert target.read(spark).columns == ["id"]


def test_keep_newer(spark, target, rows):
    sink.write_table(frame(spark, (1, 5, "a", "newest"), (2, 1, "a", "old")), target)
    batch = frame(spark, (1, 3, "a", "late"), (2, 2, "a", "new"))
    sink.merge_table(batch, target, "id", "ts", keep_newer=True)
    assert rows(target.read(spark), "id", "v") == [(1, "newest"), (2, "new")]


def test_append_once(spark, target, rows):
    batch = spark.range(3).withColumn("_load_id", F.lit("l1"))
    assert sink.append_once_table(batch, target, "l1")
    assert not sink.append_once_table(batch, target, "l1")
    assert sink.append_once_table(batch.withColumn("_load_id", F.lit("l2")), target, "l2")
    assert target.read(spark).count() == 6


@pytest.mark.parametrize("partition_by", [[], ["p"]])
@pytest.mark.parametrize("begun", [False, True])
def test_a_torn_append_is_replaced(spark, target, rows, partition_by, begun):
    """Some rows of a load are there, as a commit that stopped between two files leaves them."""
    def load(name, ids):
        return spark.createDataFrame([(i, "ab"[i % 2], name) for i in ids], "id int, p string, _load_id string")

    assert sink.append_once_table(load("l1", range(5)), target, "l1", partition_by=partition_by)
    batch = load("l2", range(10, 20))
    ledger = LoadLedger(spark, target)
    if begun:
        ledger.begin("l2")
    else:
        ledger.clear()
    sink.write_table(batch.filter("id < 13"), target)
    assert sink.append_once_table(batch, target, "l2")
    assert not sink.append_once_table(batch, target, "l2")
    assert sorted(rows(target.read(spark), "id")) == [(i,) for i in [*range(5), *range(10, 20)]]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_a_torn_append_in_files_of_others(spark, target, rows, partition_by):
    mixed = spark.createDataFrame([(1, "a", "l1"), (2, "a", "l2"), (3, "b", "l2"), (4, "c", "l1")], "id int, p string, _load_id string")
    sink.write_table(mixed.coalesce(1), target, partition_by=partition_by)
    far = {f for f in target.read(spark).inputFiles() if "p=c" in f}
    batch = mixed.filter("_load_id = 'l2'").withColumn("id", F.col("id") + 10)
    assert sink.append_once_table(batch, target, "l2")
    assert sorted(rows(target.read(spark), "id", "p")) == [(1, "a"), (4, "c"), (12, "a"), (13, "b")]
    assert far <= set(target.read(spark).inputFiles())


def test_a_replaced_table_forgets_its_loads(spark, target):
    batch = spark.range(3).withColumn("_load_id", F.lit("l1"))
    assert sink.append_once_table(batch, target, "l1")
    sink.write_table(batch.limit(0), target, "replace")
    assert sink.append_once_table(batch, target, "l1")
    assert target.read(spark).count() == 3


def test_retention_deletes_whole_files_and_rewrites_none(spark, target):
    """Files of one day each: those that have expired go, the others stay as they are."""
    for day in (1, 2, 9):
        df = spark.sql(f"SELECT {day} AS id, TIMESTAMP'2024-01-0{day} 10:00:00' AS ts")
        sink.write_table(df, target)
    before = set(target.read(spark).inputFiles())
    sink.retain_table(spark, target, "ts", datetime(2024, 1, 8), 7)
    assert set(target.read(spark).inputFiles()) == before
    sink.retain_table(spark, target, "ts", datetime(2024, 1, 10, 12), 7)
    after = target.read(spark)
    assert [r.id for r in after.collect()] == [9] and set(after.inputFiles()) < before


def test_compaction_deals_rows_to_as_many_files_as_needed(spark, folder):
    target = Target.folder(folder)
    rows = spark.range(0, 20_000, 1, 1).selectExpr("id", "sha2(string(id), 256) AS v", "'007' AS p")
    sink.write_table(rows, target, partition_by=["p"], rows_per_file=500)
    size = sum(r.length for r in sink.stored_files(spark, target, ["p"]).collect())
    sink.compact(spark, target, target_bytes=size // 3)
    files = sink.stored_files(spark, target, ["p"]).collect()
    assert 2 <= len(files) <= 4 and {r["__p0"] for r in files} == {"007"}
    assert target.read(spark).agg(F.sum("id"), F.count("*")).first()[:] == (199_990_000, 20_000)


def test_timestamps_partition_by_day(spark, target, rows):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-01 23:00:00' AS ts")
    for _ in range(2):
        sink.write_table(df, target, partition_by=["ts"])
    assert target.partition_columns(spark) == ["ts_date"]
    assert target.read(spark).filter("ts_date = DATE'2024-01-01'").count() == 2
    with pytest.raises(ValueError, match="not found"):
        sink.write_table(df, target, "replace", partition_by=["day"])


def test_no_row_lands_in_the_null_partition_for_want_of_a_column(spark, target, rows):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-01 23:00:00' AS ts")
    sink.write_table(df, target, partition_by=["ts"])
    sink.write_table(df.withColumn("id", F.lit(2)), target)
    sink.merge_table(df.withColumn("id", F.lit(3)), target, "id", "ts")
    assert target.read(spark).filter("ts_date = DATE'2024-01-01'").count() == 3
    for write in (lambda d: sink.write_table(d, target), lambda d: sink.merge_table(d, target, "id")):
        with pytest.raises(ValueError, match="lack the partition column 'ts_date'"):
            write(spark.sql("SELECT 9 AS id"))


def test_a_hot_partition_is_split(spark, folder):
    # Rows that fill one partition are spread over several tasks once they exceed the advised size.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
        df = df.withColumn("p", F.when(F.col("id") % 10 == 0, "cold").otherwise("hot"))
        sink.write_table(df, Target.folder(folder), "replace", partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(folder).filter("p = 'hot'").select(F.input_file_name()).distinct()
    assert files.count() > 2


def ranges(spark, folder, column):
    by_file = spark.read.parquet(folder).groupBy(F.input_file_name().alias("f"))
    spans = by_file.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("n"))
    return sorted((r.lo, r.hi, r.n) for r in spans.collect())


def test_clustered_files_do_not_overlap(spark, folder):
    df = spark.range(0, 10_000, 1, 4).select((F.col("id") * 7919 % 10_000).alias("k"))
    sink.write_table(df, Target.folder(folder), "replace", cluster_by=["k"], parallelism=4)
    spans = ranges(spark, folder, "k")
    assert len(spans) == 4
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_clustered_ranges_grow_in_number_not_in_size(spark, folder, monkeypatch):
    df = spark.range(0, 10_000, 1, 4).select(
        (F.col("id") * 7919 % 10_000).alias("k"), F.array("id").alias("a"), F.lit("x" * 100).alias("s")
    )
    monkeypatch.setattr(sink, "RANGE_BYTES", 170_000)
    sink.write_table(df, Target.folder(folder), "replace", cluster_by=["k"], parallelism=4)
    spans = ranges(spark, folder, "k")
    assert sum(n for _, _, n in spans) == 10_000 and len(spans) >= 10
    assert max(n for _, _, n in spans) < 2_000
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_a_hot_cluster_value_spans_files(spark, folder):
    df = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k")
    )
    sink.write_table(df, Target.folder(folder), "replace", cluster_by=["k"], parallelism=6)
    spans = ranges(spark, folder, "k")
    assert sum(n for _, _, n in spans) == 30_000
    assert max(n for _, _, n in spans) < 10_000


def test_bounded_files(spark, folder):
    target = Target.folder(folder)
    sink.write_table(spark.range(1000), target, rows_per_file=100, parallelism=2)
    assert len(target.read(spark).inputFiles()) == 10


def test_compaction(spark, target):
    sink.write_table(spark.range(1000), target, parallelism=10)
    assert len(target.read(spark).inputFiles()) == 10
    sink.compact(spark, target)
    after = target.read(spark)
    assert len(after.inputFiles()) == 1
    assert after.agg(F.sum("id"), F.count("*")).first()[:] == (499_500, 1000)


def test_compaction_rewrites_crowded_partitions_only(spark, target):
    many = spark.range(0, 1000, 1, 1).select("id", F.lit("crowded").alias("p"))
    few = spark.range(1000, 2000).select("id", F.lit("tidy").alias("p"))
    sink.write_table(few, target, partition_by=["p"])
    sink.write_table(many, target, rows_per_file=100)
    tidy = {f for f in target.read(spark).inputFiles() if "p=tidy" in f}
    sink.compact(spark, target)
    files = target.read(spark).inputFiles()
    assert {f for f in files if "p=tidy" in f} == tidy
    assert len(files) == len(tidy) + 1
    assert target.read(spark).agg(F.sum("id"), F.count("*")).first()[:] == (1_999_000, 2000)


def test_retention_by_partition_and_by_row(spark, target, rows):
    df = spark.sql(
        "SELECT id, CAST(ts AS TIMESTAMP) AS ts FROM VALUES (1, '2024-01-01 10:00:00'), "
        "(2, '2024-01-03 10:00:00'), (3, '2024-01-03 14:00:00'), (4, '2024-01-09'), (5, NULL) AS t(id, ts)"
    )
    as_of = datetime(2024, 1, 10, 12)
    for partition_by in (["ts"], []):
        sink.write_table(df, target, "replace", partition_by=partition_by)
        sink.retain_table(spark, target, "ts", as_of, 7)
        assert rows(target.read(spark), "id") == [(3,), (4,), (5,)]


def test_retention_may_empty_the_edge_day(spark, target, rows):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-03 10:00:00'), (2, TIMESTAMP'2024-01-09') AS t(id, ts)")
    sink.write_table(df, target, "replace", partition_by=["ts"])
    sink.retain_table(spark, target, "ts", datetime(2024, 1, 10, 12), 7)
    assert rows(target.read(spark), "id") == [(2,)]


def test_addresses():
    data = Dataset(catalog="dev", schema="video", prefix="raw_")
    assert data.address("channelStats").location == "`dev`.`video`.`raw_channel_stats`"
    assert Dataset(root="/data/x/").address("posts") == Target.folder("/data/x/posts")
    with pytest.raises(ValueError):
        Dataset()


class Writer:
    """Records a JDBC write: no database is started in tests."""

    def __init__(self):
        self.calls = []

    def option(self, name, value):
        self.calls.append((name, value))
        return self

    def jdbc(self, url, table, mode, properties):
        self.calls.append((table, mode))


class Frame:
    columns = ["id", "v"]

    def __init__(self):
        self.write = Writer()

    def coalesce(self, n):
        self.write.calls.append(("coalesce", n))
        return self


def test_jdbc_writes(monkeypatch):
    df = Frame()
    jdbc.write_jdbc(df, "jdbc:x", "t", "append", parallelism=3)
    jdbc.write_jdbc(df, "jdbc:x", "t", "replace")
    assert df.write.calls == [("coalesce", 3), ("t", "append"), ("truncate", True), ("t", "overwrite")]
    with pytest.raises(ValueError, match="primary key"):
        jdbc.write_jdbc(df, "jdbc:x", "t", "merge")


def test_jdbc_merges_do_not_share_a_staging_table(spark, monkeypatch):
    written, ran = [], []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda _, url, table, mode, properties: written.append((table, mode)))
    df = spark.sql("SELECT 1 AS a, 'x' AS v UNION ALL SELECT 1, 'x'")
    for _ in range(2):
        jdbc.write_jdbc(df, "jdbc:x", "t", "merge", keys=["a"], execute=ran.append)
    (one, mode), (two, _) = written
    assert one != two and one.startswith("t_") and mode == "overwrite"
    assert ran[:2] == [jdbc.merge_statements("t", one, ["a"], ["a", "v"]), [f"DROP TABLE {one}"]]

    def failing(statements):
        ran.append(statements)
        raise RuntimeError("no")

    ran.clear()
    with pytest.raises(RuntimeError):
        jdbc.write_jdbc(df, "jdbc:x", "t", "merge", keys=["a"], execute=failing)
    assert len(ran) == 1


def test_jdbc_merge_statements():
    delete, insert = jdbc.merge_statements("t", "t_staging", ["a", "b"], ["a", "b", "v"])
    assert delete == (
        'DELETE FROM t WHERE EXISTS (SELECT 1 FROM t_staging WHERE '
        't."a" = t_staging."a" AND t."b" = t_staging."b")'
    )
    assert insert == 'INSERT INTO t ("a", "b", "v") SELECT "a", "b", "v" FROM t_staging'
