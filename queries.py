"""One function per registered query: ``(spark, sf_dir) -> DataFrame`` over the given tables.

Faults are planted by arithmetic on keys, the same way as in ``oracle.py``. Queries about storage
write whole tables to a fresh folder under the cluster's shared directory and read them back.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import json_get
from loadweir.operators import columns as cols
from loadweir.operators import conform as con
from loadweir.operators import cursor as cur
from loadweir.operators import merging as mrg
from loadweir.operators import metrics as met
from loadweir.operators import nested, quality
from loadweir.plans.configured import load_configured
from loadweir.plans.load import LoadOptions, load_frame, load_resource, load_resources
from loadweir.session import shared_dir
from loadweir.sinks import tables as sink
from loadweir.sinks.ledger import LoadLedger
from loadweir.sinks.target import Dataset, Target
from loadweir.sources import readers
from loadweir.sources.params import bind_params, read_query
from loadweir.sources.registry import open_source, select_resources
from loadweir.spec import Check, Column, Incremental, Parent, ResourceSpec
from loadweir.streaming import streams

AS_OF = datetime(2024, 1, 31)
LOADED_AT = datetime(2024, 2, 1)
NTZ = T.TimestampNTZType()

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
ORDERS_CONTRACT = (
    Column("o_orderkey", "integer", nullable=False, primary_key=True),
    Column("o_custkey", "integer", nullable=False),
    Column("o_orderstatus", "string"),
    Column("o_totalprice", "float"),
    Column("o_orderdate", "timestamp", nullable=False),
    Column("o_orderpriority", "string"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    """Register ``run`` under its own name. Zone-less times are compared under UTC."""

    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    in_utc.__name__, in_utc.__doc__ = run.__name__, run.__doc__
    QUERIES[run.__name__] = in_utc
    return in_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream, whether it is stored as one file or as a folder."""
    schema = table(spark, sf_dir, name).schema
    if os.path.isfile(f"{sf_dir}/{name}.parquet"):
        only = {"pathGlobFilter": f"{name}.parquet"}
        return readers.read_stream(spark, sf_dir, "parquet", schema, options=only)
    return readers.read_stream(spark, f"{sf_dir}/{name}.parquet", "parquet", schema)


def zoneless(df: DataFrame) -> DataFrame:
    """Times without a zone, as the given tables have them."""
    casts = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df


# ---- sources ----------------------------------------------------------------------------------


@query
def src_json_records(spark, sf_dir):
    """A JSON body per row becomes typed columns."""
    events = table(spark, sf_dir, "events")
    rows = readers.parse_json_records(events, "props", "k BIGINT", keep=("event_id",))
    return rows.select("event_id", "k")


@query
def src_file_scan(spark, sf_dir):
    """A file under a declared schema, pruned and filtered at the scan."""
    orders = readers.read_files(spark, f"{sf_dir}/orders.parquet", "parquet", ORDERS_SCHEMA)
    return orders.filter(F.col("o_totalprice") > 250000.0).select("o_orderkey", "o_totalprice")


@query
def src_open_source(spark, sf_dir):
    """The same scan through the source registry."""
    path = f"{sf_dir}/customer.parquet"
    schema = "c_custkey bigint, c_nationkey int, c_mktsegment string"
    return open_source(spark, "file", path=path, fmt="parquet", schema=schema)


@query
def src_landing_format(spark, sf_dir):
    """Events landed as compressed JSON lines, opened by their source type."""
    folder = shared_dir(spark, "landing")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    events.write.option("compression", "gzip").json(folder)
    landed = open_source(
        spark, "landing", path=folder, schema="event_id bigint, user_id bigint, event_type string"
    )
    return landed.filter(F.col("_corrupt_record").isNull()).select(*events.columns)


@query
def src_json_bodies(spark, sf_dir):
    """Compressed bodies, each an array of an event's record and a marker; some are broken or of another type.

    Only ids and marks are read back, and no record is lost or passes for a good one.
    """
    folder = shared_dir(spark, "bodies")
    turn = F.col("event_id") % 10
    good = F.to_json(F.struct("event_id", "user_id"))
    wrong = F.to_json(F.struct("event_id", F.col("event_type").alias("user_id")))
    record = F.when(turn == 0, wrong).otherwise(good)
    array = F.concat(F.lit("["), record, F.lit(', {"user_id": -1}]'))
    body = F.when(turn == 1, F.concat(F.lit('{"event_id": '), "event_type")).otherwise(array)
    table(spark, sf_dir, "events").select(body.alias("value")).write.option("compression", "gzip").text(folder)
    landed = open_source(spark, "landing", path=folder, schema="event_id bigint, user_id bigint")
    outcome = F.when(F.col("_corrupt_record").isNotNull(), "corrupt").otherwise("good")
    return landed.groupBy(outcome.alias("outcome"), F.col("event_id").isNull().alias("no_id")).agg(F.count("*").alias("n"))


@query
def src_param_filter(spark, sf_dir):
    """Placeholders filled from parameters, then bound as typed literals."""
    defaults = {"priority": "{level}-{name}", "since": "{since}"}
    values = {"level": 1, "name": "LOW", "since": "1998-01-01 00:00:00"}
    args = bind_params(defaults, values, {"name": "URGENT"})
    text = """
        SELECT o_orderkey, o_custkey, o_orderdate FROM {orders}
        WHERE o_orderpriority = :priority AND o_orderdate >= CAST(:since AS TIMESTAMP_NTZ)
    """
    return read_query(spark, text, args, orders=table(spark, sf_dir, "orders"))


@query
def src_parent_feed(spark, sf_dir):
    """Orders of the customers in one segment."""
    building = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf_dir, "orders")
    fed = readers.feed_from_parent(orders, building, "o_custkey", "c_custkey")
    return fed.select("o_orderkey", "o_custkey")


@query
def src_scan_page(spark, sf_dir):
    """Filter, sort and page size."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    order = [F.desc("o_totalprice"), "o_orderkey"]
    return cur.scan(orders, "o_orderstatus = :state", order, 100, {"state": "O"})


@query
def topk_recent(spark, sf_dir):
    """the newest hundred orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return cur.latest(orders, "o_orderdate", 100, tie=["o_orderkey"])


# ---- schema and naming ------------------------------------------------------------------------


@query
def conform_types(spark, sf_dir):
    """Typed columns; a bad cast and an absent nullable column give NULL."""
    text = F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(
        F.get_json_object("props", "$.k")
    )
    raw = table(spark, sf_dir, "events").withColumn("k_text", text)
    contract = [
        Column("event_id", "integer", nullable=False),
        Column("kind", "string", path="event_type"),
        Column("k", "integer", path="k_text"),
        Column("day", "date", path="ts"),
        Column("note", "string"),
    ]
    return con.conform(raw, contract)


@query
def conform_rejects(spark, sf_dir):
    """How many rows were good, and how many broke the contract for each reason."""
    key = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 97 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 89 == 0, "bad").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
    )
    contract = [
        Column("o_orderkey", "integer", nullable=False),
        Column("o_orderstatus", "string", nullable=False),
        Column("o_custkey", "integer"),
    ]
    good, rejects = con.split_rejects(raw, contract)
    labelled = good.select(F.lit("good").alias("reason")).unionAll(
        rejects.select(F.explode(con.REASONS).alias("reason"))
    )
    return labelled.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def alias_columns(spark, sf_dir):
    """Renamed columns."""
    names = {"c_custkey": "customer_id", "c_acctbal": "balance"}
    return cols.apply_aliases(table(spark, sf_dir, "customer"), names)


@query
def naming_case(spark, sf_dir):
    """Column names in camel case."""
    return cols.normalise_columns(table(spark, sf_dir, "customer"), "camel_case")


@query
def resolve_columns(spark, sf_dir):
    """P5: contract spelling wins, whatever the case of the stored columns."""
    return cols.resolve_columns(table(spark, sf_dir, "supplier"), ["S_SuppKey", "S_NAME"])


@query
def pii_hash(spark, sf_dir):
    """Names hashed."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return cols.protect_pii(customer, ["c_name"], "hash")


@query
def pii_mask(spark, sf_dir):
    """Names masked but for their last four characters, segments hashed with a salt."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    masked = cols.protect_pii(customer, ["c_name"], "mask", keep=4)
    return cols.protect_pii(masked, ["c_mktsegment"], "hash", salt="pepper")


@query
def pii_drop(spark, sf_dir):
    """Protected fields dropped."""
    return cols.protect_pii(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"], "drop")


@query
def audit_stamp(spark, sf_dir):
    """Load id and extraction time on every row."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return cols.stamp(customer, "load-1", LOADED_AT, NTZ)


@query
def nested_cursor(spark, sf_dir):
    """A cursor inside a struct."""
    records = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.struct(F.col("ts").alias("publishedAt")).alias("snippet")
    )
    fresh = cur.incremental(records, "snippet.publishedAt", datetime(2024, 1, 15))
    return cols.select_paths(fresh, {"id": "id", "published_at": "snippet.publishedAt"})


@query
def flatten_structs(spark, sf_dir):
    """Structs two deep become flat columns."""
    records = table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k BIGINT").alias("props"),
        F.struct("event_type", F.struct("user_id").alias("who")).alias("meta"),
    )
    return nested.flatten(records)


@query
def explode_children(spark, sf_dir):
    """P10: vector elements as child rows."""
    children = nested.explode_children(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return children.withColumn("value", F.col("value").cast("double"))


@query
def json_value(spark, sf_dir):
    """A value out of a JSON column, NULL where the text is broken."""
    props = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("{"), "props")).otherwise(
        F.col("props")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_get(props, "$.k", "bigint").alias("k"),
        json_get(props, "$.absent", "string").alias("absent"),
    )


@query
def schema_evolve(spark, sf_dir):
    """An old slice with fewer and narrower columns joins a new one."""
    orders = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = orders.filter(F.col("o_orderdate") < cut).select(
        "o_orderkey", F.floor("o_totalprice").cast("bigint").alias("o_totalprice")
    )
    new = orders.filter(F.col("o_orderdate") >= cut).select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    return con.evolve_union(old, new)


# ---- cursors ----------------------------------------------------------------------------------


@query
def incremental_filter(spark, sf_dir):
    """orders past the saved cursor."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return cur.incremental(orders, "o_orderdate", datetime(1998, 6, 30))


@query
def incremental_first_run(spark, sf_dir):
    """the first run starts at the initial value, which it includes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return cur.incremental(orders, "o_orderdate", None, "1998-06-30T00:00:00Z")


@query
def cursor_advance(spark, sf_dir):
    """the new high-water mark per resource."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    marks = {
        "orders": cur.advance_cursor(orders, "o_orderdate", datetime(1998, 6, 30)),
        "events": cur.advance_cursor(events, "ts"),
        "events_ahead": cur.advance_cursor(events, "ts", datetime(2030, 1, 1)),
    }
    named = [df.select(F.lit(n).alias("resource"), "high_water") for n, df in marks.items()]
    return named[0].unionAll(named[1]).unionAll(named[2])


@query
def backfill_window(spark, sf_dir):
    """the seven days before a time."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return cur.backfill(events, "ts", 7, datetime(2024, 1, 20))


@query
def full_refresh(spark, sf_dir):
    """the cursor is ignored and the table replaced."""
    spec = ResourceSpec("orders", incremental=Incremental("o_orderdate", "2000-01-01"))
    orders = table(spark, sf_dir, "orders")
    everything = LoadOptions(full_refresh=True)
    loaded = load_frame(orders, spec, orders.limit(0), "2001-01-01", "l", LOADED_AT, options=everything)
    return loaded.select("o_orderkey", "o_totalprice")


@query
def retention(spark, sf_dir):
    """the last seven days; rows without a date stay."""
    ts = F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("ts")
    events = table(spark, sf_dir, "events").select("event_id", ts)
    return cur.apply_retention(events, "ts", AS_OF, 7)


@query
def retention_table(spark, sf_dir):
    """the same on a stored table, dropping whole days."""
    target = Target.folder(shared_dir(spark, "retention"))
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    sink.write_table(events, target, "replace", partition_by=["ts"])
    sink.retain_table(spark, target, "ts", datetime(2024, 1, 30, 12), 7)
    return target.read(spark).select("event_id", "ts")


# ---- write dispositions -----------------------------------------------------------------------


def _slices(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two parts of lineitem that overlap in the lines neither returned nor accepted."""
    part = lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    flag = F.col("l_returnflag")
    return part.filter(flag != "R"), part.filter(flag != "A")


@query
def write_append(spark, sf_dir):
    """Appending keeps duplicates."""
    return mrg.append(*_slices(table(spark, sf_dir, "lineitem")))


@query
def write_append_table(spark, sf_dir):
    """The same into a stored table, which gains a column on the way."""
    target = Target.folder(shared_dir(spark, "append"))
    first, second = _slices(table(spark, sf_dir, "lineitem"))
    sink.write_table(first, target)
    sink.write_table(second.withColumn("batch", F.lit("second")), target)
    return target.read(spark)


@query
def write_replace(spark, sf_dir):
    """Only the last batch is left."""
    target = Target.folder(shared_dir(spark, "replace"))
    customer = table(spark, sf_dir, "customer")
    sink.write_table(customer, target, "replace")
    sink.write_table(customer.filter(F.col("c_acctbal") > 0), target, "replace")
    return target.read(spark)


def _changed(orders: DataFrame) -> DataFrame:
    """Changed and new orders; those of one priority change twice and the later date wins."""
    pending = orders.filter(F.col("o_orderstatus") == "P")
    changed = pending.withColumn("o_totalprice", F.lit(1.5))
    later = changed.filter(F.col("o_orderpriority") == "2-HIGH").select(
        *[
            (F.col(c) + F.make_dt_interval(F.lit(1)) if c == "o_orderdate" else F.col(c)).alias(c)
            for c in changed.columns
        ]
    )
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    new = urgent.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    later = later.withColumn("o_totalprice", F.lit(2.5))
    return changed.unionAll(later).unionAll(new)


@query
def write_merge(spark, sf_dir):
    """A batch of changes merged by key."""
    orders = table(spark, sf_dir, "orders")
    return mrg.merge(orders, _changed(orders), "o_orderkey", "o_orderdate")


@query
def write_merge_table(spark, sf_dir):
    """The same into a stored table whose partitions the changes move between."""
    target = Target.folder(shared_dir(spark, "merge"))
    orders = table(spark, sf_dir, "orders")
    sink.write_table(orders, target, "replace", partition_by=["o_orderstatus"])
    moved = F.when(F.col("o_orderpriority") == "5-LOW", "X").otherwise(F.col("o_orderstatus"))
    changed = _changed(orders).withColumn("o_orderstatus", moved)
    sink.merge_table(changed, target, "o_orderkey", "o_orderdate", ["o_orderstatus"])
    return target.read(spark)


@query
def merge_evolving_partitioned(spark, sf_dir):
    """A merge that brings a new column into two of a table's partitions; the others keep their files."""
    target = Target.folder(shared_dir(spark, "evolving"))
    orders = table(spark, sf_dir, "orders")
    sink.write_table(orders, target, "replace", partition_by=["o_orderpriority"])
    before = set(target.read(spark).inputFiles())
    urgent = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    sink.merge_table(urgent.withColumn("rush", F.lit(True)), target, "o_orderkey", "o_orderdate", ["o_orderpriority"])
    stored = target.read(spark)
    kept = len(before & set(stored.inputFiles())) > 0
    return stored.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.count("rush").alias("n_rush"), F.lit(kept).alias("old_files_kept")
    )


@query
def write_catalog_table(spark, sf_dir):
    """A catalog table addressed through its dataset, partitioned and merged."""
    schema = f"loadweir_{uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{shared_dir(spark, 'catalog')}'")
    target = Dataset(schema=schema, prefix="raw_").address("webOrders")
    orders = table(spark, sf_dir, "orders")
    sink.write_table(orders, target, "replace", partition_by=["o_orderpriority"])
    sink.merge_table(_changed(orders), target, "o_orderkey", "o_orderdate", ["o_orderpriority"])
    return spark.table(f"{schema}.raw_web_orders")


@query
def dedup_latest(spark, sf_dir):
    """One line per order and number, the last shipped."""
    lineitem = table(spark, sf_dir, "lineitem")
    return mrg.latest_per_key(lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def write_partitioned(spark, sf_dir):
    """Events stored by day, counted per day folder."""
    target = Target.folder(shared_dir(spark, "partitioned"))
    events = table(spark, sf_dir, "events")
    sink.write_table(events, target, "replace", partition_by=["ts"])
    return target.read(spark).groupBy("ts_date").agg(F.count(F.lit(1)).alias("n"))


@query
def write_clustered(spark, sf_dir):
    """Lineitem stored in ship date order over several files, read back over a date range."""
    target = Target.folder(shared_dir(spark, "clustered"))
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    sink.write_table(lineitem, target, "replace", cluster_by=["l_shipdate"], parallelism=4)
    month = F.col("l_shipdate").between(
        F.lit("1997-03-01").cast("timestamp_ntz"), F.lit("1997-03-31").cast("timestamp_ntz")
    )
    return target.read(spark).filter(month)


@query
def write_bounded_files(spark, sf_dir):
    """No file holds more rows than allowed, and no row is lost."""
    target = Target.folder(shared_dir(spark, "bounded"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    sink.write_table(orders, target, "replace", rows_per_file=1000, parallelism=4)
    per_file = target.read(spark).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.sum("n").alias("row_count"), (F.max("n") <= 1000).alias("within_bound")
    )


@query
def compact_table(spark, sf_dir):
    """Fewer files with the same rows."""
    target = Target.folder(shared_dir(spark, "compact"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sink.write_table(orders, target, "replace", parallelism=12)
    sink.compact(spark, target)
    return target.read(spark)


@query
def append_once(spark, sf_dir):
    """A replayed batch adds nothing."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    loads = events.withColumn("_load_id", F.concat(F.lit("load-"), "event_type"))
    stored = loads.filter(F.col("event_type") != "purchase")
    batch = loads.filter(F.col("event_type") != "click")
    return mrg.append_once(stored, batch)


@query
def append_once_table(spark, sf_dir):
    """The same batch written twice to a stored table."""
    target = Target.folder(shared_dir(spark, "once"))
    events = table(spark, sf_dir, "events").select("event_id")
    batch = cols.stamp(events, "load-1", LOADED_AT, NTZ)
    for _ in range(2):
        sink.append_once_table(batch, target, "load-1")
    return target.read(spark).select("event_id", "_load_id")


@query
def append_torn_replay(spark, sf_dir):
    """Three tenths of a load are there when its driver is lost; the replay leaves each row once."""
    target = Target.folder(shared_dir(spark, "torn"))
    events = table(spark, sf_dir, "events").select("event_id")
    sink.append_once_table(cols.stamp(events, "load-1", LOADED_AT, NTZ), target, "load-1")
    batch = cols.stamp(events, "load-2", LOADED_AT, NTZ)
    LoadLedger(spark, target).begin("load-2")
    sink.write_table(batch.filter("event_id % 10 < 3"), target)
    for _ in range(2):
        sink.append_once_table(batch, target, "load-2")
    return target.read(spark).select("event_id", "_load_id")


@query
def retention_load(spark, sf_dir):
    """days landed one by one, then kept for a week by what the files say of themselves."""
    target = Target.folder(shared_dir(spark, "retention"))
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    sink.write_table(events, target, cluster_by=["ts"], parallelism=6)
    for as_of in (AS_OF - timedelta(days=20), AS_OF):
        sink.retain_table(spark, target, "ts", as_of, 7)
    return target.read(spark)


# ---- quality ----------------------------------------------------------------------------------


def _faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 97 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 89 != 0, F.col("o_custkey")).alias("o_custkey"),
    )


@query
def dq_not_null(spark, sf_dir):
    """Q1."""
    checks = [Check("not_null", columns=("o_orderkey", "o_orderstatus", "o_custkey"))]
    return quality.run_checks(_faulty_orders(spark, sf_dir), checks)


@query
def dq_unique(spark, sf_dir):
    """Q2: a composite key with repeats, and a key with NULLs."""
    lineitem = table(spark, sf_dir, "lineitem")
    planted = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey"))
    lineitem = lineitem.withColumn("nullable_key", planted)
    checks = [
        Check("unique", columns=("l_orderkey", "l_linenumber")),
        Check("unique", columns=("nullable_key", "l_linenumber"), severity="warning"),
    ]
    return quality.run_checks(lineitem, checks)


@query
def dq_positive(spark, sf_dir):
    """Q3."""
    checks = [Check("positive", columns=("c_acctbal", "c_custkey"))]
    return quality.run_checks(table(spark, sf_dir, "customer"), checks)


@query
def dq_range(spark, sf_dir):
    """Q4: two bounds, and one."""
    checks = [
        Check("range", column="l_discount", min_value=0.02, max_value=0.08),
        Check("range", column="l_quantity", max_value=45),
    ]
    return quality.run_checks(table(spark, sf_dir, "lineitem"), checks)


@query
def dq_pattern(spark, sf_dir):
    """Q5: planted names without their number."""
    key = F.col("c_custkey")
    name = F.when(key % 31 == 0, "nobody").when(key % 37 == 0, None).otherwise(F.col("c_name"))
    customer = table(spark, sf_dir, "customer").select(name.alias("c_name"))
    return quality.run_checks(customer, [Check("pattern", column="c_name", pattern="^Customer#[0-9]+$")])


@query
def dq_freshness(spark, sf_dir):
    """Q6: fresh enough for one bound and not for the other."""
    checks = [
        Check("freshness", column="ts", max_age_hours=48, name="two_days"),
        Check("freshness", column="ts", max_age_hours=12, name="half_day"),
    ]
    return quality.run_checks(table(spark, sf_dir, "events"), checks, as_of=AS_OF + timedelta(hours=12))


@query
def dq_completeness(spark, sf_dir):
    """Q7: any required value missing, and a required column that is not there."""
    checks = [
        Check("completeness", required_columns=("o_orderstatus", "o_custkey")),
        Check("completeness", required_columns=("o_orderkey", "o_comment")),
    ]
    return quality.run_checks(_faulty_orders(spark, sf_dir), checks)


@query
def dq_volume(spark, sf_dir):
    """Q8: bounds that hold and bounds that do not."""
    checks = [
        Check("volume", min_rows=1, max_rows=1_000_000_000_000, name="plausible"),
        Check("volume", max_rows=10, name="tiny"),
    ]
    return quality.run_checks(table(spark, sf_dir, "events"), checks)


@query
def dq_schema(spark, sf_dir):
    """Q9: a missing, a retyped and two extra columns."""
    contract = [
        Column("c_custkey", "integer"),
        Column("c_name", "string"),
        Column("c_acctbal", "string"),
        Column("c_phone", "string"),
    ]
    return quality.run_checks(table(spark, sf_dir, "customer"), [Check("schema")], contract=contract)


CUSTOMER_CHECKS = (
    Check("not_null", columns=("c_custkey", "c_name")),
    Check("positive", columns=("c_acctbal",), severity="warning"),
    Check("range", column="c_nationkey", min_value=0, max_value=20),
    Check("pattern", column="c_mktsegment", pattern="^[A-Z]+$"),
    Check("unique", columns=("c_custkey",)),
)


@query
def dq_gate(spark, sf_dir):
    """Q10: what the gate does about each result."""
    results = quality.run_checks(table(spark, sf_dir, "customer"), CUSTOMER_CHECKS)
    return quality.gate_action(results)


@query
def dq_score(spark, sf_dir):
    """Q11: the share of checks passed."""
    results = quality.run_checks(table(spark, sf_dir, "customer"), CUSTOMER_CHECKS)
    return quality.quality_score(results)


@query
def dq_quarantine(spark, sf_dir):
    """Q12: each row with the names of the checks it failed."""
    tagged = quality.tag_rows(table(spark, sf_dir, "customer"), CUSTOMER_CHECKS)
    return tagged.select(
        "c_custkey",
        F.size("failed_checks").alias("n_failed"),
        F.array_join("failed_checks", "|").alias("failed_checks"),
    )


# ---- metrics ----------------------------------------------------------------------------------


@query
def load_row_counts(spark, sf_dir):
    """Rows of the chosen resources and their total."""
    names = ["region", "nation", "customer", "orders", "lineitem", "events"]
    source = {n: table(spark, sf_dir, n) for n in names}
    return met.row_counts(select_resources(source, ["customer", "orders", "lineitem"]))


@query
def metric_freshness(spark, sf_dir):
    """A3: how far each table lags behind."""
    frames = {n: table(spark, sf_dir, n) for n in ("orders", "events")}
    return met.freshness(frames, {"orders": "o_orderdate", "events": "ts"}, AS_OF)


@query
def metric_stale_tables(spark, sf_dir):
    """A5: tables staler than they may be."""
    return met.stale_tables(metric_freshness(spark, sf_dir), 48, AS_OF).select("table_name", "lag_hours")


@query
def metric_errors(spark, sf_dir):
    """A4: events and error events per day."""
    events = table(spark, sf_dir, "events")
    by_day = met.error_metrics(
        events, F.col("event_type") != "error", [F.to_date("ts").alias("day")]
    )
    return by_day.withColumn("error_rate", F.round("error_rate", 6))


@query
def metric_sla_miss(spark, sf_dir):
    """A5: one run per user and day; those of more than twenty hours."""
    runs = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    runs = runs.agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    return met.sla_misses(runs, 20 * 60).select("user_id", "day", "duration_minutes")


@query
def post_load_sql(spark, sf_dir):
    """Hourly counts, then the busiest hours out of them."""
    tables = {"loaded_events": table(spark, sf_dir, "events")}
    statements = {
        "hourly_counts": """
            SELECT event_type, CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS hour_start,
                   count(*) AS n
            FROM loaded_events WHERE event_type <> :skip GROUP BY ALL""",
        "busiest": "SELECT event_type, max(n) AS peak, count(*) AS hours FROM hourly_counts "
        "GROUP BY event_type",
    }
    return met.post_load(spark, tables, statements, {"skip": "error"})["busiest"]


@query
def missing_slots(spark, sf_dir):
    """Minutes of the month without an event."""
    events = table(spark, sf_dir, "events")
    return met.missing_slots(
        events, "ts", datetime(2024, 1, 1), datetime(2024, 1, 31), timedelta(minutes=1)
    )


# ---- streams ----------------------------------------------------------------------------------


def _finish(running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


@query
def stream_append(spark, sf_dir):
    """S4 and ST1: all rows arrive once."""
    out, log = shared_dir(spark, "stream"), shared_dir(spark, "checkpoint")
    _finish(streams.stream_append(stream(spark, sf_dir, "events"), out, log))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query
def stream_merge(spark, sf_dir):
    """ST2: the latest event per user."""
    target = Target.folder(shared_dir(spark, "stream"))
    source = stream(spark, sf_dir, "events")
    _finish(streams.stream_merge(source, target, "user_id", "ts", shared_dir(spark, "checkpoint")))
    return target.read(spark)


@query
def stream_dedup(spark, sf_dir):
    """ST3: the error events arrive again; each is kept once."""
    out = shared_dir(spark, "stream")
    events = stream(spark, sf_dir, "events")
    again = stream(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    once = streams.stream_dedup(events.unionAll(again), "event_id", "ts", "40 days", hot_key_slots=8)
    _finish(streams.stream_append(once, out, shared_dir(spark, "checkpoint")))
    return zoneless(spark.read.parquet(out)).select("event_id", "ts", "user_id")


@query
def stream_interval_metrics(spark, sf_dir):
    """ST4: events and errors per quarter of an hour."""
    target = Target.folder(shared_dir(spark, "stream"))
    metrics = streams.interval_metrics(
        stream(spark, sf_dir, "events"), "ts", error=F.col("event_type") == "error"
    )
    _finish(streams.stream_interval_metrics(metrics, target, shared_dir(spark, "checkpoint")))
    return zoneless(target.read(spark)).drop("window_start_date")


@query
def stream_quarantine(spark, sf_dir):
    """ST5: good rows and rejects, counted by reason."""
    good = Target.folder(shared_dir(spark, "stream-good"))
    rejects = Target.folder(shared_dir(spark, "stream-rejects"))
    checks = [
        Check("range", column="value", max_value=20, name="value_in_range"),
        Check("pattern", column="event_type", pattern="^[a-z]*[^r]$", name="not_error"),
    ]
    source = stream(spark, sf_dir, "events")
    _finish(
        streams.stream_quarantine(source, checks, good, rejects, shared_dir(spark, "checkpoint"))
    )
    reasons = rejects.read(spark).select(F.array_join("failed_checks", "|").alias("outcome"))
    outcomes = good.read(spark).select(F.lit("good").alias("outcome")).unionAll(reasons)
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _in_batches(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """Events landed as files of a week or so each, read as a stream of one file per micro-batch."""
    folder = shared_dir(spark, "landed")
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(files, "ts").write.parquet(folder)
    return readers.read_stream(spark, folder, "parquet", events.schema, max_files=1)


def _batches(running) -> int:
    """How many micro-batches with rows a stream had, once it has ended."""
    _finish(running)
    return sum(p.numInputRows > 0 for p in running.recentProgress)


@query
def stream_merge_batches(spark, sf_dir):
    """ST2: the latest event per user, from several micro-batches that need not come in order of time."""
    target = Target.folder(shared_dir(spark, "stream"))
    source = _in_batches(spark, sf_dir)
    n = _batches(streams.stream_merge(source, target, "user_id", "ts", shared_dir(spark, "checkpoint")))
    return target.read(spark).withColumn("several_batches", F.lit(n > 1))


@query
def stream_metrics_batches(spark, sf_dir):
    """ST4: events and errors per quarter of an hour from several micro-batches, each of which rewrites its own days alone."""
    target = Target.folder(shared_dir(spark, "stream"))
    failed = F.col("event_type") == "error"
    metrics = streams.interval_metrics(_in_batches(spark, sf_dir), "ts", lateness="40 days", error=failed)
    n = _batches(streams.stream_interval_metrics(metrics, target, shared_dir(spark, "checkpoint")))
    stored = zoneless(target.read(spark)).drop("window_start_date")
    return stored.withColumn("several_batches", F.lit(n > 1))


@query
def stream_quarantine_batches(spark, sf_dir):
    """ST5: good rows and rejects of several micro-batches; none looks at what the others have stored."""
    good, rejects = (Target.folder(shared_dir(spark, f"stream-{n}")) for n in ("good", "rejects"))
    checks = [Check("range", column="value", max_value=20, name="value_in_range")]
    source = _in_batches(spark, sf_dir)
    n = _batches(streams.stream_quarantine(source, checks, good, rejects, shared_dir(spark, "checkpoint")))
    both = good.read(spark).select("event_id", F.lit(True).alias("good")).unionAll(
        rejects.read(spark).select("event_id", F.lit(False).alias("good"))
    )
    return both.withColumn("several_batches", F.lit(n > 1))


# ---- whole loads ------------------------------------------------------------------------------

ORDERS_SPEC = ResourceSpec(
    "orders",
    write_disposition="merge",
    columns=ORDERS_CONTRACT,
    incremental=Incremental("o_orderdate", "1995-01-01T00:00:00Z"),
    checks=(
        Check("not_null", columns=("o_orderkey", "o_custkey", "o_orderdate")),
        Check("unique", columns=("o_orderkey",)),
        Check("volume", min_rows=1),
    ),
)


@query
def load_resource_merge(spark, sf_dir):
    """A first load up to 1998, then an increment of later orders and re-dated changes."""
    dataset = Dataset(root=shared_dir(spark, "dataset"), prefix="raw_")
    orders = table(spark, sf_dir, "orders")
    early = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    load_resource(spark, ORDERS_SPEC, early, dataset, LOADED_AT)
    pending, date = F.col("o_orderstatus") == "P", F.col("o_orderdate")
    redated = F.when(pending, date + F.make_dt_interval(F.lit(3650))).otherwise(date)
    price = F.when(pending, F.lit(0.5)).otherwise(F.col("o_totalprice"))
    current = orders.withColumns({"o_orderdate": redated, "o_totalprice": price})
    load_resource(spark, ORDERS_SPEC, current, dataset, LOADED_AT + timedelta(hours=1))
    return zoneless(dataset.address("orders").read(spark)).drop("_load_id")


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dated by month only, so that very many tie."""
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", month)


def _two_loads(spark, sf_dir, spec: ResourceSpec, current: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A load of even orders before 1998, then two of all orders; the second of them finds nothing new."""
    dataset = Dataset(root=shared_dir(spark, "dataset"))
    orders = _monthly(spark, sf_dir)
    even = orders.filter("o_orderkey % 2 = 0 AND o_orderdate < TIMESTAMP_NTZ'1998-01-01'")
    load_resource(spark, spec, even, dataset, LOADED_AT)
    for hour in (1, 2):
        load_resource(spark, spec, current(orders), dataset, LOADED_AT + timedelta(hours=hour))
    return zoneless(dataset.address("orders").read(spark)).drop("_load_id", "_extracted_at")


@query
def incremental_ties_append(spark, sf_dir):
    """rows that arrive later with the cursor of the high-water mark are appended, known ones are not."""
    spec = ResourceSpec("orders", columns=ORDERS_CONTRACT, incremental=Incremental("o_orderdate", "1992-01-01T00:00:00Z"))
    return _two_loads(spark, sf_dir, spec, lambda orders: orders)


@query
def incremental_ties_merge(spark, sf_dir):
    """the same merged, with rows of that cursor that have changed since."""
    spec = ResourceSpec(
        "orders", write_disposition="merge", columns=ORDERS_CONTRACT,
        incremental=Incremental("o_orderdate", "1992-01-01T00:00:00Z"),
    )
    price = F.when(F.col("o_orderstatus") == "O", F.lit(0.5)).otherwise(F.col("o_totalprice"))
    return _two_loads(spark, sf_dir, spec, lambda orders: orders.withColumn("o_totalprice", price))


@query
def load_audit_rows(spark, sf_dir):
    """Three resources, one of them failing its gate; one audit row for each."""
    dataset = Dataset(root=shared_dir(spark, "dataset"), case="pascal_case")
    key = F.col("o_orderkey")
    holes = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(key % 97 != 0, F.col("o_custkey"))
    )
    specs = [
        ORDERS_SPEC,
        ResourceSpec("customer", ("c_custkey",), "replace", pii_fields=("c_name",)),
        ResourceSpec("events", checks=(Check("volume", max_rows=10),)),
    ]
    sources = {
        "orders": holes,
        "customer": table(spark, sf_dir, "customer"),
        "events": table(spark, sf_dir, "events"),
    }
    audit = load_resources(spark, specs, sources, dataset, LOADED_AT, parallel_loads=3)
    return audit.select("resource", "success", "rows_processed", "rows_rejected")


@query
def load_parent_child(spark, sf_dir):
    """Line items are loaded for the orders that the same run has just loaded, and part of a failed chain is skipped.

    Resources are given children first; the orders of the first run do not come again in the second.
    """
    dataset = Dataset(root=shared_dir(spark, "chain"))
    orders = ResourceSpec(
        "orders", ("o_orderkey",), "merge", incremental=Incremental("o_orderdate", "1997-06-01T00:00:00Z")
    )
    items = ResourceSpec("lineitem", parent=Parent("orders", "o_orderkey", "l_orderkey"))
    failing = ResourceSpec("part", checks=(Check("volume", max_rows=1),))
    below = ResourceSpec("partsupp", parent=Parent("part", "p_partkey", "l_partkey"))
    table_of = {n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "part")}
    narrow = table_of["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    early = table_of["orders"].filter("o_orderdate < TIMESTAMP_NTZ'1998-01-01'")
    audits = [
        load_resources(
            spark, [items, orders, below, failing],
            {**table_of, "orders": rows, "lineitem": narrow, "partsupp": narrow}, dataset, at, parallel_loads=2,
        )
        for rows, at in ((early, LOADED_AT), (table_of["orders"], LOADED_AT + timedelta(hours=1)))
    ]
    audit = audits[0].unionByName(audits[1])
    return audit.select(
        "resource", "success", "rows_processed", F.col("error").startswith("skipped").alias("skipped")
    ).fillna({"skipped": False})


@query
def pii_nested_load(spark, sf_dir):
    """Addresses inside a struct and an array are hashed before a load stages, rejects or stores anything."""
    dataset = Dataset(root=shared_dir(spark, "people"))
    mail = F.concat("c_name", F.lit("@planted.example"))
    customer = table(spark, sf_dir, "customer")
    people = customer.select(
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("c_custkey"),
        F.struct(mail.alias("mail"), "c_nationkey").alias("contact"),
        F.array(F.struct(mail.alias("mail"), F.lit(1).alias("rank"))).alias("others"),
    )
    spec = ResourceSpec("people", ("c_custkey",), "merge", pii_fields=("contact.mail", "others.mail"))
    load_resource(spark, spec, people, dataset, LOADED_AT)
    stored = dataset.address("people").read(spark)
    texts = {
        "rejects": dataset.bookkeeping("rejects").read(spark).select(F.col("raw").alias("text"), F.lit(None).alias("mail")),
        "stored": stored.select(F.to_json(F.struct("contact", "others")).alias("text"), F.col("contact.mail").alias("mail")),
    }
    named = [df.select(F.lit(name).alias("place"), "text", F.col("mail").cast("string").alias("mail")) for name, df in texts.items()]
    both = named[0].unionAll(named[1])
    planted = F.count_if(F.col("text").contains("planted"))
    return both.groupBy("place").agg(F.count("*").alias("n"), planted.alias("n_planted"), F.min("mail").alias("least_mail"))


@query
def load_from_config(spark, sf_dir):
    """C2 from parsed configuration: placeholders, an increment, a replace, and a failing check."""
    source = {
        "name": "shop",
        "resources": [
            {
                "name": "orders",
                "primary_key": ["o_orderkey"],
                "write_disposition": "merge",
                "params": {"priority": "{level}", "per_page": 100},
                "incremental": {"cursor_field": "o_orderdate", "initial_value": "1998-01-01T00:00:00Z"},
            },
            {"name": "customer", "primary_key": ["c_custkey"], "write_disposition": "replace"},
            {
                "name": "supplier",
                "data_quality": {"checks": [{"type": "not_null", "columns": ["s_suppkey"]}]},
            },
        ],
    }
    load = {
        "name": "shop_load",
        "source": {"resources": ["orders", "supplier"], "params": {"level": "2-HIGH"}},
        "destination": {"dataset_name": "shop"},
        "data_quality": {"checks": [{"name": "enough", "type": "volume", "min_rows": 500}]},
    }
    destination = {"settings": {"max_parallel_loads": 2}, "naming": {"prefix": "raw_"}}

    def open_resource(spec, params):
        rows = table(spark, sf_dir, spec.name)
        wanted = params.get("priority")
        return rows.filter(F.col("o_orderpriority") == wanted) if wanted else rows

    audit = load_configured(
        spark, source, load, destination, open_resource, LOADED_AT,
        root=shared_dir(spark, "configured"), parameters=({"level": "1-URGENT"},),
    )
    return audit.select("pipeline_name", "resource", "success", "rows_processed", "row_counts.raw_orders")
