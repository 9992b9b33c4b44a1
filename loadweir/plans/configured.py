"""C2 from parsed configuration: a source, what to load of it, and where to."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadweir.operators.cursor import scan
from loadweir.operators.metrics import post_load
from loadweir.plans.load import LoadOptions, load_resources
from loadweir.sinks.tables import write_table
from loadweir.sinks.target import Dataset
from loadweir.sources.params import bind_params, merge_params
from loadweir.sources.registry import open_source
from loadweir.spec import Check, ResourceSpec, specs_from_source


def dataset_from_config(
    destination: Mapping[str, Any], dataset_name: str, root: str | None = None
) -> Dataset:
    """A dataset from a parsed destination mapping; ``root`` asks for folders, not catalog tables.

    A loader's ``batch_size`` is not taken for a file size: files of ten thousand rows would bury
    a large table. Set ``rows_per_file`` for that.
    """
    body = destination.get("destination", destination)
    settings, naming = body.get("settings") or {}, body.get("naming") or {}
    keep = body.get("data_retention") or body.get("retention") or {}
    catalog = (body.get("connection") or {}).get("catalog")
    return Dataset(
        root=f"{root.rstrip('/')}/{dataset_name}" if root else None,
        schema=None if root else dataset_name,
        catalog=None if root else catalog,
        fmt=settings.get("table_format", "parquet"),
        prefix=naming.get("prefix", ""),
        suffix=naming.get("suffix", ""),
        case=naming.get("case", "snake_case"),
        partition_by=tuple(settings.get("partition_by") or ()),
        cluster_by=tuple(settings.get("cluster_by") or ()),
        rows_per_file=settings.get("rows_per_file"),
        retention_days=keep.get("days", 7) if keep.get("enabled") else None,
        compact_after_write=bool(settings.get("optimize_after_write", False)),
        evolve=bool(settings.get("schema_evolution", True)),
    )


# What a destination's write mode means for a resource that does not say itself.
WRITE_MODES = {"append": "append", "overwrite": "replace", "merge": "merge"}


def raw_schema(spec: ResourceSpec) -> T.StructType:
    """The fields a contract reads, nested as their paths are, all of them as text.

    Text is what conforming judges, so a value that does not fit its column becomes a reject and not
    a NULL. Fields that the load fills are left out.
    """
    tree: dict[str, Any] = {}
    paths = [c.source for c in spec.columns if c.name.lower() != "_extracted_at"]
    if spec.incremental is not None:
        paths.append(spec.incremental.cursor_field)
    if spec.parent is not None:
        paths.append(spec.parent.child_key)
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def fields(node: Mapping[str, Any]) -> T.StructType:
        return T.StructType([T.StructField(n, fields(below) if below else T.StringType()) for n, below in node.items()])

    return fields(tree)


def open_configured(
    spark: SparkSession, source: Mapping[str, Any], spec: ResourceSpec, params: Mapping[str, Any]
) -> DataFrame:
    """X1 from configuration: a resource's frame by the type of its source.

    ``type`` is that of the resource or of its source, and names an opener of the registry. A
    ``rest_api`` or ``landing`` resource is read from the bodies landed under ``connection.landing``,
    in the folder of its ``endpoint`` or name; a ``file`` from ``connection.path`` in the same way; a
    ``database`` resource is its ``table``. ``options`` of the source and then of the resource go to
    the opener as they are. ``where`` filters at the source, with the bound parameters as ``:name``.
    """
    body = source.get("source", source)
    entry = next(r for r in body["resources"] if r["name"] == spec.name)
    kind, connection = entry.get("type") or body.get("type"), body.get("connection") or {}
    if kind is None:
        raise ValueError(f"Source '{body.get('name')}' has no type, and no opener was given")
    options = {**(body.get("options") or {}), **(entry.get("options") or {})}
    place = (entry.get("endpoint") or spec.name).strip("/")
    if kind in ("rest_api", "landing"):
        options.setdefault("path", f"{connection.get('landing', '').rstrip('/')}/{place}")
        options.setdefault("schema", raw_schema(spec))
    elif kind == "file":
        options.setdefault("path", f"{connection.get('path', '').rstrip('/')}/{place}")
        options.setdefault("fmt", "parquet")
        if "schema" not in options and options["fmt"] in ("parquet", "orc"):
            options["schema"] = spark.read.format(options["fmt"]).load(options["path"]).schema
    elif kind == "database":
        options.setdefault("url", connection.get("url"))
        options.setdefault("table", entry.get("table", spec.name))
    frame = open_source(spark, kind, **options)
    return scan(frame, entry["where"], args=params) if entry.get("where") else frame


def load_configured(
    spark: SparkSession,
    source: Mapping[str, Any],
    load: Mapping[str, Any],
    destination: Mapping[str, Any],
    open_resource: Callable[[ResourceSpec, dict[str, Any]], DataFrame] | None,
    extracted_at: datetime,
    as_of: datetime | None = None,
    root: str | None = None,
    parameters: tuple[Mapping[str, Any], ...] = (),
) -> DataFrame:
    """Load the resources that ``load`` asks of ``source``; one audit row each.

    ``open_resource(spec, params)`` returns a resource's frame for its bound parameters (S6); with None
    the type of the source decides (:func:`open_configured`). A resource without a write disposition
    takes the destination's ``write_mode``. Names are never told apart by case alone, so
    ``case_sensitive`` destinations are refused and not ignored.
    ``parameters`` are the overrides of a trigger, a job and a run, later ones winning. Among them
    ``backfill_days``, ``force_refresh`` and ``skip_validation`` choose the kind of run. Checks
    declared for the load as a whole apply to each of its resources. Statements to run afterwards
    (A6) see the loaded tables by their stored names and replace the tables they are named after;
    they run only if every resource was loaded.
    """
    asked = load.get("pipeline", load)
    body = source.get("source", source)
    settings = (destination.get("destination", destination).get("settings")) or {}
    if settings.get("case_sensitive"):
        raise ValueError("case_sensitive destinations are not supported")
    mode = settings.get("write_mode", "append")
    if mode not in WRITE_MODES:
        raise ValueError(f"Unknown write_mode '{mode}'. Known modes: {list(WRITE_MODES)}")
    fallback = {"write_disposition": WRITE_MODES[mode]}
    specs = specs_from_source({**body, "resources": [{**fallback, **r} for r in body.get("resources") or ()]})
    if open_resource is None:
        open_resource = partial(open_configured, spark, body)
    params = merge_params(asked["source"].get("params") or {}, *parameters)
    quality = asked.get("data_quality") or {}
    shared = quality.get("checks", ()) if quality.get("enabled", True) else ()
    extra = tuple(Check.from_dict(c) for c in shared)
    chosen, frames = [], {}
    for name in asked["source"]["resources"]:
        if name not in specs:
            raise ValueError(f"Resource '{name}' not found in source '{body.get('name')}'")
        spec = replace(specs[name], checks=specs[name].checks + extra)
        chosen.append(spec)
        frames[name] = open_resource(spec, bind_params(spec.params, params))
    options = LoadOptions(
        full_refresh=bool(params.get("force_refresh", False)),
        backfill_days=params.get("backfill_days"),
        fail_on_error=quality.get("fail_on_error", True),
        skip_validation=bool(params.get("skip_validation", False)),
    )
    target = destination.get("destination", destination)
    dataset = dataset_from_config(target, asked["destination"]["dataset_name"], root)
    audit = load_resources(
        spark,
        chosen,
        frames,
        dataset,
        extracted_at,
        as_of=as_of,
        options=options,
        pipeline=asked.get("name", ""),
        parallel_loads=(target.get("settings") or {}).get("max_parallel_loads", 4),
    )
    after = asked.get("transformations") or {}
    if after.get("enabled") and after.get("post_load"):
        if audit.filter("NOT success").isEmpty():
            _run_after(spark, chosen, dataset, after["post_load"], params)
    return audit


def _run_after(spark, specs, dataset: Dataset, statements, params) -> None:
    """Each result is written before the next statement, which then reads the stored table."""
    tables = {dataset.name_of(s.name): dataset.address(s.name).read(spark) for s in specs}
    for statement in statements:
        name, target = statement["name"], dataset.address(statement["name"])
        write_table(post_load(spark, tables, {name: statement["sql"]}, params)[name], target, "replace")
        tables[name] = target.read(spark)
