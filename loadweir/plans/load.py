"""Loads: one resource (C1) or several (C2) into a dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadweir.functions.columns import failed_texts, path_col, path_type, typed_literal
from loadweir.functions.naming import to_case
from loadweir.operators.columns import (
    apply_aliases,
    match_names,
    normalise_columns,
    protect_pii,
    protected,
    quoted,
    stamp,
)
from loadweir.operators.conform import REASONS, conformed_columns, contract_rules
from loadweir.operators.cursor import past_boundary, past_cursor, row_identity, within_backfill
from loadweir.operators.merging import append, merge
from loadweir.operators.metrics import load_audit
from loadweir.operators.quality import FAILS, SAME, gate, run_checks, stand_ins, tag_rows
from loadweir.plans.state import (
    boundary,
    derive_load_id,
    high_water,
    save_audit,
    save_boundary,
    save_cursor,
    save_rejects,
)
from loadweir.sinks.tables import (
    append_once_table,
    compact,
    merge_table,
    retain_table,
    staged,
    write_table,
)
from loadweir.sinks.target import Dataset
from loadweir.sources.readers import feed_from_parent
from loadweir.spec import ROW_CHECKS, Check, Column, ResourceSpec, in_parent_order

CURSOR = "__cursor"
RAW = "__raw"
SEEN = ("__seen_a", "__seen_b")


@dataclass(frozen=True)
class LoadOptions:
    """How one run differs from a plain incremental load.

    ``stage=False`` re-reads the source instead of staging the batch: better for a columnar source
    that is cheap to scan and does not change during the load.
    """

    full_refresh: bool = False
    backfill_days: int | None = None
    fail_on_error: bool = True
    quarantine: bool = False
    skip_validation: bool = False
    stage: bool = True


def new_rows(
    source: DataFrame,
    spec: ResourceSpec,
    state: Any,
    options: LoadOptions,
    as_of: datetime | None,
    known: tuple[int | None, DataFrame] | None = None,
) -> DataFrame:
    """the source rows this run is about.

    Rows without a cursor come along, to be rejected where someone can see them. With ``known``, what
    earlier runs have read at the high-water mark, rows that tie with it are new unless they are in it.
    """
    cursor = spec.incremental
    if options.full_refresh or cursor is None or not cursor.enabled:
        return source
    if options.backfill_days is not None:
        if as_of is None:
            raise ValueError("a backfill needs as_of")
        within = within_backfill(source, cursor.cursor_field, options.backfill_days, as_of)
        return source.filter(within | path_col(cursor.cursor_field).isNull())
    if known is not None and state is not None and not cursor.inclusive:
        micros, seen = known
        kind = path_type(source, cursor.cursor_field)
        bound = typed_literal(state, kind)
        if micros is not None and isinstance(kind, T.TimestampType):
            bound = F.timestamp_micros(F.lit(micros))
        paths = _identity_paths(source, spec)
        return past_boundary(source, cursor.cursor_field, bound, seen, paths)
    fresh = past_cursor(
        source, cursor.cursor_field, state, cursor.initial_value, cursor.inclusive
    )
    if fresh is None:
        return source
    return source.filter(fresh | path_col(cursor.cursor_field).isNull())


def _identity_paths(batch: DataFrame, spec: ResourceSpec) -> list[str]:
    """What a row is known by at the high-water mark: all that the load reads of it."""
    contract = _contract(spec, batch)
    have = match_names(batch.columns, [c.source.split(".")[0] for c in contract])
    paths = [c.source for c in contract if have[c.source.split(".")[0]]]
    if not contract or spec.extra_columns == "keep":
        known = {c.source.lower() for c in contract}
        paths += [f"`{name}`" if "." not in name else name for name in batch.columns if name.lower() not in known]
    if spec.incremental is not None and spec.incremental.cursor_field not in paths:
        paths.append(spec.incremental.cursor_field)
    return paths


def judge(batch: DataFrame, spec: ResourceSpec) -> DataFrame:
    """P1 and P2 in one projection: conformed columns, reasons, cursor, and raw text of rejects.

    Everything a load needs to know about a row is here, so the batch has to be read only once.
    Protected fields leave this projection protected (P6): what is staged, checked and rejected
    afterwards never holds them in the clear, and checks of them are answered here.
    """
    contract = _contract(spec, batch)
    rules = contract_rules(batch, contract)
    cursor = spec.incremental
    if cursor is not None and cursor.enabled:
        place = path_col(cursor.cursor_field)
        rules.append((place.isNull(), f"{cursor.cursor_field}: no cursor"))
    else:
        place = F.lit(None).cast("string")
    if spec.write_disposition == "merge":
        sources = {c.name: c.source for c in contract}
        required = {c.name for c in contract if not c.nullable}
        rules += [
            (path_col(sources.get(key, key)).isNull(), f"{key}: null key")
            for key in spec.primary_key
            if key not in required
        ]
    if contract:
        columns = conformed_columns(batch, contract, spec.extra_columns)
    else:
        columns = [quoted(name) for name in batch.columns]
    values = F.struct(*_raw_values(batch, spec, contract))
    raw = F.when(F.size(REASONS) > 0, F.to_json(values))
    # Reasons come first and on their own, so that they are worked out once per row.
    judged = batch.withColumn(REASONS, failed_texts(rules))
    own = [quoted(REASONS), place.alias(CURSOR), raw.alias(RAW)]
    if cursor is not None and cursor.enabled:
        identity = row_identity(batch, _identity_paths(batch, spec))
        own += [value.alias(name) for name, value in zip(SEEN, identity)]
    judged = judged.select(*columns, *own)
    if not spec.pii_fields:
        return judged
    judged = judged.withColumns(stand_ins(judged, spec.checks, spec.pii_fields))
    fields = [*spec.pii_fields, *_copies(judged, spec)]
    return protect_pii(judged, fields, spec.pii_mode, spec.pii_salt)


def _copies(judged: DataFrame, spec: ResourceSpec) -> list[str]:
    """Where an undeclared column that is kept holds the source of a protected contract column as well."""
    hidden = {f.lower() for f in spec.pii_fields}
    paths = [c.path for c in spec.columns if c.path and "." in c.path and c.name.lower() in hidden]
    own = {c.name for c in spec.columns}
    return [p for p in paths if p.split(".")[0] in judged.columns and p.split(".")[0] not in own]


def _contract(spec: ResourceSpec, batch: DataFrame) -> list[Column]:
    """The declared columns, less the audit time that a source need not deliver."""
    own = match_names(batch.columns, ["_extracted_at"])["_extracted_at"]
    return [c for c in spec.columns if own is not None or c.name.lower() != "_extracted_at"]


def _raw_values(batch: DataFrame, spec: ResourceSpec, contract: list[Column]) -> list:
    """What a reject is kept with: its values as they came, under the contract's names.

    Only columns the load reads anyway are named, so the source scan stays pruned. Protected
    fields are left out, because a value that broke its contract may hold anything.
    """
    hidden = {f.lower() for f in spec.pii_fields}
    have = match_names(batch.columns, [c.source.split(".")[0] for c in contract])
    values = {c.name: path_col(c.source) for c in contract if have[c.source.split(".")[0]]}
    if not contract or spec.extra_columns == "keep":
        known = {name.lower() for c in contract for name in (c.name, c.source)}
        values |= {n: quoted(n) for n in batch.columns if n.lower() not in known}
    if spec.incremental is not None and spec.incremental.enabled:
        field = spec.incremental.cursor_field
        if field not in values and field not in {c.source for c in contract}:
            values[field] = path_col(field)
    sources = {c.name: c.source for c in contract}
    inside = [f for f in spec.pii_fields if "." in f]
    inside += [c.source for c in spec.columns if c.name.lower() in hidden and "." in c.source]
    for name in values:
        source = sources.get(name, name)
        for field in inside:
            if field.lower().startswith(source.lower() + "."):
                rest, kind = field[len(source) + 1 :].split("."), path_type(batch, source)
                values[name] = protected(values[name], kind, rest, None)
    shown = [
        value.alias(name)
        for name, value in values.items()
        if name.lower() not in hidden and sources.get(name, name).lower() not in map(str.lower, inside)
    ]
    return shown or [F.lit(None).cast("string").alias("hidden")]


def finish(
    good: DataFrame, spec: ResourceSpec, case: str, load_id: str, extracted_at: datetime
) -> DataFrame:
    """Good rows as they are stored."""
    good = good.drop(*[c for c in good.columns if c.startswith((FAILS, SAME))])
    aliases = {old: new for old, new in spec.aliases.items() if old in good.columns}
    if len(aliases) < len(spec.aliases):
        raise ValueError(f"Cannot alias unknown columns {sorted(set(spec.aliases) - set(aliases))}")
    named = normalise_columns(apply_aliases(good, aliases), case)
    own = match_names(named.columns, ["_extracted_at"])["_extracted_at"]
    if own is not None:
        # The contract lists the audit column; the load fills it.
        return stamp(named.drop(own), load_id, extracted_at)
    return stamp(named, load_id, extracted_at)


def stored_name(spec: ResourceSpec, name: str, case: str) -> str:
    """The name a contract column has in the stored table."""
    return to_case(spec.aliases.get(name, name), case)


def load_frame(
    source: DataFrame,
    spec: ResourceSpec,
    stored: DataFrame | None,
    state: Any,
    load_id: str,
    extracted_at: datetime,
    order: Sequence[str] = (),
    case: str = "snake_case",
    options: LoadOptions = LoadOptions(),
    as_of: datetime | None = None,
) -> DataFrame:
    """C1 as one lazy plan: what the table holds after the load. Nothing is written."""
    judged = judge(new_rows(source, spec, state, options, as_of), spec)
    good = judged.filter(F.size(REASONS) == 0).drop(*_OWN)
    batch = finish(good, spec, case, load_id, extracted_at)
    if stored is None or spec.write_disposition == "replace" or options.full_refresh:
        return batch
    if spec.write_disposition == "append":
        return append(stored, batch)
    keys = [stored_name(spec, k, case) for k in spec.primary_key]
    return merge(stored, batch, keys, order)


def load_resource(
    spark: SparkSession,
    spec: ResourceSpec,
    source: DataFrame,
    dataset: Dataset,
    extracted_at: datetime,
    load_id: str | None = None,
    as_of: datetime | None = None,
    options: LoadOptions = LoadOptions(),
    pipeline: str = "",
) -> dict[str, Any]:
    """Read, conform, check, gate, write, then advance the cursor, then audit.

    The source is read once, into a staged table in the shared folder; checks, rejects and the
    final write read that. Order matters: a stop after the write but before the cursor leads to a
    re-read, which a merge absorbs and an append recognises by its load id. A failure is raised
    after its audit row is saved.
    """
    result, error = _attempt(
        spark, spec, source, dataset, extracted_at, load_id, as_of, options, pipeline
    )
    if error is not None:
        raise error
    return result


def _attempt(spark, spec, source, dataset, extracted_at, load_id, as_of, options, pipeline):
    """One load as ``(audit row, error or None)``; the audit row is saved either way."""
    target = dataset.address(spec.name)
    result: dict[str, Any] = {
        "pipeline_name": pipeline or spec.name,
        "resource": spec.name,
        "success": False,
        "start_time": _utc_now(),
        "destination": target.location,
        "rows_processed": 0,
        "rows_rejected": 0,
    }
    failure = None
    try:
        state = high_water(spark, dataset, spec.name)
        # A derived id comes from the extraction time, so a replay carries that time as well.
        replay_at = extracted_at if load_id is None else None
        load_id = load_id or derive_load_id(spec.name, state, extracted_at)
        result |= {"load_id": load_id, "high_water": state}
        with ExitStack() as held:
            known = boundary(spark, dataset, spec.name, state) if spec.incremental else None
            tagged = judge(new_rows(source, spec, state, options, as_of, known), spec)
            if options.stage:
                tagged = held.enter_context(staged(tagged, "load"))
            good, facts = _checked(
                tagged, spec, dataset, load_id, extracted_at, as_of, options, result
            )
            wrote = _write(good, spec, dataset, load_id, extracted_at, replay_at, options)
            newest = facts["newest"]
            if _moves_cursor(spec, options) and newest is not None:
                tie = F.col(CURSOR).cast("string") == newest
                seen = tagged.filter(tie).select(*[F.col(c).alias(n) for c, n in zip(SEEN, ("seen_a", "seen_b"))])
                save_boundary(seen, dataset, spec.name, newest, facts["micros"], load_id, extracted_at)
        # A replay of a load that the table holds already adds nothing and counts nothing.
        result["rows_processed"] = facts["good"] if wrote else 0
        if _moves_cursor(spec, options) and newest not in (None, state):
            result["high_water"] = newest
            field = spec.incremental.cursor_field
            save_cursor(spark, dataset, spec.name, field, newest, load_id, extracted_at)
        result["success"] = True
        try:
            if dataset.retention_days is not None and as_of is not None:
                retain_table(spark, target, "_extracted_at", as_of, dataset.retention_days)
            if dataset.compact_after_write:
                compact(spark, target, cluster_by=dataset.cluster_by)
        except Exception as error:  # noqa: BLE001 - the rows and the cursor are saved: the load stands
            result["error"] = f"after the load: {str(error).splitlines()[0] if str(error) else type(error).__name__}"
    except Exception as error:  # noqa: BLE001 - handed to the caller with its audit row
        failure = error
        result["error"] = str(error).splitlines()[0] if str(error) else type(error).__name__
    result["end_time"] = _utc_now()
    result["row_counts"] = {dataset.name_of(spec.name): result["rows_processed"]}
    save_audit(spark, dataset, [result])
    return result, failure


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _moves_cursor(spec: ResourceSpec, options: LoadOptions) -> bool:
    """a backfill leaves the cursor alone; a full refresh starts it anew."""
    cursor = spec.incremental
    return cursor is not None and cursor.enabled and options.backfill_days is None


def _checked(tagged, spec, dataset, load_id, extracted_at, as_of, options, result):
    """Store the rejects of the judged batch, gate it, and return the good rows with their numbers.

    A load that its gate stops has rejects and counts them, too.
    """
    checks = () if options.skip_validation else spec.checks
    if options.quarantine:
        tagged = _divert(tagged, spec, checks)
    is_good = F.size(REASONS) == 0
    newest = F.max(F.when(is_good, F.col(CURSOR)))
    instant = isinstance(tagged.schema[CURSOR].dataType, T.TimestampType)
    facts = tagged.agg(
        F.count_if(is_good).alias("good"),
        F.count_if(~is_good).alias("rejected"),
        newest.cast("string").alias("newest"),
        (F.unix_micros(newest) if instant else F.lit(None).cast("long")).alias("micros"),
    ).first()
    body = tagged.filter(is_good).drop(*_OWN)
    result["rows_rejected"] = facts["rejected"]
    if facts["rejected"]:
        rejects = tagged.filter(~is_good).select(
            F.lit(spec.name).alias("resource"),
            quoted(REASONS).alias("reasons"),
            quoted(RAW).alias("raw"),
        )
        reject_id = f"{spec.name}:{load_id}"
        save_rejects(stamp(rejects, reject_id, extracted_at), dataset, reject_id)
    if checks:
        results = _check_batch(body, spec, dataset, checks, extracted_at, as_of, facts["good"] == 0)
        gate(results, options.fail_on_error)
    return body, facts


def _divert(tagged: DataFrame, spec: ResourceSpec, checks: Sequence[Check]) -> DataFrame:
    """Q12 in a load: a conformed row that fails an ``error`` check on rows becomes a reject."""
    rules = tuple(c for c in checks if c.type in ROW_CHECKS and c.severity == "error")
    hidden = {f.lower() for f in spec.pii_fields} | {name.lower() for name in _OWN}
    names = [n for n in tagged.columns if n.lower() not in hidden and not n.startswith((FAILS, SAME))]
    shown = [quoted(name) for name in names]
    failed = F.transform("failed_checks", lambda name: F.concat(F.lit("check "), name))
    diverted = (F.size(REASONS) == 0) & (F.size("failed_checks") > 0)
    raw = F.to_json(F.struct(*(shown or [F.lit(None).cast("string").alias("hidden")])))
    return tag_rows(tagged, rules).withColumns(
        {
            REASONS: F.when(diverted, failed).otherwise(quoted(REASONS)),
            RAW: F.when(diverted, raw).otherwise(quoted(RAW)),
        }
    )


_OWN = (REASONS, CURSOR, RAW, *SEEN, "failed_checks")


def _check_batch(body, spec, dataset, checks, extracted_at, as_of, is_empty) -> DataFrame:
    """Check results of a batch. A load that brings nothing is as fresh as what is stored."""
    spark, target = body.sparkSession, dataset.address(spec.name)
    named = {n.lower() for c in checks for n in (*c.targets, *c.required_columns)}
    seen = body
    if "_extracted_at" in named:
        stamped = typed_literal(extracted_at, T.TimestampType())
        seen = body.withColumn("_extracted_at", stamped)
    # A protected column has another type than the contract says of its source.
    hidden = {f.lower() for f in spec.pii_fields}
    contract = [c for c in _contract(spec, body) if c.name.lower() not in hidden]
    if hidden and any(c.type == "schema" for c in checks):
        shapes = [c for c in checks if c.type == "schema"]
        rest = tuple(c for c in checks if c.type != "schema")
        own = body.drop(*[n for n in body.columns if n.lower() in hidden])
        found = run_checks(own, shapes, as_of, contract)
        if not rest:
            return found
        return _check_batch(body, spec, dataset, rest, extracted_at, as_of, is_empty).unionByName(found)
    ages = [c for c in checks if c.type == "freshness"]
    if not (ages and is_empty and target.exists(spark)):
        return run_checks(seen, checks, as_of, contract)
    names = list(dict.fromkeys(n for c in ages for n in c.targets))
    stored = target.read(spark).select(
        *[quoted(stored_name(spec, n, dataset.case)).alias(n) for n in names]
    )
    fresh = run_checks(stored, ages, as_of)
    others = [c for c in checks if c.type != "freshness"]
    return run_checks(seen, others, as_of, contract).unionByName(fresh) if others else fresh


def _write(good, spec, dataset, load_id, extracted_at, replay_at, options) -> bool:
    """Write the good rows as their disposition says; False if the table held this load already."""
    target, parallelism = dataset.address(spec.name), dataset.parallelism
    layout = {
        "partition_by": dataset.partition_by,
        "cluster_by": dataset.cluster_by,
        "rows_per_file": dataset.rows_per_file,
    }
    rows = finish(good, spec, dataset.case, load_id, extracted_at)
    if not dataset.evolve and target.exists(good.sparkSession):
        have = match_names(target.read(good.sparkSession).columns, rows.columns)
        new = [name for name, column in have.items() if column is None]
        if new:
            raise ValueError(f"Columns {new} are new to {target.location}, whose schema may not evolve")
    if options.full_refresh or spec.write_disposition == "replace":
        write_table(
            rows, target, "replace", **layout, parallelism=parallelism, stage=not options.stage
        )
    elif spec.write_disposition == "append":
        return append_once_table(
            rows, target, load_id, extracted_at=replay_at, **layout, parallelism=parallelism
        )
    else:
        keys = [stored_name(spec, k, dataset.case) for k in spec.primary_key]
        order = _merge_order(spec, rows, dataset.case)
        merge_table(
            rows, target, keys, order, partition_fixed=dataset.partition_fixed, **layout
        )
    return True


def _merge_order(spec: ResourceSpec, rows: DataFrame, case: str) -> list[str]:
    """The stored column that holds the cursor, if the contract kept it."""
    if spec.incremental is None:
        return []
    field = spec.incremental.cursor_field
    name = next((c.name for c in spec.columns if c.source == field), field)
    if "." in name:
        return []
    stored = stored_name(spec, name, case)
    return [stored] if stored in rows.columns else []


def load_resources(
    spark: SparkSession,
    specs: Sequence[ResourceSpec],
    sources: Mapping[str, DataFrame],
    dataset: Dataset,
    extracted_at: datetime,
    as_of: datetime | None = None,
    options: LoadOptions = LoadOptions(),
    pipeline: str = "",
    parallel_loads: int = 1,
) -> DataFrame:
    """Load each resource and return one audit row for each, failures included.

    A resource with a parent is loaded after it, from the rows whose key the parent has just loaded
    (S7); if the parent failed it is skipped, with an audit row that says so. A parent outside of this
    run is taken as it is stored. With ``parallel_loads`` above 1 several loads submit their Spark
    jobs at once, which keeps a cluster busy while one of them finishes its last tasks.
    """
    absent = [s.name for s in specs if s.name not in sources]
    if absent:
        raise ValueError(f"Resources {absent} not found. Available: {list(sources)}")
    results: dict[str, dict[str, Any]] = {}

    def one(spec: ResourceSpec) -> dict[str, Any]:
        frame = sources[spec.name]
        if spec.parent is not None:
            above = results.get(spec.parent.resource)
            if above is not None and not above["success"]:
                return _skipped(spark, spec, dataset, pipeline)
            frame = _fed(spark, spec, frame, specs, dataset, above)
        return _attempt(
            spark, spec, frame, dataset, extracted_at, None, as_of, options, pipeline
        )[0]

    for step in in_parent_order(specs):
        if parallel_loads > 1:
            with ThreadPoolExecutor(parallel_loads) as pool:
                found = list(pool.map(inheritable_thread_target(spark)(one), step))
        else:
            found = [one(spec) for spec in step]
        results |= {spec.name: row for spec, row in zip(step, found)}
    return load_audit(spark, [results[s.name] for s in specs])


def _fed(spark, spec: ResourceSpec, frame: DataFrame, specs, dataset: Dataset, above) -> DataFrame:
    """The rows of ``frame`` whose key the parent's load ``above`` has written, or its table holds."""
    target = dataset.address(spec.parent.resource)
    if not target.exists(spark):
        return frame.limit(0)
    stored = target.read(spark)
    if above is not None:
        stored = stored.filter(quoted("_load_id") == above["load_id"])
    parent = next((s for s in specs if s.name == spec.parent.resource), ResourceSpec(spec.parent.resource))
    key = stored_name(parent, spec.parent.parent_key, dataset.case)
    return feed_from_parent(frame, stored, spec.parent.child_key, key)


def _skipped(spark, spec: ResourceSpec, dataset: Dataset, pipeline: str) -> dict[str, Any]:
    """The audit row of a resource whose parent failed."""
    now = _utc_now()
    result = {
        "pipeline_name": pipeline or spec.name,
        "resource": spec.name,
        "success": False,
        "start_time": now,
        "end_time": now,
        "destination": dataset.address(spec.name).location,
        "rows_processed": 0,
        "rows_rejected": 0,
        "error": f"skipped: its parent '{spec.parent.resource}' failed",
        "row_counts": {dataset.name_of(spec.name): 0},
    }
    save_audit(spark, dataset, [result])
    return result
