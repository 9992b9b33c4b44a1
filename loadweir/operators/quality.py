"""Data-quality checks (Q1-Q12).

Every check except ``unique`` is an aggregate over the table, so all of them share one scan with
no shuffle but the final merge of one row per task. Each ``unique`` check adds a scan of its key
columns and a shuffle of key counts that were already added up inside each task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from loadweir.functions.columns import failed_texts, path_type, typed_literal
from loadweir.operators.columns import match_names, quoted
from loadweir.operators.merging import all_set
from loadweir.spec import ROW_CHECKS, Check, Column

RESULT_COLUMNS = (
    "check_name", "check_type", "column_name", "total_rows", "failed_rows", "passed", "severity",
)


class QualityError(Exception):
    """A gate refused a load; ``failures`` holds the result rows that made it."""

    def __init__(self, failures: Sequence[Row]) -> None:
        self.failures = list(failures)
        named = ", ".join(f"{r.check_name} ({r.failed_rows} of {r.total_rows})" for r in failures)
        super().__init__(f"Data quality checks failed: {named}")


# Beginnings of the columns that stand for values a frame no longer holds in the clear.
FAILS, SAME = "__fails:", "__same:"


@dataclass(frozen=True)
class _RowRule:
    """One row-level test: what to call it and when a row fails it."""

    name: str
    check: Check
    column: str
    failed: SparkColumn


def _find(df: DataFrame, name: str) -> str:
    column = match_names(df.columns, [name])[name]
    if column is None:
        raise ValueError(f"Checked column '{name}' not found. Available: {df.columns}")
    return column


def _label(check: Check, column: str, single: bool) -> str:
    if check.name:
        return check.name if single else f"{check.name}:{column}"
    return f"{check.type}:{column}" if column else check.type


def _row_rules(df: DataFrame, checks: Sequence[Check]) -> list[_RowRule]:
    """Row-level checks spelled out, one rule per column; completeness is one rule per check."""
    rules = []
    for check in checks:
        if check.type not in ROW_CHECKS:
            continue
        if check.type == "completeness":
            column = ",".join(check.required_columns)
            label = _label(check, column, True)
            if FAILS + label in df.columns:
                rules.append(_RowRule(label, check, column, quoted(FAILS + label)))
                continue
            found = match_names(df.columns, check.required_columns)
            absent = any(column is None for column in found.values())
            failed = F.lit(True) if absent else ~all_set(list(found.values()))
            rules.append(_RowRule(label, check, column, failed))
            continue
        for name in check.targets:
            label = _label(check, name, len(check.targets) == 1)
            if FAILS + label in df.columns:
                rules.append(_RowRule(label, check, name, quoted(FAILS + label)))
                continue
            value = quoted(_find(df, name))
            if check.type == "not_null":
                failed = value.isNull()
            elif check.type == "positive":
                failed = value <= 0
            elif check.type == "pattern":
                failed = ~value.cast("string").rlike(check.pattern)
            else:
                failed = F.lit(False)
                if check.min_value is not None:
                    failed = failed | (value < check.min_value)
                if check.max_value is not None:
                    failed = failed | (value > check.max_value)
            rules.append(_RowRule(label, check, name, failed))
    labels = [r.name for r in rules]
    twice = sorted({n for n in labels if labels.count(n) > 1})
    if twice:
        raise ValueError(f"Checks need distinct names: {twice}")
    return rules


def stand_ins(df: DataFrame, checks: Sequence[Check], fields: Sequence[str]) -> dict[str, SparkColumn]:
    """Columns by which ``checks`` can still be run once ``fields`` are protected.

    A row-level check of a field is answered while its value is in the clear; a unique one gets a
    hash in its place, which a mask or a dropped column would not be.
    """
    hidden = {f.lower() for f in fields}
    out = {}
    for rule in _row_rules(df, [c for c in checks if c.type in ROW_CHECKS]):
        if hidden & {n.lower() for n in (rule.check.required_columns or (rule.column,))}:
            out[FAILS + rule.name] = F.coalesce(rule.failed, F.lit(False))
    for check in checks:
        if check.type == "unique":
            for name in check.targets:
                if name.lower() in hidden:
                    out[SAME + name.lower()] = F.sha2(quoted(_find(df, name)).cast("string"), 256)
    return out


def _result(name, check: Check, column: str, total, failed, passed) -> SparkColumn:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(check.type).alias("check_type"),
        F.lit(column).alias("column_name"),
        total.cast("bigint").alias("total_rows"),
        failed.cast("bigint").alias("failed_rows"),
        passed.alias("passed"),
        F.lit(check.severity).alias("severity"),
    )


def schema_differences(df: DataFrame, contract: Sequence[Column]) -> list[tuple[str, str | None]]:
    """Q9: ``(column, problem)`` for every declared or present column; None means it agrees."""
    found = match_names(df.columns, [c.name for c in contract])
    out: list[tuple[str, str | None]] = []
    for column in contract:
        have = found[column.name]
        if have is None:
            out.append((column.name, "missing"))
        elif df.schema[have].dataType.simpleString() != column.sql_type:
            out.append((column.name, f"type {df.schema[have].dataType.simpleString()}"))
        else:
            out.append((column.name, None))
    extra = [n for n in df.columns if n not in found.values() and not n.startswith((FAILS, SAME))]
    return out + [(name, "extra") for name in extra]


def run_checks(
    df: DataFrame,
    checks: Sequence[Check],
    as_of: datetime | None = None,
    contract: Sequence[Column] | None = None,
) -> DataFrame:
    """Q1-Q9: one result row per check and column.

    ``failed_rows`` counts rows for the row-level checks and for ``unique`` (rows beyond the first
    of a key). For a check on the whole table (freshness, volume, schema) it is 1 or 0.
    """
    parts: list[DataFrame] = []
    aggregates: list[SparkColumn] = [F.count(F.lit(1)).alias("total")]
    results: list[SparkColumn] = []
    total = F.col("total")

    for rule in _row_rules(df, checks):
        slot = f"failed_{len(aggregates)}"
        aggregates.append(F.count_if(rule.failed).alias(slot))
        passed = F.col(slot) == 0
        answered = FAILS + rule.name in df.columns
        if rule.check.type == "completeness" and not answered and not _has_all(df, rule.check.required_columns):
            passed = F.lit(False)
        results.append(_result(rule.name, rule.check, rule.column, total, F.col(slot), passed))

    for check in checks:
        if check.type == "freshness":
            if as_of is None:
                raise ValueError("a freshness check needs as_of")
            for name in check.targets:
                column = _find(df, name)
                slot = f"newest_{len(aggregates)}"
                aggregates.append(F.max(quoted(column)).alias(slot))
                age = _age(df, column, F.col(slot), as_of)
                most = round(check.max_age_hours * 3_600_000_000)
                fresh = F.coalesce(age <= most, F.lit(False))
                label = _label(check, name, len(check.targets) == 1)
                results.append(_result(label, check, name, total, (~fresh).cast("int"), fresh))
        elif check.type == "volume":
            inside = F.lit(True)
            if check.min_rows is not None:
                inside = inside & (total >= check.min_rows)
            if check.max_rows is not None:
                inside = inside & (total <= check.max_rows)
            label = _label(check, "", True)
            results.append(_result(label, check, "", total, (~inside).cast("int"), inside))
        elif check.type == "schema":
            if contract is None:
                raise ValueError("a schema check needs a contract")
            for name, problem in schema_differences(df, contract):
                label = _label(check, name, False)
                failed, passed = F.lit(int(problem is not None)), F.lit(problem is None)
                results.append(_result(label, check, name, total, failed, passed))
        elif check.type == "unique":
            parts.append(_unique(df, check))

    if results:
        parts.insert(0, df.agg(*aggregates).select(F.inline(F.array(*results))))
    if not parts:
        raise ValueError("no checks given")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _has_all(df: DataFrame, names: Sequence[str]) -> bool:
    return None not in match_names(df.columns, names).values()


def _age(df: DataFrame, column: str, newest: SparkColumn, as_of: datetime):
    """Microseconds from ``newest`` to ``as_of``, whichever timestamp type is used."""
    kind = path_type(df, f"`{column}`")
    return F.timestamp_diff("MICROSECOND", newest, typed_literal(as_of, kind))


def _unique(df: DataFrame, check: Check) -> DataFrame:
    """Q2: exact count of rows beyond the first per key; keys holding a NULL are skipped.

    The count per key is added up inside each task before the shuffle, so one key with a third of
    all rows is still one partial count per task.
    """
    own = [SAME + name.lower() for name in check.targets]
    keys = [s if s in df.columns else _find(df, name) for s, name in zip(own, check.targets)]
    name = ",".join(check.targets)
    per_key = df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("n_in_key"))
    beyond = F.when(all_set(keys), F.col("n_in_key") - 1).otherwise(0)
    counts = per_key.agg(
        F.coalesce(F.sum("n_in_key"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(beyond), F.lit(0)).alias("failed"),
    )
    total, failed = F.col("total"), F.col("failed")
    row = _result(_label(check, name, True), check, name, total, failed, failed == 0)
    return counts.select(F.inline(F.array(row)))


def gate(results: DataFrame, fail_on_error: bool = True) -> list[Row]:
    """Q10: raise :class:`QualityError` if an ``error`` check failed and ``fail_on_error`` is set.

    Otherwise the failed results come back as warnings. This reads the results frame to the
    driver: a row per check and column, whatever the size of the table.
    """
    failed = results.filter(~F.col("passed")).collect()
    errors = [r for r in failed if r.severity == "error"]
    if errors and fail_on_error:
        raise QualityError(errors)
    return failed


def gate_action(results: DataFrame, fail_on_error: bool = True) -> DataFrame:
    """Q10 as a frame: every result with what a gate does about it, ``pass|warn|abort``."""
    stops = (F.col("severity") == "error") & F.lit(fail_on_error)
    action = F.when(F.col("passed"), "pass").when(stops, "abort").otherwise("warn")
    return results.withColumn("action", action)


def quality_score(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q11: the share of checks that passed, per group of ``by``."""
    share = F.avg(F.col("passed").cast("double")).alias("quality_score")
    passed = F.count_if(F.col("passed")).alias("passed_checks")
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("checks"), passed, share)


def tag_rows(df: DataFrame, checks: Sequence[Check], tag: str = "failed_checks") -> DataFrame:
    """Q12: add the array of row-level checks each row fails; it is empty for a good row.

    Good and quarantined rows are filters of this frame on ``size(failed_checks)``.
    """
    return df.withColumn(tag, failed_texts([(r.failed, r.name) for r in _row_rules(df, checks)]))


def split_tagged(tagged: DataFrame, tag: str = "failed_checks") -> tuple[DataFrame, DataFrame]:
    """Q12: ``(good, quarantined)`` of a tagged frame; the good rows lose the tag."""
    good = tagged.filter(F.size(quoted(tag)) == 0).drop(tag)
    return good, tagged.filter(F.size(quoted(tag)) > 0)
