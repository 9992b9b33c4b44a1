"""What a resource is, what its columns must look like, and which checks it must pass.

These are frozen value objects with argument checks only. They never touch data; the operators
read them while they build a plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# The contract's type names and the Spark SQL type each stands for. "integer" is
# 64-bit because it is used for view counts.
DATA_TYPES = {
    "string": "string",
    "integer": "bigint",
    "float": "double",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "date": "date",
    "json": "variant",
}

# Names accepted in configuration.
WRITE_DISPOSITIONS = ("append", "replace", "merge")
ROW_CHECKS = ("not_null", "positive", "range", "pattern", "completeness")
TABLE_CHECKS = ("unique", "freshness", "volume", "schema")
NAMING_CASES = ("snake_case", "camel_case", "pascal_case")
PII_MODES = ("hash", "mask", "drop")


def _tuple(value: Any) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


@dataclass(frozen=True)
class Column:
    """One column of a contract. ``path`` reads a nested value into a flat column."""

    name: str
    data_type: str
    nullable: bool = True
    path: str | None = None
    description: str | None = None
    primary_key: bool = False

    def __post_init__(self) -> None:
        if self.data_type not in DATA_TYPES:
            raise ValueError(
                f"Column '{self.name}': unknown data type '{self.data_type}'. "
                f"Known types: {sorted(DATA_TYPES)}"
            )

    @property
    def sql_type(self) -> str:
        return DATA_TYPES[self.data_type]

    @property
    def source(self) -> str:
        return self.path or self.name


@dataclass(frozen=True)
class Check:
    """One data-quality check; ``type`` decides which parameters matter."""

    type: str
    columns: tuple[str, ...] = ()
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    max_age_hours: float | None = None
    min_rows: int | None = None
    max_rows: int | None = None
    required_columns: tuple[str, ...] = ()
    severity: str = "error"
    name: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", _tuple(self.columns))
        object.__setattr__(self, "required_columns", _tuple(self.required_columns))
        if self.type not in ROW_CHECKS + TABLE_CHECKS:
            raise ValueError(f"Unknown check type '{self.type}'")
        if self.severity not in ("error", "warning"):
            raise ValueError(f"Unknown severity '{self.severity}'; use 'error' or 'warning'")
        missing = {
            "not_null": not self.targets,
            "unique": not self.targets,
            "positive": not self.targets,
            "range": not self.targets or (self.min_value is None and self.max_value is None),
            "pattern": not self.targets or self.pattern is None,
            "freshness": not self.targets or self.max_age_hours is None,
            "completeness": not self.required_columns,
            "volume": self.min_rows is None and self.max_rows is None,
            "schema": False,
        }[self.type]
        if missing:
            raise ValueError(f"Check '{self.type}' lacks the parameters it needs")

    @property
    def targets(self) -> tuple[str, ...]:
        """The columns looked at; ``column`` and ``columns`` are interchangeable."""
        return self.columns or _tuple(self.column)

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> Check:
        known = set(cls.__dataclass_fields__)
        return cls(**{k: v for k, v in config.items() if k in known})


@dataclass(frozen=True)
class Incremental:
    """Load only rows past a cursor, starting from ``initial_value`` on the first run."""

    cursor_field: str
    initial_value: Any
    enabled: bool = True
    inclusive: bool = False

    def __post_init__(self) -> None:
        if self.enabled and not self.cursor_field:
            raise ValueError("incremental is enabled but cursor_field is empty")


@dataclass(frozen=True)
class Parent:
    """A resource is read for the keys its parent has just loaded.

    ``child_key`` is a column of this resource's source, ``parent_key`` one of the parent's contract.
    """

    resource: str
    parent_key: str
    child_key: str


@dataclass(frozen=True)
class ResourceSpec:
    """A named record set: its contract, key, cursor, checks and how it is written."""

    name: str
    primary_key: tuple[str, ...] = ()
    write_disposition: str = "append"
    columns: tuple[Column, ...] = ()
    incremental: Incremental | None = None
    checks: tuple[Check, ...] = ()
    pii_fields: tuple[str, ...] = ()
    pii_mode: str = "hash"
    pii_salt: str = ""
    aliases: Mapping[str, str] = field(default_factory=dict)
    params: Mapping[str, Any] = field(default_factory=dict)
    extra_columns: str = "drop"
    parent: Parent | None = None

    def __post_init__(self) -> None:
        for name in ("primary_key", "pii_fields"):
            object.__setattr__(self, name, _tuple(getattr(self, name)))
        for name in ("columns", "checks"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if not self.primary_key:
            declared = tuple(c.name for c in self.columns if c.primary_key)
            object.__setattr__(self, "primary_key", declared)
        if self.write_disposition not in WRITE_DISPOSITIONS:
            raise ValueError(
                f"Resource '{self.name}': unknown write_disposition '{self.write_disposition}'"
            )
        if self.write_disposition == "merge" and not self.primary_key:
            raise ValueError(
                f"Resource '{self.name}': write_disposition is 'merge' but no primary_key defined"
            )
        if self.pii_mode not in PII_MODES:
            raise ValueError(f"Resource '{self.name}': unknown pii_mode '{self.pii_mode}'")
        if self.pii_mode == "drop" and set(self.pii_fields) & set(self.primary_key):
            raise ValueError(f"Resource '{self.name}': a primary key column cannot be dropped")

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> ResourceSpec:
        """Build a spec from one parsed resource mapping of a configuration file.

        ``schema`` and ``table_schema`` are the same thing here, so a declared contract is never
        ignored because of the name it was given.
        """
        contract = config.get("schema") or config.get("table_schema") or {}
        quality = config.get("data_quality") or {}
        cursor = config.get("incremental")
        parent = config.get("parent")
        return cls(
            name=config["name"],
            primary_key=_tuple(config.get("primary_key")),
            write_disposition=config.get("write_disposition", "append"),
            columns=tuple(Column(**c) for c in contract.get("columns", ())),
            incremental=Incremental(
                cursor_field=cursor.get("cursor_field", ""),
                initial_value=cursor.get("initial_value"),
                enabled=cursor.get("enabled", True),
                inclusive=cursor.get("inclusive", False),
            )
            if cursor
            else None,
            checks=tuple(Check.from_dict(c) for c in quality.get("checks", ())),
            pii_fields=_tuple(config.get("pii_fields")),
            pii_mode=config.get("pii_mode", "hash"),
            pii_salt=config.get("pii_salt", ""),
            aliases=dict(config.get("aliases") or {}),
            params=dict(config.get("params") or {}),
            extra_columns=config.get("extra_columns", "drop"),
            parent=Parent(parent["resource"], parent["key"], parent.get("child_key", parent["key"])) if parent else None,
        )


def in_parent_order(specs: Sequence[ResourceSpec]) -> list[list[ResourceSpec]]:
    """The resources in steps: one stands in a later step than its parent, if that is among them."""
    names = {s.name for s in specs}
    steps: list[list[ResourceSpec]] = []
    done: set[str] = set()
    left = list(specs)
    while left:
        step = [s for s in left if s.parent is None or s.parent.resource in done or s.parent.resource not in names]
        if not step:
            raise ValueError(f"Resources {[s.name for s in left]} are each other's parents")
        steps.append(step)
        done |= {s.name for s in step}
        left = [s for s in left if s.name not in done]
    return steps


def specs_from_source(config: Mapping[str, Any]) -> dict[str, ResourceSpec]:
    """Every resource of a parsed source mapping, by name and in file order."""
    body = config.get("source", config)
    resources: Sequence[Mapping[str, Any]] = body.get("resources") or ()
    if not resources:
        raise ValueError("Source must have at least one resource defined")
    return {r["name"]: ResourceSpec.from_dict(r) for r in resources}
