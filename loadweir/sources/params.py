"""Parameters of a resource."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_PLACEHOLDER = re.compile(r"\{([^{}]+)\}")


def merge_params(defaults: Mapping[str, Any], *overrides: Mapping[str, Any]) -> dict[str, Any]:
    """Later mappings win: pipeline parameters, then trigger or job, then per-pipeline ones."""
    merged = dict(defaults)
    for override in overrides:
        merged.update(override or {})
    return merged


def bind_params(
    templates: Mapping[str, Any], values: Mapping[str, Any], *overrides: Mapping[str, Any]
) -> dict[str, Any]:
    """Fill ``{key}`` in string values; unknown placeholders and other types stay as they are.

    The text is read once, so a value that itself looks like a placeholder is not filled again.
    """
    known = merge_params(values, *overrides)

    def fill(match: re.Match[str]) -> str:
        return str(known[match[1]]) if match[1] in known else match[0]

    return {
        key: _PLACEHOLDER.sub(fill, value) if isinstance(value, str) else value
        for key, value in templates.items()
    }


def read_query(
    spark: SparkSession,
    text: str,
    params: Mapping[str, Any] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """SQL with ``:name`` parameters, bound as typed literals that Catalyst can push down.

    ``frames`` may be named in the text as ``{name}``. Values are never spliced into the text, so a
    quote inside one is just a character.
    """
    return spark.sql(text, args=dict(params or {}), **frames)
