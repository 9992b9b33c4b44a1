"""Source types and the resources of a source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from loadweir.sources.landing import open_landing
from loadweir.sources.readers import read_files, read_jdbc, read_json_records, read_stream

# The source type names of the configuration. A "rest_api" source is read from the
# bodies that were landed for it.
_OPENERS: dict[str, Callable[..., DataFrame]] = {
    "rest_api": read_json_records,
    "file": read_files,
    "database": read_jdbc,
    "stream": read_stream,
    "landing": open_landing,
}


def register_source(kind: str, opener: Callable[..., DataFrame]) -> None:
    """Add a source type. ``opener(spark, **options)`` returns a DataFrame."""
    _OPENERS[kind] = opener


def open_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Open a registered source type; an unknown one raises, naming those there are."""
    if kind not in _OPENERS:
        raise ValueError(f"Unsupported source type: {kind}. Supported types: {list(_OPENERS)}")
    return _OPENERS[kind](spark, **options)


def select_resources(
    source: Mapping[str, DataFrame], names: Iterable[str], source_name: str = "source"
) -> dict[str, DataFrame]:
    """The requested resources, in request order. Frames that are not asked for stay unread."""
    if not source:
        raise ValueError(f"Source '{source_name}' has no resources")
    chosen = {}
    for name in names:
        if name not in source:
            raise ValueError(f"Resource '{name}' not found in source '{source_name}'")
        chosen[name] = source[name]
    return chosen
