"""Load data with Spark, keep it to its contract, check it, and report on it."""

from loadweir.spec import Check, Column, Incremental, ResourceSpec, specs_from_source

__all__ = ["Check", "Column", "Incremental", "ResourceSpec", "specs_from_source"]
