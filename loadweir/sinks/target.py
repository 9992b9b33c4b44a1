"""Where a resource is written: a catalog table or a folder, and how it is addressed."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadweir.functions.naming import table_name

# Table formats whose catalogs can change rows in place.
ROW_LEVEL_FORMATS = ("delta", "iceberg")
# Fixed value: how a folder name spells a partition whose value is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Target:
    """One table, by catalog name or by folder."""

    location: str
    is_folder: bool
    fmt: str = "parquet"

    @classmethod
    def folder(cls, path: str, fmt: str = "parquet") -> Target:
        return cls(path.rstrip("/"), True, fmt)

    @classmethod
    def table(cls, name: str, fmt: str = "parquet") -> Target:
        return cls(name, False, fmt)

    def exists(self, spark: SparkSession) -> bool:
        """Whether the table is there, after putting right a folder swap that stopped half way.

        One load at a time writes a table, so a leftover is never another load's work in progress.
        """
        if not self.is_folder:
            return spark.catalog.tableExists(self.location)
        files, previous, held = FileTree(spark), self.location + PREVIOUS, self.location + HELD
        if files.exists(previous):
            if files.exists(self.location):
                files.delete(previous)
            else:
                files.move(previous, self.location)
        if files.exists(held):
            for leaf in files.partition_folders(held):
                if not files.exists(f"{self.location}/{leaf}"):
                    files.move(f"{held}/{leaf}", f"{self.location}/{leaf}")
            files.delete(held)
        return files.exists(self.location)

    def swap_in(self, spark: SparkSession, fresh: str) -> None:
        """Put the folder ``fresh`` in the place of the whole table."""
        files = FileTree(spark)
        files.move(self.location, self.location + PREVIOUS)
        files.move(fresh, self.location)
        files.delete(self.location + PREVIOUS)

    def swap_in_partitions(self, spark: SparkSession, fresh: str) -> None:
        """Put the partitions of ``fresh`` in the place of the table's own, one by one.

        Old partitions are held until all are replaced, so a stop loses none of them.
        """
        files = FileTree(spark)
        for leaf in files.partition_folders(fresh):
            if files.exists(f"{self.location}/{leaf}"):
                files.move(f"{self.location}/{leaf}", f"{self.location}{HELD}/{leaf}")
            files.move(f"{fresh}/{leaf}", f"{self.location}/{leaf}")
        files.delete(self.location + HELD)
        files.delete(fresh)

    def read(
        self,
        spark: SparkSession,
        partition_types: Mapping[str, T.DataType] | None = None,
        schema: T.StructType | None = None,
    ) -> DataFrame:
        """The stored rows.

        A folder has no catalog to hold its schema; a file in it does (:data:`SCHEMA_FILE`), which
        whoever writes here keeps up to date, so no footer is opened to plan a read and a partition
        value such as ``007`` keeps its type. A folder that came from elsewhere has its files' schemas
        merged. ``partition_types`` overrides the types of partition columns, ``schema`` all.
        """
        if not self.is_folder:
            return spark.table(self.location)
        if schema is None:
            schema = self.saved_schema(spark)
            if schema is not None and partition_types:
                fields = [T.StructField(f.name, partition_types.get(f.name, f.dataType)) for f in schema.fields]
                schema = T.StructType(fields)
        if schema is not None:
            return spark.read.format(self.fmt).schema(schema).load(self.location)
        reader = spark.read.format(self.fmt)
        if self.fmt in ("parquet", "orc"):
            reader = reader.option("mergeSchema", True)
        stored = reader.load(self.location)
        if not partition_types:
            return stored
        fields = [(f.name, partition_types.get(f.name, f.dataType)) for f in stored.schema.fields]
        return self.read(spark, schema=T.StructType([T.StructField(*f) for f in fields]))

    def saved_schema(self, spark: SparkSession) -> T.StructType | None:
        """The schema that the folder's last writer has left, if any."""
        text = FileTree(spark).read_text(f"{self.location}/{SCHEMA_FILE}")
        return None if text is None else T.StructType.fromJson(json.loads(text))

    def save_schema(self, spark: SparkSession, schema: T.StructType) -> None:
        """Leave the schema of all that the folder holds. Before rows that add columns, so a stop in between loses none."""
        FileTree(spark).write_text(f"{self.location}/{SCHEMA_FILE}", schema.json())

    def path(self, spark: SparkSession) -> str:
        """The folder that holds the files of an existing table."""
        if self.is_folder:
            return self.location
        return self.described(spark)["Location"].rstrip("/")

    def described(self, spark: SparkSession) -> dict[str, str]:
        """What the catalog says of a table, its columns aside."""
        rows = [tuple(row)[:2] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {self.location}").collect()]
        start = next(i for i, (name, _) in enumerate(rows) if name == "# Detailed Table Information")
        return dict(rows[start + 1 :])

    def partition_columns(self, spark: SparkSession) -> list[str]:
        """The columns the stored table is partitioned by."""
        if not self.is_folder:
            return [c.name for c in spark.catalog.listColumns(self.location) if c.isPartition]
        return FileTree(spark).partition_keys(self.location)


# The file of a folder table that holds its schema; Spark ignores names that begin like this.
SCHEMA_FILE = "_loadweir_schema.json"
# Endings of the folders that hold what a swap is replacing.
PREVIOUS = "__previous"
HELD = "__held"
# Ending, with 32 hex digits, of the folder that a replaced catalog table points to.
VERSION = "__v-"


def unversioned(path: str) -> str:
    """The folder of a catalog table, whatever version of it is in use."""
    return re.sub(re.escape(VERSION) + "[0-9a-f]{32}$", "", path.rstrip("/"))


@dataclass(frozen=True)
class Dataset:
    """A destination dataset: the tables of one pipeline plus its cursors, audit and rejects.

    Give ``root`` for folders or ``schema`` (with an optional ``catalog``) for catalog tables.
    ``partition_fixed`` says that a key never changes partition, so a merge need not look for it.
    Without ``evolve`` a load that brings columns a table does not have fails.
    """

    root: str | None = None
    schema: str | None = None
    catalog: str | None = None
    fmt: str = "parquet"
    prefix: str = ""
    suffix: str = ""
    case: str = "snake_case"
    partition_by: Sequence[str] = ()
    partition_fixed: bool = False
    cluster_by: Sequence[str] = ()
    rows_per_file: int | None = None
    parallelism: int | None = None
    retention_days: int | None = None
    compact_after_write: bool = False
    evolve: bool = True

    def __post_init__(self) -> None:
        if (self.root is None) == (self.schema is None):
            raise ValueError("a dataset needs either root or schema")

    def name_of(self, resource: str) -> str:
        """The table name a resource gets from the naming convention."""
        return table_name(resource, self.prefix, self.suffix, self.case)

    def address(self, resource: str) -> Target:
        """``catalog.schema.table`` or ``root/table``."""
        return self._at(self.name_of(resource))

    def bookkeeping(self, name: str) -> Target:
        """A table of the dataset itself, which no resource name can collide with."""
        return self._at(f"loadweir__{name}")

    def _at(self, name: str) -> Target:
        if self.root is not None:
            return Target.folder(f"{self.root.rstrip('/')}/{name}", self.fmt)
        parts = [p for p in (self.catalog, self.schema, name) if p]
        return Target.table(".".join(f"`{p}`" for p in parts), self.fmt)


class FileTree:
    """The few folder operations Spark's own API lacks, on whatever file system a path names."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        files, where = self._open(path)
        return files.exists(where)

    def delete(self, path: str) -> None:
        files, where = self._open(path)
        files.delete(where, True)

    def delete_uri(self, uri: str) -> None:
        """Delete a file named by ``_metadata.file_path``, which is an encoded URI."""
        where = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(uri))
        where.getFileSystem(self._conf).delete(where, False)

    def read_text(self, path: str) -> str | None:
        """A small file's text, or None if it is not there."""
        files, where = self._open(path)
        if not files.exists(where):
            return None
        stream = files.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Put a small file in its place at once: written beside it, then renamed over it."""
        files, where = self._open(path)
        fresh = self._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid4().hex}")
        stream = files.create(fresh, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        files.delete(where, False)
        if not files.rename(fresh, where):
            raise OSError(f"could not write {path}")

    def mark(self, path: str) -> None:
        """Create an empty file, with its folders; one that is there already stays."""
        files, where = self._open(path)
        files.create(where, True).close()

    def move(self, old: str, new: str) -> None:
        files, where = self._open(old)
        to = self._jvm.org.apache.hadoop.fs.Path(new)
        files.mkdirs(to.getParent())
        if not files.rename(where, to):
            raise OSError(f"could not move {old} to {new}")

    def _steps(self, path: str) -> Iterator[str]:
        """Names of the ``key=value`` folders right below ``path``."""
        files, where = self._open(path)
        for status in files.listStatus(where):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                yield name

    def partition_keys(self, path: str) -> list[str]:
        """``key`` of every ``key=value`` folder level, following the first one down."""
        keys: list[str] = []
        step = next(self._steps(path), None)
        while step is not None:
            keys.append(step.split("=", 1)[0])
            path = f"{path}/{step}"
            step = next(self._steps(path), None)
        return keys

    def partition_folders(self, path: str) -> list[str]:
        """The innermost ``key=value/...`` folders, relative to ``path``."""
        leaves = []
        for step in self._steps(path):
            below = self.partition_folders(f"{path}/{step}")
            leaves += [f"{step}/{leaf}" for leaf in below] or [step]
        return leaves
