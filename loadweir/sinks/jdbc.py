"""Database sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame

from loadweir.operators.merging import all_set, latest_per_key


def merge_statements(
    table: str, staging: str, keys: Sequence[str], columns: Sequence[str]
) -> list[str]:
    """The ANSI statements that move a staged batch into ``table``, for one transaction."""
    same = " AND ".join(f'{table}."{k}" = {staging}."{k}"' for k in keys)
    names = ", ".join(f'"{c}"' for c in columns)
    return [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    disposition: str = "append",
    parallelism: int | None = None,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    execute: Callable[[list[str]], None] | None = None,
) -> None:
    """Write to a database table by append, replace or merge.

    ``parallelism`` bounds the connections. Replace empties the table and keeps its definition. A
    merge writes the batch, reduced to one row per key, in parallel to a staging table that no other
    load uses (``<table>_`` and 12 hex digits) and hands two statements to ``execute``, so that the
    database changes its table in one transaction; the staging table is dropped by another call. A
    merge that fails leaves it, for a look at its rows.
    """
    options = dict(properties or {})
    if disposition not in ("append", "replace", "merge"):
        raise ValueError(f"Unknown write disposition '{disposition}'")
    if disposition == "merge":
        if not keys:
            raise ValueError("a merge needs a primary key")
        df = latest_per_key(df.filter(all_set(keys)), keys, order)
    if parallelism:
        # A JDBC write opens one connection per task; fewer tasks than partitions need no shuffle.
        df = df.coalesce(parallelism)
    if disposition == "append":
        df.write.jdbc(url, table, mode="append", properties=options)
    elif disposition == "replace":
        df.write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=options)
    else:
        if execute is None:
            execute = _jvm_transaction(df, url, options)
        staging = f"{table}_{uuid4().hex[:12]}"
        df.write.jdbc(url, staging, mode="overwrite", properties=options)
        execute(merge_statements(table, staging, list(keys), df.columns))
        execute([f"DROP TABLE {staging}"])


def _jvm_transaction(df: DataFrame, url: str, options: Mapping[str, str]):
    """Run statements in one transaction over the driver that Spark's own JDBC write loaded."""
    jvm = df.sparkSession._jvm

    def execute(statements: list[str]) -> None:
        login = jvm.java.util.Properties()
        for name, value in options.items():
            login.setProperty(name, str(value))
        connection = jvm.java.sql.DriverManager.getConnection(url, login)
        try:
            connection.setAutoCommit(False)
            for text in statements:
                statement = connection.createStatement()
                statement.executeUpdate(text)
                statement.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    return execute
