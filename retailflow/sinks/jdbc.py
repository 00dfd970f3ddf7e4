"""Database sinks: plain writes and the staged merge."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from retailflow.operators.merge import merge_sql
from retailflow.sources.jdbc import DEFAULTS

WRITE_DEFAULTS = {**DEFAULTS, "batchsize": "10000"}
MODES = ("ignore", "overwrite", "append")


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str, properties: dict[str, str], truncate: bool = False
) -> None:
    """Write a frame to a database table from all executors."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    options = {**WRITE_DEFAULTS, **properties}
    if truncate:
        options["truncate"] = "true"
    df.write.jdbc(url=url, table=table, mode=mode, properties=options)


def staging_name(table: str) -> str:
    """A staging table name that no other run uses."""
    return f"{table}_staging_{uuid.uuid4().hex[:12]}"


def staged_merge(
    df: DataFrame,
    url: str,
    table: str,
    keys: list[str],
    properties: dict[str, str],
    execute: Callable[[list[str]], None],
    update: str | list[str] | None = "*",
    write: Callable[..., None] = write_jdbc,
    before: list[str] | None = None,
) -> list[str]:
    """Merge a frame into a database table through a staging table.

    Executors write the staging table; ``execute`` then runs the merge and the
    drop of the staging table as one transaction in the database. The target is
    created empty when missing, or by the ``before`` statements. Returns the
    statements of the transaction.
    """
    staging = staging_name(table)
    if before:
        execute(before)
    write(df.limit(0), url, table, "ignore", properties)
    write(df, url, staging, "overwrite", properties)
    statements = [
        merge_sql(table, staging, df.columns, keys, update),
        f"DROP TABLE {staging}",
    ]
    execute(statements)
    return statements


def clear_statements(table: str, how: str) -> list[str]:
    """Statements that empty (``delete``) or remove (``drop``) a database table."""
    texts = {"delete": f"DELETE FROM {table}", "drop": f"DROP TABLE IF EXISTS {table}"}
    return [texts[how]]


def transaction(connect: Callable[[], object]) -> Callable[[list[str]], None]:
    """An ``execute`` for ``staged_merge`` over a DB-API connection."""

    def execute(statements: list[str]) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    return execute
