"""Database scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Poolers that share connections break server-side prepared statements.
DEFAULTS = {"prepareThreshold": "0", "fetchsize": "10000"}


def jdbc_options(
    url: str,
    table_or_query: str,
    properties: dict[str, str],
    partition: tuple[str, object, object, int] | None = None,
) -> dict[str, str]:
    """Reader options for a table, or for a query that the database runs.

    ``partition`` is (column, lower, upper, tasks) and makes the read parallel;
    the bounds only shape the ranges, rows outside them are read too.
    """
    text = table_or_query.strip().rstrip(";")
    is_query = text.lower().startswith(("select", "with"))
    options = {**DEFAULTS, **properties, "url": url}
    options["dbtable"] = f"({text}) AS t" if is_query else text
    if partition:
        column, lower, upper, tasks = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(tasks),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: dict[str, str],
    partition: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """A database table or query as a frame."""
    options = jdbc_options(url, table_or_query, properties, partition)
    return spark.read.format("jdbc").options(**options).load()


def day_query(table: str, ts: str, day: str, end: str) -> str:
    """Rows of a day range, as a query that can use an index on ``ts``."""
    return f"SELECT * FROM {table} WHERE {ts} >= TIMESTAMP '{day}' AND {ts} < TIMESTAMP '{end}'"


def day_children_query(child: str, orders: str, ts: str, day: str, end: str, keep_empty: bool = False) -> str:
    """Child rows of the orders of a day range, joined in the database."""
    join = "LEFT JOIN" if keep_empty else "JOIN"
    return (
        f"SELECT c.* FROM {orders} o {join} {child} c ON o.order_id = c.order_id "
        f"WHERE o.{ts} >= TIMESTAMP '{day}' AND o.{ts} < TIMESTAMP '{end}'"
    )
