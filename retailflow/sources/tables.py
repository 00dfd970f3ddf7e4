"""Catalog tables: scans, descriptions, federated views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The table, or an empty frame with ``schema`` when there is none."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def register_federated(
    spark: SparkSession, readers: dict[str, Callable[[SparkSession], DataFrame]]
) -> None:
    """Register one temp view per reader, so one query can join several sources."""
    for view, reader in readers.items():
        reader(spark).createOrReplaceTempView(view)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns and types of a table."""
    rows = [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def list_tables(spark: SparkSession, database: str | None = None, like: str = "%") -> list[str]:
    """Names of the tables that match a LIKE pattern."""
    pattern = like.replace("%", "*")
    return sorted(t.name for t in spark.catalog.listTables(database, pattern))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
