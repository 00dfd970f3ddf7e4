"""Metric history: result rows appended as JSON, partitioned by table and task."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASKS = ("checks", "metrics", "profiles")


def save_metrics(
    df: DataFrame, root: str, table: str, task: str, day: str = "", tag: str = "", at_ms: int | None = None
) -> int:
    """Append result rows under (table, task) with time in ms, day and tag."""
    if task not in TASKS:
        raise ValueError(f"task must be one of {TASKS}")
    at_ms = int(time.time() * 1000) if at_ms is None else at_ms
    stamped = df.withColumns(
        {
            "result_time_ms": F.lit(at_ms),
            "result_day": F.lit(day),
            "result_tag": F.lit(tag or table),
            "table": F.lit(table),
            "task": F.lit(task),
        }
    )
    stamped.write.mode("append").partitionBy("table", "task").json(root)
    return at_ms


def load_metrics(spark: SparkSession, root: str, table: str, task: str, schema: str) -> DataFrame:
    """The history of one table and task; ``schema`` is that of the result rows."""
    full = f"{schema}, result_time_ms bigint, result_day string, result_tag string, table string, task string"
    history = spark.read.schema(full).json(root)
    return history.filter((F.col("table") == table) & (F.col("task") == task))
