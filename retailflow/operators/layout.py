"""Physical layout: bucketed tables for co-located joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def bucketed(df: DataFrame, name: str, key: str, n: int, path: str | None = None) -> DataFrame:
    """Write a table hashed and sorted on ``key`` into ``n`` buckets.

    Two tables bucketed alike join on the key without a shuffle. All rows of a key lie
    in one bucket and are joined by one task, so the key must not be a hot one.
    """
    writer = df.write.format("parquet").bucketBy(n, key).sortBy(key).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
