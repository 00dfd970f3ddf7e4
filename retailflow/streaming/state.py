"""The current state of a change stream, kept up to date instead of folded on reading.

A streaming aggregation in update mode holds the last change of every key in a RocksDB
state store and hands each micro-batch the keys that it touched, each with its state so far: a
change that comes late or twice alters nothing. The sink merges those few rows into a
table that is partitioned by key hash, so only the partitions of the batch's keys are rewritten
and a read of the state is a plain scan.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailflow.sinks.tables import merge_into_path
from retailflow.streaming.sinks import Writer, latest_state

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def last_changes(changes: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """Streaming or not: the last change of every key by position; rows without a key are left out."""
    return latest_state(changes.dropna(subset=keys), keys, position)


def state_table_sink(path: str, keys: list[str], buckets: int = 64) -> Writer:
    """Merge the touched keys of a micro-batch into the state table at ``path``.

    Rows are unique by key. A batch that is delivered again merges to the same table; a key's
    bucket never changes, so no other partition is looked at.
    """

    def sink(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("bucket", _bucket(keys, buckets)).persist()
        try:
            merge_into_path(rows, path, keys, "*", ["bucket"], keys_stay=True)
        finally:
            rows.unpersist()

    return sink


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def start_state(
    changes: DataFrame,
    keys: list[str],
    position: list[str],
    path: str,
    checkpoint: str,
    buckets: int = 64,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the state of a change stream in the table at ``path``.

    After a stop, a start with the same checkpoint goes on where the last one ended, with
    the state that it had.
    """
    state = last_changes(changes, keys, position)
    writer = state.writeStream.outputMode("update").foreachBatch(state_table_sink(path, keys, buckets))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _setting(changes.sparkSession, PROVIDER, ROCKS_DB):
        return writer.start()


def read_state_table(spark: SparkSession, path: str) -> DataFrame:
    """The state as it stands."""
    return spark.read.parquet(path).drop("bucket")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for a while; a query keeps those that it was started with."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
