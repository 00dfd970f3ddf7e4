"""From a snapshot of a table to the tail of its change log, without gap or repeat.

The position that the log has reached is recorded first, then the table is read. So every
change is in the snapshot, or after the recorded position, or both. The stream that follows holds
the snapshot's rows and the changes after the position, and a fold by key and position takes
those that are in both once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.sinks.folders import Folders, fresh
from retailflow.streaming.sources import read_change_stream


def record_position(spark: SparkSession, log: str, schema: str, position: str, root: str) -> int | None:
    """The largest position of the log at the first call; later calls with the same ``root`` give the same.

    ``position`` is a whole number that grows in the order of arrival, such as an offset or a log
    sequence number. An empty log has none.
    """
    place = f"{root}/position"
    folders = Folders(spark, root)
    if not folders.exists(place):
        there = bool(folders.names(log))
        reached = spark.read.schema(schema).parquet(log).agg(F.max(position)).first()[0] if there else None
        staged = fresh(root, "staged")
        spark.createDataFrame([(json.dumps(reached),)], "value string").coalesce(1).write.text(staged)
        folders.move(staged, place)
    return json.loads(spark.read.text(place).first()["value"])


def snapshot_then_tail(
    spark: SparkSession,
    snapshot: Callable[[], DataFrame],
    log: str,
    schema: str,
    position: str,
    root: str,
    files_per_batch: int = 1000,
) -> DataFrame:
    """A stream of a table's rows first and of the changes after them.

    ``snapshot`` reads the table; it is called once, after the position of the log was recorded, and
    its rows are kept below ``root``, so a restart goes on with the same snapshot and
    position. Its rows have the columns of ``schema``, with the position of their last change.
    Changes of the log up to the recorded position are left out, as the snapshot holds them;
    changes that came while the table was read may be in both, so the sink folds by key and
    position (``state.start_state``). A row without position in the log is kept.
    """
    folders = Folders(spark, root)
    reached = record_position(spark, log, schema, position, root)
    kept = f"{root}/snapshot"
    if not folders.exists(kept):
        staged = fresh(root, "staged")
        rows = snapshot()
        columns = spark.createDataFrame([], schema).schema
        rows.select(*[F.col(f.name).cast(f.dataType) for f in columns]).write.parquet(staged)
        folders.move(staged, kept)
    table = read_change_stream(spark, kept, "parquet", schema, files_per_batch=files_per_batch)
    tail = read_change_stream(spark, log, "parquet", schema, files_per_batch=files_per_batch)
    if reached is not None:
        tail = tail.filter(F.coalesce(F.col(position) > F.lit(reached), F.lit(True)))
    return table.unionByName(tail)
