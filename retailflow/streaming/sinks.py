"""Stream sinks: append to an index, keyed upsert, previews and counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailflow.sinks.folders import Folders, fresh

Writer = Callable[[DataFrame, int], None]
#: Documents in a file; compressed files are read whole by one task.
DOCUMENTS_PER_FILE = 1_000_000


def json_writer(root: str) -> Writer:
    """Write each micro-batch as compressed JSON documents into its own folder.

    A batch that is delivered again replaces its folder, so nothing is doubled.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        writer = df.write.mode("overwrite").option("compression", "gzip")
        writer.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).json(f"{root}/batch_id={batch_id}")

    return write


def version_writer(root: str) -> Writer:
    """Write each micro-batch as Parquet into its own folder of a version log."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write


def index_sink(writer: Writer) -> Writer:
    """Append every row of a micro-batch; each change becomes a document."""

    def sink(df: DataFrame, batch_id: int) -> None:
        writer(df, batch_id)

    return sink


def upsert_sink(keys: list[str], position: list[str], writer: Writer, rejected: Writer | None = None) -> Writer:
    """Keyed upsert: the last change per key of a micro-batch goes to ``writer``.

    Rows without a key are malformed; they go to ``rejected`` if given. The
    writer must replace by key; ``version_writer`` with ``latest_state`` on read
    does, as does a MERGE into a table.
    """

    def sink(df: DataFrame, batch_id: int) -> None:
        malformed = _any_null(keys)
        if rejected:
            df = df.persist()  # read by both writers
        try:
            writer(latest_state(df.filter(~malformed), keys, position), batch_id)
            if rejected:
                rejected(df.filter(malformed), batch_id)
        finally:
            if rejected:
                df.unpersist()

    return sink


def latest_state(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The last row per key by source position; partial results before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    # The whole row comes last in the order, so equal positions have one outcome.
    lead = [*position, *[c for c in rest if c not in position]]
    last = df.groupBy(*keys).agg(F.max(F.struct(*lead)).alias("__row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def read_state(spark: SparkSession, root: str, keys: list[str], position: list[str]) -> DataFrame:
    """The current state of a version log."""
    return latest_state(spark.read.parquet(root).drop("batch_id"), keys, position)


def compact_versions(spark: SparkSession, root: str, keys: list[str], position: list[str]) -> int:
    """Fold all finished batches of a version log into one snapshot; returns how many.

    The last batch stays as it is, because it may be delivered again and then replaces
    its own folder. A snapshot is a further folder with a negative number. It is put in
    place before the folders that it replaces go, and a version that is found twice
    changes nothing, so a compaction may stop at any point and be run again.
    """
    folders = Folders(spark, root)
    numbers = sorted(int(n.removeprefix("batch_id=")) for n in folders.leaves(root))
    done = numbers[:-1]
    if len(done) < 2 or numbers[-1] < 0:
        return 0
    folded = spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={n}" for n in done]).drop("batch_id")
    staged = fresh(root, "staged")
    try:
        latest_state(folded, keys, position).write.parquet(staged)
        folders.move(staged, f"{root}/batch_id={min(done[0], 0) - 1}")
    finally:
        folders.delete(staged)
    for n in done:
        folders.delete(f"{root}/batch_id={n}")
    spark.catalog.refreshByPath(root)
    return len(done)


def start_sink(df: DataFrame, sink: Writer, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start a query that hands each micro-batch to a sink."""
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Start an append query into files, each row exactly once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def start_console(df: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start a query that prints its rows."""
    writer = df.writeStream.format("console").option("truncate", False)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_all(
    streams: dict[str, tuple[DataFrame, Writer]], checkpoint_root: str, available_now: bool = True
) -> dict[str, StreamingQuery]:
    """Start several sinks in one application, each with its own checkpoint."""
    return {
        name: start_sink(df, sink, f"{checkpoint_root}/{name}", available_now)
        for name, (df, sink) in streams.items()
    }


def stream_preview(df: DataFrame, n: int, name: str) -> DataFrame:
    """The first ``n`` rows that a stream delivers now."""
    query = df.limit(n).writeStream.format("memory").queryName(name)
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)


def input_rows(query: StreamingQuery) -> int:
    """Rows that a query has read in the progress reports it still holds."""
    return sum(p.numInputRows for p in query.recentProgress)


def _any_null(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])
