"""Row counts and delays of running streams, one line for each micro-batch.

A stream is watched by metrics that Spark observes while its rows pass, so nothing is read
again. A listener writes the report of each finished batch to a file of its own; progress
reports that a query itself holds are only the last hundred.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from retailflow.sinks.folders import Folders

METRIC = "delivered"
REPORT = "stream string, batch bigint, n_rows bigint, last_time timestamp_ntz, started string, millis bigint"


def watched(stream: DataFrame, time: str | None = None) -> DataFrame:
    """The stream with its rows counted, and the latest of the column ``time`` taken, as they pass."""
    latest = F.date_format(F.max(F.col(time).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss.SSSSSS") if time else F.lit(None).cast("string")
    return stream.observe(METRIC, F.count(F.lit(1)).alias("n_rows"), latest.alias("last_time"))


class BatchLog(StreamingQueryListener):
    """Writes what watched and named queries report below ``root``.

    ``root/<query name>/<batch>.json`` holds one line. A batch that is run again after a restart replaces
    its file, so sums stay right. Queries that are not named or not watched are passed over.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.failures: list[Exception] = []
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        seen = (report.observedMetrics or {}).get(METRIC)
        if not report.name or seen is None:
            return
        line = {
            "stream": report.name,
            "batch": report.batchId,
            "n_rows": seen["n_rows"],
            "last_time": seen["last_time"],
            "started": report.timestamp,
            "millis": report.batchDuration,
        }
        try:
            self._write(f"{self.root}/{report.name}/{report.batchId}.json", json.dumps(line))
        except Exception as e:  # a report must not stop the stream; ``drain`` raises it
            self.failures.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def drain(self, query, seconds: float = 60) -> None:
        """Wait until all reports of a finished query are written."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError("the reports of the query have not arrived")
        if self.failures:
            raise self.failures[0]

    def _end_of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def _write(self, path: str, line: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        try:
            out.write(bytearray(line.encode() + b"\n"))
        finally:
            out.close()


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """One row for each batch: query, batch, rows, latest time in it, start and duration; no rows before the first report."""
    names = Folders(spark, root).names(root)
    if not names:
        return spark.createDataFrame([], REPORT)
    return spark.read.schema(REPORT).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(
        [f"{root}/{n}" for n in names]
    )


def stream_totals(reports: DataFrame) -> DataFrame:
    """Rows, latest time and longest batch of each stream, and whether a batch is missing."""
    n = F.count(F.lit(1))
    return reports.groupBy("stream").agg(
        F.sum("n_rows").alias("n_rows"),
        F.max("last_time").alias("last_time"),
        (n == F.max("batch") + 1).alias("complete"),
    )
