"""Change-stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }


def read_change_stream(
    spark: SparkSession,
    source: str,
    fmt: str,
    schema: str | None = None,
    starting: str = "earliest",
    topic: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """A change stream: what is there first, then what arrives.

    ``fmt`` is a file format (``json``, ``parquet``, ``csv``), with ``source`` a
    folder, or ``kafka``, with ``source`` the bootstrap servers (needs the
    spark-sql-kafka jar).
    """
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(source, topic, starting)).load()
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(source)
