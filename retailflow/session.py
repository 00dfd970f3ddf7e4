"""Session helpers: shared scratch space and size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 250_000
BROADCAST_BYTES = 32 * 1024 * 1024
#: What goes to a Python worker at once, in rows and in bytes.
BATCH_ROWS = 1000
BATCH_BYTES = 4 * 1024 * 1024

_local_roots: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}
_names: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session without it is an error, because executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="retailflow-")
        spark.sparkContext.setCheckpointDir(_local_roots[app] + "/checkpoints")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root; see ``clear_scratch``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_name(spark: SparkSession, stem: str) -> str:
    """An unused name for a table or view; see ``clear_scratch``."""
    name = f"{stem}_{uuid.uuid4().hex[:12]}"
    _names.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def clear_scratch(spark: SparkSession) -> int:
    """Drop what this application put under scratch names and paths; returns how much.

    For the end of an application: frames that read from scratch fail afterwards.
    """
    app = spark.sparkContext.applicationId
    names, paths = _names.pop(app, []), _scratch.pop(app, [])
    for name in names:
        spark.catalog.dropTempView(name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        place = hadoop.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(names) + len(paths)


def row_bytes(df: DataFrame):
    """Approximate width of a row in bytes, as a column expression."""
    width = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            width = width + F.coalesce(F.octet_length(F.to_json(f"`{f.name}`")), F.lit(0))
    return width


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` against the bounds; one row of sums per task moves."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast hint only when the measured size is within the bounds.

    Beyond them the frame is returned unhinted and the join shuffles, where
    adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound what a Python worker holds at once by rows and bytes; smaller bounds of the session stay."""
    for name, bound in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        held = spark.conf.get(key)
        if not held.isdigit() or not 0 < int(held) <= bound:
            spark.conf.set(key, str(bound))


def widen(scan: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it yields fewer tasks than there are cores.

    For work that is heavy per row (text patterns, model calls) on few or
    unsplittable files. A scan of a large table has more tasks than cores and is
    returned as it is, without a shuffle. ``scan`` must be a plain read with
    filters and projections.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
