"""Table sinks: create, overwrite, clear, merge into, replicate."""

from __future__ import annotations

import fnmatch
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.operators.merge import merge, merge_sql
from retailflow.session import broadcast_if_small
from retailflow.sinks.folders import Folders, fresh, replace_folder, replace_partitions
from retailflow.sinks.keyindex import KeyIndex, open_index

# Conditions under which a path holds no table: it is missing, or holds no file.
NO_TABLE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet table; other problems are raised."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as error:
        if error.getCondition() in NO_TABLE:
            return False
        raise


def spread(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Shuffle rows towards their table partition before a write.

    A rebalance at every size: adaptive execution splits a partition that exceeds
    its advisory size and joins small ones, so tasks and files follow the bytes.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def create_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    path: str | None = None,
    if_absent: bool = True,
    replace: bool = False,
    fmt: str = "parquet",
) -> bool:
    """Create a catalog table from a frame; True when it was written."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and not replace:
        if if_absent:
            return False
        raise ValueError(f"table {name} exists")
    partition_by = partition_by or []
    writer = spread(df, partition_by).write.format(fmt).option("compression", "snappy")
    writer = writer.mode("overwrite" if replace else "error")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return True


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "error") -> None:
    """Write a Parquet table at a path."""
    partition_by = partition_by or []
    writer = spread(df, partition_by).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def create_table_ddl(
    name: str,
    columns: dict[str, str],
    not_null: list[str] | None = None,
    partition_by: list[str] | None = None,
    properties: dict[str, str] | None = None,
    using: str = "parquet",
) -> str:
    """CREATE TABLE IF NOT EXISTS text."""
    required = set(not_null or [])
    body = ",\n  ".join(f"{c} {t}{' NOT NULL' if c in required else ''}" for c, t in columns.items())
    text = f"CREATE TABLE IF NOT EXISTS {name} (\n  {body}\n) USING {using}"
    if partition_by:
        text += f"\nPARTITIONED BY ({', '.join(partition_by)})"
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        text += f"\nTBLPROPERTIES ({pairs})"
    return text


def refresh_table(df: DataFrame, path: str) -> bool:
    """Replace a dimension by the full source; an empty source changes no table that is there.

    The new table is written beside the old one and takes its place when it is whole.
    """
    spark = df.sparkSession
    if df.isEmpty() and path_exists(spark, path):
        return False
    staged = f"{path}_staged-{uuid.uuid4().hex}"
    try:
        write_table(df, staged)
        replace_folder(spark, staged, path)
    finally:
        Folders(spark, path).delete(staged)
    return True


def clear_target(spark: SparkSession, name: str, how: str) -> None:
    """Empty (``delete``) or remove (``drop``) a table before a load.

    Emptying overwrites with no rows, which external tables allow too.
    """
    if how == "drop":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    elif how == "delete":
        if spark.catalog.tableExists(name):
            nothing = spark.createDataFrame([], spark.table(name).schema).write.mode("overwrite")
            nothing.option("partitionOverwriteMode", "static").insertInto(name)
    else:
        raise ValueError("how must be 'delete' or 'drop'")


def merge_into_path(
    source: DataFrame,
    path: str,
    keys: list[str],
    update: str | list[str] | None,
    partition_by: list[str],
    keys_stay: bool = False,
    index_buckets: int | None = None,
    rewritten: list[str] | None = None,
) -> int:
    """Merge into a partitioned Parquet table, rewriting only touched partitions.

    Returns the number of source rows. Touched are the partitions that the source
    names and those that hold its keys now: a row whose partition columns change moves, and
    its old partition is rewritten or goes. ``keys_stay`` is the caller's promise that no key
    ever moves; then only the partitions that the source names are read. Partition
    columns may be null. The target is read by its touched folders alone.

    Where the keys are is found from the key columns of the table or, with ``index_buckets``,
    from a key index of so many buckets beside it (see ``KeyIndex``), which is built when
    missing. An index that exists is used and kept up to date by every merge. The partition
    folders that came, changed or went are added to the list ``rewritten``.

    The new partitions are staged as a whole before any old file is replaced, so a
    failed merge leaves the table as it was. The swap itself is one rename per
    partition; table formats with MERGE (see ``merge_into_table``) make it one step.

    ``source`` is read more than once and must give the same rows each time.
    """
    spark = source.sparkSession
    rows = source.count()
    index = open_index(spark, path, keys, partition_by, source.schema)
    if index is None and not path_exists(spark, path):
        staged = f"{path}_staged-{uuid.uuid4().hex}"
        if rows:
            write_table(source, staged, partition_by)
        else:
            # One file without rows keeps the columns; partitions take its place later.
            write_table(spark.createDataFrame([], source.schema), staged)
        replace_folder(spark, staged, path)
        if rewritten is not None:
            rewritten += Folders(spark, path).leaves(path)
        if index_buckets and rows:
            KeyIndex(spark, path, keys, partition_by, index_buckets, source.schema).build(source)
        return rows
    if not rows:
        return 0
    kinds = {f.name: f.dataType for f in source.schema.fields}
    if index is None and index_buckets:
        table = spark.read.parquet(path).withColumns({c: F.col(c).cast(kinds[c]) for c in partition_by})
        index = KeyIndex(spark, path, keys, partition_by, index_buckets, source.schema)
        index.build(table)
    touched = source.select(*partition_by).distinct()
    work = fresh(path, "work")
    try:
        if index:
            wanted = index.wanted(source)
            index.look_up(wanted).write.parquet(f"{work}/held")
            held = spark.read.parquet(f"{work}/held")
            touched = touched.unionByName(held.select(*partition_by)).distinct()
        elif not keys_stay:
            table = spark.read.parquet(path).withColumns({c: F.col(c).cast(kinds[c]) for c in partition_by})
            known = table.select(*dict.fromkeys([*keys, *partition_by]))
            wanted = source.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            same = reduce(Column.__and__, [F.col(k) == F.col(f"__{k}") for k in keys])
            found = known.join(broadcast_if_small(wanted), same, "left_semi").select(*partition_by)
            touched = touched.unionByName(found).distinct()
        # One row per touched partition.
        folders = _partition_folders(touched, path)
        target = read_folders(source, path, folders, partition_by)
        merged = merge(target.select(*source.columns), source, keys, update)
        write_table(merged, f"{work}/new", partition_by)
        fresh_folders = Folders(spark, path).leaves(f"{work}/new")
        if index:
            new = read_folders(source, f"{work}/new", fresh_folders, partition_by)
            index.of_keys(index.pairs(new), broadcast_if_small(wanted)).write.parquet(f"{work}/now")
            now = spark.read.parquet(f"{work}/now")
            came, gone = now.exceptAll(held), held.exceptAll(now)
            if not came.isEmpty():
                index.append(came, alive=True)
        replace_partitions(spark, f"{work}/new", path, folders)
        if rewritten is not None:
            rewritten += sorted({*folders, *fresh_folders})
        if index:
            if not gone.isEmpty():
                index.append(gone, alive=False)
            index.fold()
    finally:
        Folders(spark, path).delete(work)
    return rows


def merge_into_table(
    source: DataFrame, name: str, keys: list[str], update: str | list[str] | None = "*"
) -> None:
    """MERGE INTO a catalog table whose format supports it."""
    view = f"{name.split('.')[-1]}_source_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        source.sparkSession.sql(merge_sql(name, view, source.columns, keys, update, quote="`"))
    finally:
        source.sparkSession.catalog.dropTempView(view)


def replicate(
    source: Callable[[str], DataFrame],
    tables: list[str],
    write: Callable[[DataFrame, str], None],
    include: str = "%",
    parallel: int = 8,
    stop_on_error: bool = False,
) -> dict[str, str]:
    """Copy every table whose name matches ``include``, several at a time.

    Returns table → ``"ok"`` or the error text: a table that fails is logged and
    the others go on, unless ``stop_on_error``.
    """
    pattern = include.replace("%", "*").replace("_", "?")
    wanted = [t for t in tables if fnmatch.fnmatchcase(t, pattern)]

    def copy(table: str) -> str:
        try:
            write(source(table), table)
        except Exception as error:
            if stop_on_error:
                raise
            return f"{type(error).__name__}: {error}"
        return "ok"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(wanted, pool.map(copy, wanted)))


def _partition_folders(touched: DataFrame, path: str) -> list[str]:
    """The folders of the listed partitions that exist below ``path``, named as the writer names them."""
    spark = touched.sparkSession
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    texts = touched.select(*[F.col(c).cast("string").alias(c) for c in touched.columns]).distinct().collect()
    wanted = {"/".join(name(c, r[c]) for c in touched.columns) for r in texts}
    exists = Folders(spark, path).exists
    with ThreadPoolExecutor(max_workers=16) as pool:
        return [f for f, there in zip(sorted(wanted), pool.map(lambda f: exists(f"{path}/{f}"), sorted(wanted))) if there]


def read_folders(like: DataFrame, path: str, folders: list[str], partition_by: list[str]) -> DataFrame:
    """The rows of some partition folders, by their names; no other folder is listed."""
    spark = like.sparkSession
    if not folders:
        return spark.createDataFrame([], like.schema)
    kinds = {f.name: f.dataType for f in like.schema.fields}
    table = spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    return table.withColumns({c: F.col(c).cast(kinds[c]) for c in partition_by})
