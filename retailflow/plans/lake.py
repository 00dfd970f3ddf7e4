"""Day loads: extract, check and merge into the lakehouse, load the warehouse.

Tables live under one root as Parquet, partitioned by time: orders and reviews by their
own time, items and payments by the purchase day of their order (the load cursor).
A load rewrites the partitions of its days and those that hold its keys already, so a
row whose day changes moves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from retailflow.functions.time import next_day
from retailflow.model import DATE_PARTS, FACTS, FIRST_DAY, REVIEW_IS_VALID, WAREHOUSE_KEYS, TableSpec
from retailflow.operators.joins import PURCHASED, left_from_few
from retailflow.operators.slices import (
    add_cursor_parts,
    add_date_parts,
    days_slice,
    partition_range,
    partition_slice,
    split_valid,
)
from retailflow.quality.checks import CHECKS, check_summary, gate, run_checks
from retailflow.quality.partials import refresh_partials, stored_profile
from retailflow.quality.repository import save_metrics
from retailflow.session import broadcast_if_small
from retailflow.sinks.landing import write_landing
from retailflow.sinks.tables import merge_into_path, path_exists, refresh_table, write_table
from retailflow.sources.files import read_landing


@dataclass(frozen=True)
class Lake:
    """A root folder with ``lakehouse``, ``warehouse``, ``landing`` and ``metrics``.

    Tables are partitioned by day; where days are small, ``partition_by`` may be
    year and month only, and the day is then a plain column. With ``index_buckets`` each
    table has a key index of so many buckets: for tables whose key columns are long
    compared with a day, since an index costs a few small jobs a load.
    """

    root: str
    partition_by: tuple[str, ...] = tuple(DATE_PARTS)
    first_day: str = FIRST_DAY
    index_buckets: int | None = None

    def table(self, name: str) -> str:
        return f"{self.root}/lakehouse/{name}"

    def warehouse(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def cursors(self) -> str:
        return f"{self.root}/cursors"


def extract_days(
    tables: dict[str, DataFrame], name: str, start: str, end: str, keep_empty: bool = False
) -> DataFrame:
    """Source rows of the days ``[start, end)``, with year, month and day.

    Orders and reviews are cut by their own time; items and payments belong to
    the days of their orders.
    """
    spec = FACTS[name]
    if spec.slice_time:
        return add_date_parts(days_slice(tables[name], spec.slice_time, start, end), spec.slice_time)
    return _of_orders(tables[name], days_slice(tables["orders"], PURCHASED, start, end), keep_empty)


def extract_undated(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """Source rows that no day holds, because their own or their order's time is null."""
    spec = FACTS[name]
    if spec.slice_time:
        return add_date_parts(tables[name].filter(F.col(spec.slice_time).isNull()), spec.slice_time)
    return _of_orders(tables[name], tables["orders"].filter(F.col(PURCHASED).isNull()))


def _of_orders(child: DataFrame, orders: DataFrame, keep_empty: bool = False) -> DataFrame:
    picked = broadcast_if_small(add_date_parts(orders, PURCHASED).select("order_id", *DATE_PARTS))
    if not keep_empty:
        return child.join(picked, "order_id").select(*child.columns, *DATE_PARTS)
    joined = left_from_few(picked, child)
    return joined.select(*[F.col(f"__{c}").alias(c) for c in child.columns], *DATE_PARTS)


def extract_day(
    tables: dict[str, DataFrame], name: str, day: str, root: str, lookback_days: int = 0
) -> str:
    """Write the landing file of one table and day; returns its path.

    With lookback, late changes of earlier days come along. That needs rows that
    know their own day, so items and payments are re-read with ``backfill``.
    """
    if lookback_days and not FACTS[name].slice_time:
        raise ValueError(f"{name} rows carry no day of their own; use backfill")
    rows = extract_days(tables, name, next_day(day, -lookback_days), next_day(day))
    return write_landing(rows.drop(*DATE_PARTS), root, name, day)


def load_rows(
    rows: DataFrame,
    lake: Lake,
    spec: TableSpec,
    day: str,
    test: bool = True,
    ingest: bool = True,
    profiled: bool = False,
    rejected: Callable[[DataFrame], None] | None = None,
) -> int:
    """Check rows, merge them into the lakehouse table, profile the table.

    The profile is merged from one of each partition; only rewritten partitions are read for it.
    Rows must carry year, month and day. An empty batch is skipped. Returns the
    number of rows merged.
    """
    if spec.name == "order_reviews":
        rows, bad = split_valid(rows, REVIEW_IS_VALID)
        if rejected:
            rejected(bad)
    # Checks, the emptiness test and the merge read the batch; it is held once,
    # on executor disks, and recomputed if an executor is lost.
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        if test:
            result = run_checks(rows.drop(*DATE_PARTS), CHECKS[spec.name])
            save_metrics(result, lake.metrics, spec.name, "checks", day)
            gate(result, rows)
        merged, rewritten = 0, []
        if ingest and not rows.isEmpty():
            merged = merge_into_path(
                rows,
                lake.table(spec.name),
                spec.keys,
                spec.update,
                list(lake.partition_by),
                index_buckets=lake.index_buckets,
                rewritten=rewritten,
            )
    finally:
        rows.unpersist()
    if profiled:
        spark = rows.sparkSession
        store = f"{lake.root}/profiles/{spec.name}"
        refresh_partials(spark, lake.table(spec.name), store, list(lake.partition_by), rewritten)
        save_metrics(stored_profile(spark, store), lake.metrics, spec.name, "profiles", day)
    return merged


def lakehouse_day(
    spark: SparkSession,
    lake: Lake,
    name: str,
    day: str,
    test: bool = True,
    ingest: bool = True,
    profiled: bool = False,
) -> int:
    """Load the landing file of one table and day into the lakehouse."""
    spec = FACTS[name]
    rows = read_landing(spark, lake.root, name, day)
    if spec.partition_time:
        rows = add_date_parts(rows, spec.partition_time)
    else:
        rows = add_cursor_parts(rows, day)
    return load_rows(rows, lake, spec, day, test, ingest, profiled)


def post_check(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Pass/fail row of a table after its load; the load stays as it is."""
    return check_summary(run_checks(spark.read.parquet(lake.table(name)), CHECKS[name]))


def warehouse_day(
    spark: SparkSession,
    lake: Lake,
    name: str,
    day: str,
    end: str | None = None,
    merge_rows: Callable[[DataFrame, str, list[str]], None] | None = None,
    insert_only_items: bool = False,
    through_orders: bool = False,
) -> bool:
    """Merge one day of a lakehouse table, or the days ``[day, end)``, into the warehouse.

    ``merge_rows(rows, table, keys)`` may send the rows to a database (see
    ``staged_merge``); by default they go to Parquet tables under the root. A
    lakehouse table that does not exist yet, or a day without rows, is skipped.
    ``through_orders`` takes the child rows of the orders in the day's partition of the
    orders table, wherever the children lie.
    """
    needed = [name, "orders"] if through_orders else [name]
    if not all(path_exists(spark, lake.table(n)) for n in needed):
        return False
    table = spark.read.parquet(lake.table(name))

    def cut(df: DataFrame) -> DataFrame:
        return partition_range(df, day, end) if end else partition_slice(df, day)

    if through_orders:
        picked = broadcast_if_small(cut(spark.read.parquet(lake.table("orders"))).select("order_id"))
        joined = left_from_few(picked, table)
        rows = joined.select(*[F.col(f"__{c}").alias(c) for c in table.columns]).filter("order_id IS NOT NULL")
    else:
        rows = cut(table)
    if rows.isEmpty():
        return False
    keys = WAREHOUSE_KEYS[name]
    if merge_rows:
        merge_rows(rows.drop(*DATE_PARTS), name, keys)
    else:
        update = None if insert_only_items and name == "order_items" else "*"
        merge_into_path(
            rows, lake.warehouse(name), keys, update, list(lake.partition_by), index_buckets=lake.index_buckets
        )
    return True


def refresh_dimension(source: DataFrame, lake: Lake, name: str, landing: bool = True) -> bool:
    """Full refresh of one dimension: landing file, lakehouse and warehouse table."""
    if landing:
        write_landing(source, lake.root, name)
    if not refresh_table(source, lake.table(name)):
        return False
    spark = source.sparkSession
    return refresh_table(spark.read.parquet(lake.table(name)), lake.warehouse(name))


def read_cursor(spark: SparkSession, lake: Lake, name: str) -> str:
    """The next day to load; the lake's first day when nothing was loaded."""
    if not path_exists(spark, f"{lake.cursors}/{name}"):
        return lake.first_day
    row = spark.read.parquet(f"{lake.cursors}/{name}").agg(F.max("next_day").alias("d")).first()
    return row["d"]


def run_next_day(spark: SparkSession, lake: Lake, name: str, run: Callable[[str], object]) -> str:
    """Run the day at the cursor and move the cursor on.

    A run that raises leaves the cursor, so the day is run again. Loads are
    idempotent, so a day may also be run twice.
    """
    day = read_cursor(spark, lake, name)
    run(day)
    following = spark.createDataFrame([(next_day(day),)], "next_day string")
    following.write.mode("append").parquet(f"{lake.cursors}/{name}")
    return day


def backfill(
    tables: dict[str, DataFrame], lake: Lake, name: str, start: str, end: str, test: bool = True
) -> int:
    """Load the days ``[start, end)`` as one batch with one check and one merge."""
    rows = extract_days(tables, name, start, end)
    return load_rows(rows, lake, FACTS[name], f"{start}..{end}", test=test)


def load_undated(tables: dict[str, DataFrame], lake: Lake, name: str, test: bool = True) -> int:
    """Load the rows without a day into the null partition; a time that comes later moves them."""
    return load_rows(extract_undated(tables, name), lake, FACTS[name], "undated", test=test)


def full_load(tables: dict[str, DataFrame], path_of: Callable[[str], str]) -> None:
    """Write every table whole."""
    for name, df in tables.items():
        write_table(df, path_of(name), mode="overwrite")

