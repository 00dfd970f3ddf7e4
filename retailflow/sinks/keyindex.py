"""A key index beside a partitioned table: which partitions hold a key.

A merge asks it for the keys of its batch and so needs not scan the key columns of the whole
table. The index is a log in ``<table>/_keys/of=<buckets>``, a folder that readers of the table
ignore: each load appends the (key, partition) pairs that came and those that went, in one
folder per bucket of the key's hash, so that a look-up reads the buckets of its keys only. The
last entry of a pair counts.

Pairs that come are appended before a table swap and pairs that go after it, so a load
that stops half-way leaves pairs too many, never too few: one partition more is read, and
no row is missed. Keys with a null match nothing in a merge and are not indexed.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.session import broadcast_if_small
from retailflow.sinks.folders import Folders, fresh, replace_folder

#: Loads after which the log is folded.
FOLD_LOADS = 32


class KeyIndex:
    """The index of the table at ``path`` on ``keys``; ``open_index`` finds an existing one.

    ``schema`` has the types of keys and partition columns.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], partition_by: list[str], buckets: int, schema: T.StructType
    ) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets
        self.columns = list(dict.fromkeys([*keys, *partition_by]))
        further = [T.StructField("alive", T.BooleanType()), T.StructField("load", T.IntegerType()), T.StructField("bucket", T.IntegerType())]
        self.schema = T.StructType([schema[c] for c in self.columns] + further)
        self.root = f"{path}/_keys/of={buckets}"
        self.folders = Folders(spark, path)

    def bucket(self) -> Column:
        """Bucket of a key; hashed as text, so that an int and a long of one value agree."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def pairs(self, df: DataFrame) -> DataFrame:
        """The distinct (key, partition) pairs of a table or of a part of it."""
        return df.select(*self.columns).dropna(subset=self.keys).distinct()

    def wanted(self, batch: DataFrame) -> DataFrame:
        """The distinct keys of a batch, renamed, with their buckets."""
        named = batch.select(*[F.col(k).alias(f"__{k}") for k in self.keys], self.bucket().alias("__bucket"))
        return named.dropna(subset=[f"__{k}" for k in self.keys]).distinct()

    def of_keys(self, pairs: DataFrame, wanted: DataFrame) -> DataFrame:
        """The pairs whose key is wanted."""
        same = reduce(Column.__and__, [F.col(k) == F.col(f"__{k}") for k in self.keys])
        return pairs.join(wanted, same, "left_semi")

    def build(self, table: DataFrame) -> None:
        """Index a table from its rows, in place of any older index."""
        staged = fresh(self.path, "keys-staged")
        try:
            self._write(self.pairs(table).withColumn("alive", F.lit(True)), f"{staged}/of={self.buckets}/load=0")
            replace_folder(self.spark, staged, f"{self.path}/_keys")
        finally:
            self.folders.delete(staged)

    def entries(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The pairs that count now, of all buckets or of the given ones."""
        log = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(self.root)
        if buckets is not None:
            log = log.filter(F.col("bucket").isin(*buckets))
        last = log.groupBy(*self.columns).agg(F.max_by("alive", "load").alias("alive"))
        return last.filter("alive").drop("alive")

    def look_up(self, wanted: DataFrame) -> DataFrame:
        """The pairs of the wanted keys; reads their buckets only."""
        buckets = [r["__bucket"] for r in wanted.select("__bucket").distinct().collect()]
        return self.of_keys(self.entries(buckets), broadcast_if_small(wanted))

    def append(self, pairs: DataFrame, alive: bool) -> None:
        """Append pairs that came or went. The load counts once its folder has its name."""
        staged = fresh(self.path, "keys-load")
        try:
            self._write(pairs.withColumn("alive", F.lit(alive)), staged)
            self.folders.move(staged, f"{self.root}/load={self._last_load() + 1}")
        finally:
            self.folders.delete(staged)

    def fold(self, loads: int = FOLD_LOADS) -> bool:
        """Replace a log of at least ``loads`` loads by the pairs that count."""
        if len(self.folders.names(self.root)) < loads:
            return False
        self.build(self.entries())
        return True

    def _last_load(self) -> int:
        return max((int(n.split("=")[1]) for n in self.folders.names(self.root) if n.startswith("load=")), default=-1)

    def _write(self, pairs: DataFrame, folder: str) -> None:
        dealt = pairs.withColumn("bucket", self.bucket()).hint("rebalance", F.col("bucket"))
        dealt.write.partitionBy("bucket").parquet(folder)


def open_index(
    spark: SparkSession, path: str, keys: list[str], partition_by: list[str], schema: T.StructType | None = None
) -> KeyIndex | None:
    """The index of a table, or None; without ``schema`` the table tells the types."""
    found = Folders(spark, path).names(f"{path}/_keys")
    of = [int(n.split("=")[1]) for n in found if n.startswith("of=")]
    if not of:
        return None
    return KeyIndex(spark, path, keys, partition_by, of[0], schema or spark.read.parquet(path).schema)
