"""Helpers that the operators share: table reads, materialising, held-out folds, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.session import scratch_path

BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, with whole columns."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once: whole texts travel in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back.

    Cuts the lineage; the files outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; ids that are null fall in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus)), F.lit(0)).cast("int")


def texts_of(docs: DataFrame, chosen: list[tuple], kind: str, text: str = "text") -> list[tuple]:
    """``(text, y)`` of the chosen ``(id, y)``, in the order of the id's hash.

    One scan; a repeated id gives its smallest text, chosen with partial aggregates, so that
    one text for each id is all that reaches the driver.
    """
    if not chosen:
        return []
    spark = docs.sparkSession
    ids = spark.createDataFrame(chosen, f"i long, y {kind}")
    texts = docs.select(F.col("doc_id").alias("i"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    found = texts.join(F.broadcast(ids), "i").groupBy("i", "y").agg(F.min("t").alias("t"))
    found = found.select(F.xxhash64("i").alias("h"), "i", "t", "y").collect()
    first: dict = {}
    for r in sorted(found, key=lambda r: (r["h"], r["i"], str(r["y"]), r["t"])):
        first.setdefault((r["i"], r["y"]), (r["t"], r["y"]))
    return list(first.values())


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: tuple[int, int]
) -> list[tuple[str, int]]:
    """At most ``per_class[y]`` training texts ``(text, y)`` of each class, by the hash of their id.

    The ids are chosen from the narrow label table, so the driver holds at most
    ``sum(per_class)`` texts, the same on every run. Labels that are null and
    documents without label, id or text are not sampled.
    """
    wanted = labels.select(F.col("doc_id").alias("i"), F.col(label).cast("int").alias("y")).filter(
        F.col("i").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("i"), modulus) != held_out)
    )
    picked = []
    for y in (0, 1):
        rows = wanted.filter(F.col("y") == y).select("i").distinct().orderBy(F.xxhash64("i"), "i")
        picked += [(r["i"], y) for r in rows.limit(per_class[y]).collect()]
    return texts_of(docs, picked, "int")
