"""Profiles that are kept by partition and merged, so that a load pays for what it rewrote.

For every partition of a table and every column a store holds one row: counts, extremes,
sum, squared deviations and two sketches as binary. All of them merge: a table's profile
is the fold of its rows, and a partition that a load rewrites replaces its own rows.
The store is a Parquet table with the partitions of the table that it describes.

Merged figures are exact but for two: distinct counts come from HLL sketches (standard error
1.04 / sqrt(2 ** DISTINCT_BITS)), percentiles from KLL sketches of ``SKETCH_SIZE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.quality.checks import BOOLEAN, FRACTIONAL, INTEGRAL, STRING, type_class
from retailflow.quality.profile import PERCENTILES, SKETCH_SIZE, number_of
from retailflow.sinks.folders import Folders, fresh, replace_partitions
from retailflow.sinks.tables import path_exists, read_folders, write_table

DISTINCT_BITS = 12
#: Three standard errors of a distinct count.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _hashable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = F.col(_quoted(name))
    return value if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else value.cast("string")


def partial_profiles(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """One row per partition and column of ``df``, in one pass with partial aggregates."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    rows = []
    for i, name in enumerate(df.columns):
        kind = df.schema[name].dataType
        value = F.col(_quoted(name))
        number = number_of(df, name)
        classes = type_class(df, name) if isinstance(kind, T.StringType) else None
        aggs += [F.count(value).alias(f"__n{i}"), F.hll_sketch_agg(_hashable(df, name), F.lit(DISTINCT_BITS)).alias(f"__d{i}")]
        fixed = INTEGRAL if isinstance(kind, T.IntegralType) else FRACTIONAL if isinstance(kind, T.NumericType) else None
        fixed = BOOLEAN if isinstance(kind, T.BooleanType) else fixed
        for label, short in ((INTEGRAL, "ti"), (FRACTIONAL, "tf"), (BOOLEAN, "tb")):
            if classes is not None:
                aggs.append(F.count_if(classes == label).alias(f"__{short}{i}"))
            else:
                aggs.append((F.count(value) if fixed == label else F.count(F.lit(None))).alias(f"__{short}{i}"))
        measured = F.lit(None).cast("double") if number is None else number
        aggs += [
            F.count(measured).alias(f"__m{i}"),
            F.min(measured).alias(f"__lo{i}"),
            F.max(measured).alias(f"__hi{i}"),
            F.sum(measured).alias(f"__su{i}"),
            (F.var_pop(measured) * F.count(measured)).alias(f"__sq{i}"),
        ]
        sketch = F.lit(None).cast("binary")
        if number is not None:
            aggs.append(F.kll_sketch_agg_double(number, F.lit(SKETCH_SIZE)).alias(f"__pc{i}"))
            sketch = F.col(f"__pc{i}")
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.lit(number is not None).alias("is_number"),
                F.col("__rows").alias("n_rows"),
                F.col(f"__n{i}").alias("n_non_null"),
                *[F.col(f"__{a}{i}").alias(b) for a, b in _MEASURES],
                F.col(f"__d{i}").alias("distinct"),
                sketch.alias("quantiles"),
            )
        )
    # Partition columns may bear any name, those of the rows too, so they are set apart.
    parts = [F.col(_quoted(c)).alias(f"__p{n}") for n, c in enumerate(partition_by)]
    listed = df.groupBy(*parts).agg(*aggs).select(*[f"__p{n}" for n in range(len(parts))], F.explode(F.array(*rows)).alias("profile"))
    return listed.withColumnsRenamed({f"__p{n}": c for n, c in enumerate(partition_by)})


_MEASURES = [
    ("ti", "integral"),
    ("tf", "fractional"),
    ("tb", "boolean"),
    ("m", "n_numbers"),
    ("lo", "min"),
    ("hi", "max"),
    ("su", "sum"),
    ("sq", "squares"),
]


def merge_partials(partials: DataFrame) -> DataFrame:
    """The profile of the whole, one row per column, as ``profile`` gives it."""
    p = partials.select("profile.*")
    column = Window.partitionBy("column")
    mean = F.try_divide(F.sum("sum").over(column), F.sum("n_numbers").over(column))
    # Squared deviations from the mean of all, from those from the mean of each partition.
    apart = F.col("n_numbers") * F.pow(F.col("sum") / F.nullif(F.col("n_numbers"), F.lit(0)) - mean, 2)
    p = p.withColumn("squares", F.col("squares") + apart)
    ranks = F.expr(f"array({', '.join(f'{q}D' for q in PERCENTILES)})")
    n = F.col("n_non_null")
    folded = p.groupBy("column").agg(
        F.min("position").alias("position"),
        F.bool_or("is_number").alias("is_number"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_non_null", "integral", "fractional", "boolean", "n_numbers", "sum", "squares")],
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    all_numbers = F.col("is_number") & (F.col("integral") + F.col("fractional") == n)
    inferred = (
        F.when(n == 0, F.lit("Unknown"))
        .when(F.col("integral") == n, F.lit(INTEGRAL))
        .when(F.col("integral") + F.col("fractional") == n, F.lit(FRACTIONAL))
        .when(F.col("boolean") == n, F.lit(BOOLEAN))
        .otherwise(F.lit(STRING))
    )
    measures = {
        "min": F.col("min"),
        "max": F.col("max"),
        "mean": F.try_divide(F.col("sum"), n),
        "sum": F.col("sum"),
        "std_dev": F.sqrt(F.try_divide(F.col("squares"), n)),
    }
    return folded.orderBy("position").select(
        "column",
        inferred.alias("data_type"),
        F.try_divide(n, F.col("n_rows")).alias("completeness"),
        "approx_distinct",
        "n_rows",
        n.alias("n_non_null"),
        *[F.when(all_numbers, v).alias(m) for m, v in measures.items()],
        F.when(all_numbers & (n > 0), F.kll_sketch_get_quantile_double("quantiles", ranks)).alias("percentiles"),
    )


def refresh_partials(
    spark: SparkSession, table: str, store: str, partition_by: list[str], folders: list[str] | None = None
) -> None:
    """Bring the store of the table at ``table`` up to date for some of its partition folders.

    Without ``folders``, or without a store, the whole table is profiled. A folder that
    the table no longer has loses its rows.
    """
    if folders is None or not path_exists(spark, store):
        staged = fresh(store, "staged")
        old = Folders(spark, store).leaves(store) if Folders(spark, store).exists(store) else []
        rows = spark.read.parquet(table)
    else:
        staged, there = fresh(store, "staged"), Folders(spark, table)
        old = [f for f in folders if Folders(spark, store).exists(f"{store}/{f}")]
        rows = read_folders(spark.read.parquet(table), table, [f for f in folders if there.exists(f"{table}/{f}")], partition_by)
    try:
        write_table(partial_profiles(rows, partition_by), staged, partition_by)
        replace_partitions(spark, staged, store, old)
    finally:
        Folders(spark, store).delete(staged)


def stored_profile(spark: SparkSession, store: str) -> DataFrame:
    """The merged profile of a store."""
    return merge_partials(spark.read.parquet(store))
