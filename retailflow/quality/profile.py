"""Column profiles, metric rows and constraint suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.quality.checks import BOOLEAN, FRACTIONAL, INTEGRAL, STRING, type_class

# Limits of the default profile and of the suggestion rules.
LOW_CARDINALITY = 120
CATEGORY_UNIQUE_SHARE = 0.1
FRACTIONAL_CATEGORY_SHARE = 0.9
PERCENTILES = [i / 100 for i in range(1, 101)]
Z_95 = 1.96

# Percentiles come from a mergeable sketch of fixed size; this size keeps the
# rank error below one percent.
SKETCH_SIZE = 400

PROFILE_DDL = """
    column string, data_type string, completeness double, approx_distinct bigint,
    n_rows bigint, n_non_null bigint, min double, max double, mean double, sum double,
    std_dev double, percentiles array<double>
"""


def number_of(df: DataFrame, column: str) -> Column | None:
    """The column as a double when it is numeric or text that may hold numbers."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return df[f"`{column}`"].cast("double")
    if isinstance(kind, T.StringType):
        numeric = type_class(df, column).isin(INTEGRAL, FRACTIONAL)
        return F.when(numeric, df[f"`{column}`"].try_cast("double"))
    return None


def _inferred_type(df: DataFrame, name: str, i: int) -> tuple[Column, list[Column]]:
    """The inferred type of a column and the aggregates it needs.

    Only text is classified value by value; other types have one class.
    """
    n = F.col(f"n{i}")
    kind = df.schema[name].dataType
    if not isinstance(kind, T.StringType):
        label = (
            INTEGRAL if isinstance(kind, T.IntegralType)
            else FRACTIONAL if isinstance(kind, T.NumericType)
            else BOOLEAN if isinstance(kind, T.BooleanType)
            else STRING
        )
        return F.when(n == 0, F.lit("Unknown")).otherwise(F.lit(label)), []
    value = type_class(df, name)
    counted = [
        F.count_if(value == INTEGRAL).alias(f"ti{i}"),
        F.count_if(value == FRACTIONAL).alias(f"tf{i}"),
        F.count_if(value == BOOLEAN).alias(f"tb{i}"),
    ]
    inferred = (
        F.when(n == 0, F.lit("Unknown"))
        .when(F.col(f"ti{i}") == n, F.lit(INTEGRAL))
        .when(F.col(f"ti{i}") + F.col(f"tf{i}") == n, F.lit(FRACTIONAL))
        .when(F.col(f"tb{i}") == n, F.lit(BOOLEAN))
        .otherwise(F.lit(STRING))
    )
    return inferred, counted


def profile(df: DataFrame, percentiles: bool = True) -> DataFrame:
    """One row per column, all columns in one pass.

    The inferred type is the widest class among the non-null values. Numeric
    measures are given for columns whose values are all numbers.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    ranks = F.expr(f"array({', '.join(f'{p}D' for p in PERCENTILES)})")
    for i, name in enumerate(df.columns):
        n = F.col(f"n{i}")
        value = df[f"`{name}`"]
        aggs += [F.count(value).alias(f"n{i}"), F.approx_count_distinct(value).alias(f"d{i}")]
        inferred, counted = _inferred_type(df, name, i)
        aggs += counted
        number = number_of(df, name)
        measures = {m: F.lit(None).cast("double") for m in ("min", "max", "mean", "sum", "std_dev")}
        quantiles = F.lit(None).cast("array<double>")
        if number is not None:
            aggs += [
                F.min(number).alias(f"lo{i}"),
                F.max(number).alias(f"hi{i}"),
                F.sum(number).alias(f"su{i}"),
                F.stddev_pop(number).alias(f"sd{i}"),
            ]
            measures = {
                "min": F.col(f"lo{i}"),
                "max": F.col(f"hi{i}"),
                "mean": F.try_divide(F.col(f"su{i}"), n),
                "sum": F.col(f"su{i}"),
                "std_dev": F.col(f"sd{i}"),
            }
            if percentiles:
                aggs.append(F.kll_sketch_agg_double(number, F.lit(SKETCH_SIZE)).alias(f"pc{i}"))
                quantiles = F.when(n > 0, F.kll_sketch_get_quantile_double(f"pc{i}", ranks))
            if counted:  # text: only if all values are numbers
                is_number = F.col(f"ti{i}") + F.col(f"tf{i}") == n
                measures = {m: F.when(is_number, v) for m, v in measures.items()}
                quantiles = F.when(is_number, quantiles)
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                inferred.alias("data_type"),
                F.try_divide(n, F.col("n_rows")).alias("completeness"),
                F.col(f"d{i}").alias("approx_distinct"),
                F.col("n_rows").alias("n_rows"),
                n.alias("n_non_null"),
                *[v.alias(m) for m, v in measures.items()],
                quantiles.alias("percentiles"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts of low-cardinality columns, in one pass for all of them."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(F.col(c).cast("string"), F.lit("NullValue")).alias("value"),
            )
            for c in columns
        ]
    )
    counts = df.select(F.inline(pairs)).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("absolute")
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("ratio", F.col("absolute") / total)


def low_cardinality(profiled: list) -> list[str]:
    """Columns of a collected profile that get a histogram."""
    return [r["column"] for r in profiled if r["approx_distinct"] <= LOW_CARDINALITY]


def profile_with_histogram(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile rows, histogram rows); the profile decides which columns are counted."""
    rows = profile(df).collect()
    profiled = df.sparkSession.createDataFrame(rows, PROFILE_DDL)
    columns = low_cardinality(rows)
    return profiled, histogram(df, columns) if columns else None


def analyze(df: DataFrame, complete: list[str] | None = None, size: bool = True) -> DataFrame:
    """Metric rows (entity, instance, name, value): size and completeness."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    if size:
        rows.append(("Dataset", "*", "Size", F.col("n_rows").cast("double")))
    for i, c in enumerate(complete or []):
        aggs.append(F.count(c).alias(f"n{i}"))
        rows.append(("Column", c, "Completeness", F.try_divide(F.col(f"n{i}"), F.col("n_rows"))))
    structs = [
        F.struct(
            F.lit(entity).alias("entity"),
            F.lit(instance).alias("instance"),
            F.lit(name).alias("name"),
            value.alias("value"),
        )
        for entity, instance, name, value in rows
    ]
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def suggest(df: DataFrame) -> DataFrame:
    """Constraints that the present data suggests, by the default rules.

    Rules: complete column, keep the completeness seen, keep the inferred type
    of a text column, categorical range, range of most rows, non-negative.
    """
    profiled = profile(df, percentiles=False).collect()
    histograms = _category_counts(df, low_cardinality(profiled))
    out = []
    for r in profiled:
        name, n, ratio = r["column"], r["n_rows"], r["completeness"] or 0.0
        if n == 0:
            continue
        if ratio == 1.0:
            out.append((name, "CompleteIfComplete", f"{name} is not null", f"Completeness: {ratio}"))
        elif 0.2 < ratio < 1.0:
            low = ratio - Z_95 * (ratio * (1 - ratio) / n) ** 0.5
            text = f"{name} is at least {low:.2f} complete"
            out.append((name, "RetainCompleteness", text, f"Completeness: {ratio}"))
        typed = r["data_type"] in (INTEGRAL, FRACTIONAL, BOOLEAN)
        if isinstance(df.schema[name].dataType, T.StringType) and typed:
            text = f"{name} has type {r['data_type']}"
            out.append((name, "RetainType", text, f"DataType: {r['data_type']}"))
        if r["data_type"] in (INTEGRAL, FRACTIONAL) and (r["min"] or 0.0) >= 0 and r["min"] is not None:
            out.append((name, "NonNegativeNumbers", f"{name} has no negative values", f"Minimum: {r['min']}"))
        counts = histograms.get(name)
        if counts and isinstance(df.schema[name].dataType, T.StringType):
            out += _category_rules(name, counts)
    schema = "column string, rule string, description string, current_value string"
    return df.sparkSession.createDataFrame(out, schema)


def _category_counts(df: DataFrame, columns: list[str]) -> dict[str, list]:
    # At most LOW_CARDINALITY values (within the sketch's error) per column.
    columns = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not columns:
        return {}
    parts = histogram(df, columns).filter(F.col("value") != "NullValue").collect()
    grouped: dict[str, list] = {}
    for r in parts:
        grouped.setdefault(r["column"], []).append((r["value"], r["absolute"]))
    return {c: sorted(v, key=lambda p: (-p[1], p[0])) for c, v in grouped.items()}


def _category_rules(name: str, counts: list) -> list[tuple]:
    total = sum(n for _, n in counts)
    once = sum(1 for _, n in counts if n == 1)
    if once / len(counts) > CATEGORY_UNIQUE_SHARE:
        return []
    listed = ", ".join(f"'{v}'" for v, _ in counts)
    rules = [(name, "CategoricalRange", f"{name} has value range {listed}", f"Values: {len(counts)}")]
    covered, kept = 0, []
    for value, n in counts:
        if covered / total >= FRACTIONAL_CATEGORY_SHARE:
            break
        covered += n
        kept.append(value)
    if len(kept) < len(counts):
        listed = ", ".join(f"'{v}'" for v in kept)
        text = f"{name} has value range {listed} for at least {covered / total:.2f} of values"
        rules.append((name, "FractionalCategoricalRange", text, f"Share: {covered / total}"))
    return rules


def metric_rows(result: DataFrame) -> DataFrame:
    """Check results as metric rows."""
    return result.select(
        F.lit("Column").alias("entity"),
        F.regexp_extract("constraint", r"\((\w+)", 1).alias("instance"),
        F.regexp_extract("constraint", r"^(\w+)", 1).alias("name"),
        "value",
    )
