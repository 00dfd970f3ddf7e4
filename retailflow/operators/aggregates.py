"""Dashboard aggregates, key probes and frame summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.functions.text import normal_city
from retailflow.functions.time import month_text, session_of_day


def _count(name: str):
    return F.count(F.lit(1)).alias(name)


def status_ranked_counts(orders: DataFrame, status: str = "order_status") -> DataFrame:
    """Order count per status, with the rank in front of the status.

    The ranking window sees one row per status only.
    """
    counts = orders.groupBy(status).agg(_count("count"))
    rank = F.row_number().over(Window.orderBy(F.desc("count"), F.asc(status)))
    return counts.select(F.concat_ws("-", rank.cast("string"), status).alias(status), "count")


def monthly_totals(df: DataFrame, ts: str) -> DataFrame:
    """Row count per ``YYYY-MM`` month, in order.

    Rows are counted per truncated month first; the text is made once per month.
    """
    months = df.groupBy(F.trunc(ts, "month").alias("m")).agg(_count("total"))
    return months.select(month_text("m").alias("yearmonth"), "total").orderBy("yearmonth")


def session_counts(df: DataFrame, ts: str) -> DataFrame:
    """Row count per session of the day."""
    return df.groupBy(session_of_day(ts).alias("session")).agg(_count("count"))


def city_counts(df: DataFrame, city: str = "geolocation_city") -> DataFrame:
    """Row count per city, one spelling per city, largest first.

    Counted per raw spelling first, so the text work is done once per spelling.
    """
    raw = df.groupBy(city).agg(_count("n"))
    named = raw.groupBy(normal_city(city).alias("city")).agg(F.sum("n").alias("count"))
    return named.orderBy(F.desc("count"), "city")


def payment_type_by_month(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Paid orders per month and payment type, largest first."""
    paid = payments.filter(F.col("payment_type").isNotNull()).select("order_id", "payment_type")
    placed = orders.select("order_id", F.trunc("order_purchase_timestamp", "month").alias("m"))
    counts = placed.join(paid, "order_id").groupBy("m", "payment_type").agg(_count("count"))
    named = counts.select(month_text("m").alias("yearmonth"), "payment_type", "count")
    return named.orderBy(F.desc("count"), "yearmonth", "payment_type")


def time_range(df: DataFrame, ts: str) -> DataFrame:
    """First time, last time and row count."""
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), _count("n_rows"))


def time_groups(df: DataFrame, ts: str) -> DataFrame:
    """The (year, month) groups of a table with their sizes."""
    return df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(_count("n_rows"))


def key_probe(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(_count("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        _count("n_keys"),
        F.count_if(F.col("__n") > 1).alias("n_repeated_keys"),
    )


def distinct_on(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``, nulls last, then by the other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lead = []
    for c in order_by or []:
        lead += [F.col(c).isNull().alias(f"__no_{c}"), F.col(c)]
    lead += [F.col(c) for c in rest if c not in (order_by or [])]
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*lead)).alias("__row"))
    return firsts.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def frame_summary(df: DataFrame, percentiles: bool = False) -> DataFrame:
    """Per column: count, null count, mean, sample deviation, min and max.

    Numbers are summarised as doubles and times as epoch seconds; other columns
    have counts only. All columns are summarised in one pass.
    """
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        value = _as_double(f)
        aggs += [
            F.count(f.name).alias(f"n{i}"),
            F.count_if(F.col(f.name).isNull()).alias(f"z{i}"),
            F.avg(value).alias(f"a{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
            F.min(value).alias(f"l{i}"),
            F.max(value).alias(f"h{i}"),
        ]
        cols = [
            F.lit(f.name).alias("column"),
            F.col(f"n{i}").alias("count"),
            F.col(f"z{i}").alias("null_count"),
            F.col(f"a{i}").alias("mean"),
            F.col(f"s{i}").alias("std"),
            F.col(f"l{i}").alias("min"),
            F.col(f"h{i}").alias("max"),
        ]
        if percentiles:
            aggs.append(F.percentile_approx(value, [0.25, 0.5, 0.75]).alias(f"p{i}"))
            cols.append(F.col(f"p{i}").alias("quartiles"))
        rows.append(F.struct(*cols))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def partition_skew(df: DataFrame, column: str) -> DataFrame:
    """Rows, smallest and largest value per physical partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        _count("n_rows"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )


def sample_rows(df: DataFrame, n: int, not_null: str, keys: list[str], seed: int = 0) -> DataFrame:
    """``n`` random rows among those where ``not_null`` is present: the same rows on any layout.

    A bottom-k sample: the rows with the least md5 of seed and keys, ties by the other columns. Every
    task keeps ``n`` rows at most before they meet. The sample of a union is the sample of the
    union of samples, so batches can be sampled as they come.
    """
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    rest = [c for c in df.columns if c not in keys]
    return df.filter(F.col(not_null).isNotNull()).orderBy(mark, *keys, *rest).limit(n)


def _as_double(f: T.StructField):
    if isinstance(f.dataType, T.NumericType):
        return F.col(f.name).cast("double")
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(f.name).cast("timestamp")) / F.lit(1e6)
    return F.lit(None).cast("double")
