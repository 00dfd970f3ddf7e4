"""Temporal slices, cursor columns and row-validity splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.functions.time import cursor_parts, month_bounds, next_day, time_literal
from retailflow.model import DATE_PARTS


def _half_open(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    return df.filter((F.col(ts) >= time_literal(df, ts, lo)) & (F.col(ts) < time_literal(df, ts, hi)))


def day_slice(df: DataFrame, ts: str, day: str, lookback_days: int = 0) -> DataFrame:
    """Rows whose ``ts`` falls on ``day`` (or in the days before it, with lookback).

    A half-open range on the bare column, so the scan can skip files and row
    groups; truncating the column would hide it from the scan.
    """
    return _half_open(df, ts, next_day(day, -lookback_days), next_day(day))


def days_slice(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows from day ``start`` up to, and without, day ``end``."""
    return _half_open(df, ts, start, end)


def month_slice(df: DataFrame, ts: str, month: str) -> DataFrame:
    """Rows whose ``ts`` falls in the ``YYYY-MM`` month."""
    return _half_open(df, ts, *month_bounds(month))


def between_slice(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Rows with ``lo <= ts <= hi``; both ends count."""
    return df.filter(F.col(ts).between(time_literal(df, ts, lo), time_literal(df, ts, hi)))


def partition_slice(df: DataFrame, day: str) -> DataFrame:
    """Rows of one day of a table partitioned by year, month and day."""
    year, month, dom = cursor_parts(day)
    return df.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == dom))


def partition_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of the days ``[start, end)`` of a table partitioned by year, month and day.

    The month test prunes tables that are partitioned by year and month only.
    """
    lo, hi = cursor_parts(start), cursor_parts(end)
    month = F.col("year") * 100 + F.col("month")
    day = month * 100 + F.col("day")
    in_months = month.between(lo[0] * 100 + lo[1], hi[0] * 100 + hi[1])
    after, before = (y * 10000 + m * 100 + d for y, m, d in (lo, hi))
    return df.filter(in_months & (day >= after) & (day < before))


def add_date_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add integer ``year``, ``month`` and ``day`` of a timestamp column."""
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    )


def add_cursor_parts(df: DataFrame, day: str) -> DataFrame:
    """Add integer ``year``, ``month`` and ``day`` of the load cursor."""
    parts = dict(zip(DATE_PARTS, cursor_parts(day)))
    return df.withColumns({name: F.lit(value).cast("int") for name, value in parts.items()})


def split_valid(df: DataFrame, rule: str) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy ``rule``, all other rows); an unknown result rejects."""
    ok = F.coalesce(F.expr(rule), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def complete_fields(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add every column of ``columns`` (name → type) that is missing, as null."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing).select(*columns) if missing else df.select(*columns)
