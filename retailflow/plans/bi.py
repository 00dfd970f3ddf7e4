"""BI tables, the dashboard set and the translation job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from retailflow.functions.text import split_words, translate_columns
from retailflow.model import BI_END, BI_START
from retailflow.operators.aggregates import (
    city_counts,
    monthly_totals,
    payment_type_by_month,
    session_counts,
    status_ranked_counts,
)
from retailflow.operators.slices import between_slice, month_slice
from retailflow.sinks.landing import write_csv

# The time column that bounds each fact table for BI.
BI_TIMES = {
    "orders": "order_purchase_timestamp",
    "order_items": "shipping_limit_date",
    "order_reviews": "review_creation_date",
}


def build_bi_tables(
    tables: dict[str, DataFrame], start: str = BI_START, end: str = BI_END
) -> dict[str, DataFrame]:
    """All tables, with the timed facts cut to the BI range (both ends count)."""
    return {
        name: between_slice(df, BI_TIMES[name], start, end) if name in BI_TIMES else df
        for name, df in tables.items()
    }


def dashboard(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dashboard queries over the BI tables."""
    orders, reviews = tables["orders"], tables["order_reviews"]
    return {
        "order_status": status_ranked_counts(orders),
        "orders_by_month": monthly_totals(orders, "order_purchase_timestamp"),
        "orders_by_session": session_counts(orders, "order_purchase_timestamp"),
        "cities": city_counts(tables["geolocation"]),
        "payment_types": payment_type_by_month(orders, tables["order_payments"]),
        "review_words": split_words(reviews, "review_comment_message"),
    }


def translate_month(
    reviews: DataFrame,
    month: str,
    path: str,
    translate: Callable[[list[str]], list[str]] | None = None,
    connect: Callable[[], Callable[[list[str]], list[str]]] | None = None,
) -> int:
    """Translate the reviews of one month, write them as CSV, return their number.

    The count is observed during the write, so the model runs once per text.
    """
    rows = month_slice(reviews, "review_creation_date", month)
    columns = ["review_comment_title", "review_comment_message"]
    done = Observation("translated")
    out = translate_columns(rows, columns, translate, connect)
    write_csv(out.observe(done, F.count(F.lit(1)).alias("n")), path)
    return done.get["n"]
