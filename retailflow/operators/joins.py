"""Parent-child joins between orders and their items, payments and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.operators.slices import day_slice, month_slice
from retailflow.session import broadcast_if_small

PURCHASED = "order_purchase_timestamp"
#: Child rows of one order beyond which a left join splits the order over tasks.
HOT_ROWS = 100_000
#: Counters of a summary, ids that it lists at most, and the share of rows beyond which none is missed.
SUMMARY_IDS = 10_000
LISTED_IDS = 1_500
SUMMARY_ERROR = 1e-3


def with_parent_time(
    child: DataFrame, orders: DataFrame, month: str | None = None, times: list[str] | None = None
) -> DataFrame:
    """Child rows with the times of their order, for orders of one month (or all).

    Children without an order, or whose order has no purchase time, drop out, so
    this is an inner join and the month filter runs on the order side first.
    """
    times = times or [PURCHASED]
    parents = orders.select("order_id", *dict.fromkeys([PURCHASED, *times]))
    parents = parents.filter(F.col(PURCHASED).isNotNull())
    if month:
        parents = month_slice(parents, PURCHASED, month)
    return child.join(parents, "order_id").select(*child.columns, *times)


def selected_orders(orders: DataFrame, day: str, ts: str = PURCHASED, lookback_days: int = 0) -> DataFrame:
    """Ids of the orders of one day, broadcast when they measure small."""
    return broadcast_if_small(day_slice(orders, ts, day, lookback_days).select("order_id"))


def day_children(
    orders: DataFrame,
    child: DataFrame,
    day: str,
    keep_empty: bool = False,
    lookback_days: int = 0,
) -> DataFrame:
    """Child rows of the orders of one day.

    ``keep_empty`` gives an all-null row for every order without children, as a
    left join that keeps only the child columns does.
    """
    picked = selected_orders(orders, day, lookback_days=lookback_days)
    if not keep_empty:
        return child.join(picked, "order_id").select(*child.columns)
    joined = left_from_few(picked, child)
    return joined.select(*[F.col(f"__{c}").alias(c) for c in child.columns])


def children_right(orders: DataFrame, child: DataFrame, day: str) -> DataFrame:
    """Child columns of ``child RIGHT JOIN selected orders``."""
    return day_children(orders, child, day, keep_empty=True)


def children_of_selected(orders: DataFrame, child: DataFrame, day: str) -> DataFrame:
    """Child rows whose order id is among the orders of one day."""
    return child.join(selected_orders(orders, day), "order_id", "left_semi")


def orders_without(orders: DataFrame, child: DataFrame) -> DataFrame:
    """Orders that have no child row.

    The ids are made distinct before the shuffle, so an order with very many
    children costs one row per input partition.
    """
    return orders.join(child.select("order_id").distinct(), "order_id", "left_anti")


def order_fan_out(
    orders: DataFrame, items: DataFrame, payments: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Orders left-joined with items and payments: one row per combination."""
    return left_join_spread(left_join_spread(orders, items, hot_rows), payments, hot_rows)


def heavy_ids(child: DataFrame, column: str, more_than: int) -> list:
    """Ids with more than ``more_than`` rows, from a summary of bounded size; no shuffle of the ids.

    Each task keeps ``SUMMARY_IDS`` counters and sends one row; the summaries merge. Every id with
    more rows than ``SUMMARY_ERROR`` of all is in the result, smaller ones if the summary still
    holds them. Candidates alone are counted again, exactly, so no other id gets in.
    """
    ids = child.select(F.col(column).alias("i")).filter(F.col("i").isNotNull())
    top = ids.select(F.expr(f"approx_top_k(i, {LISTED_IDS}, {SUMMARY_IDS})").alias("t")).first()["t"]
    listed = [r["item"] for r in top or [] if r["count"] > more_than]
    if not listed:
        return []
    counts = ids.filter(F.col("i").isin(listed)).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    return [r["i"] for r in counts.filter(F.col("n") > more_than).collect()]


def left_join_spread(parent: DataFrame, child: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``parent LEFT JOIN child`` on ``order_id`` that survives huge orders.

    A left join cannot split the child rows of one id over tasks, an inner join can. So
    the ids with more than ``hot_rows`` child rows are found first (see ``heavy_ids``) and
    joined apart. Every hot id has children, so an inner join loses none of its
    parents. ``hot_rows`` decides where the work is done, never what rows come out.
    """
    hot = heavy_ids(child, "order_id", hot_rows)
    if not hot:
        return parent.join(child, "order_id", "left")
    rest = [c for c in child.columns if c != "order_id"]
    is_hot = F.coalesce(F.col("order_id").isin(hot), F.lit(False))
    cold = parent.filter(~is_hot).join(child.filter(~is_hot), "order_id", "left")
    large = child.filter(is_hot).join(parent.filter(is_hot), "order_id")
    columns = [*parent.columns, *rest]
    return cold.select(columns).unionByName(large.select(columns))


def left_from_few(parent: DataFrame, child: DataFrame) -> DataFrame:
    """``parent LEFT JOIN child`` on ``order_id``; child columns get ``__``.

    Done as an inner join plus the childless parents: that way a broadcast of the
    parents leaves the child table unshuffled, which a left join would not, and a huge
    order is split. Parents of a null id have no children.
    """
    renamed = child.withColumnsRenamed({c: f"__{c}" for c in child.columns})
    matched = parent.join(renamed, F.col("order_id") == F.col("__order_id"))
    with_child = child.select("order_id").join(parent.select("order_id"), "order_id", "left_semi")
    childless = parent.join(with_child.distinct(), "order_id", "left_anti").select(*parent.columns)
    nulls = {f"__{f.name}": F.lit(None).cast(f.dataType) for f in child.schema.fields}
    return matched.unionByName(childless.withColumns(nulls))
