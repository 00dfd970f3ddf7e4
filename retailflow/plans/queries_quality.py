"""Check, profile, suggestion and validity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailflow.functions.text import is_number_text
from retailflow.model import ORDER_STATUSES, PAYMENT_TYPES, REVIEW_IS_VALID
from retailflow.operators.slices import split_valid
from retailflow.plans import oracles as sql
from retailflow.plans.catalogue import query
from retailflow.quality import checks, partials, profile
from retailflow.quality.repository import load_metrics, save_metrics
from retailflow.session import scratch_path
from retailflow.sinks.folders import Folders, fresh, replace_partitions
from retailflow.sinks.tables import path_exists, write_table
from retailflow.sources import sample_tables as src


def _rounded(result):
    return result.select(
        "check", "check_level", "check_status", "constraint", "constraint_status", F.round("value", 9).alias("value")
    )


ORDERS_SQL = f"WITH {sql.ORDERS} " + sql.check_rows(
    "o",
    "orders",
    [
        sql.unique("order_id", "o"),
        sql.complete("order_id"),
        sql.complete("customer_id"),
        sql.complete("order_purchase_timestamp"),
        sql.complete("order_estimated_delivery_date"),
        sql.contained("order_status", ORDER_STATUSES),
    ],
)


@query("check_orders", ORDERS_SQL)
def check_orders(spark, d):
    return _rounded(checks.run_checks(src.orders(spark, d), checks.ORDERS_CHECK))


ITEMS_SQL = f"WITH {sql.ITEMS} " + sql.check_rows(
    "i",
    "order_items",
    [
        sql.complete("order_id"),
        sql.complete("seller_id"),
        sql.complete("product_id"),
        sql.complete("price"),
        sql.positive("price"),
        sql.typed("price", "Numeric"),
        sql.complete("freight_value"),
        sql.positive("freight_value"),
        sql.typed("freight_value", "Numeric"),
        sql.complete("order_item_id"),
        sql.positive("order_item_id"),
        sql.typed("order_item_id", "Integral"),
    ],
)


@query("check_items", ITEMS_SQL)
def check_items(spark, d):
    return _rounded(checks.run_checks(src.order_items(spark, d), checks.ORDER_ITEMS_CHECK))


@query(
    "check_payments",
    f"WITH {sql.PAYMENTS} "
    + sql.check_rows(
        "p",
        "order_payments",
        [
            sql.complete("order_id"),
            sql.typed("payment_value", "Fractional"),
            sql.typed("payment_sequential", "Integral"),
            sql.typed("payment_installments", "Integral"),
            sql.contained("payment_type", PAYMENT_TYPES),
        ],
    ),
)
def check_payments(spark, d):
    return _rounded(checks.run_checks(src.order_payments(spark, d), checks.ORDER_PAYMENTS_CHECK))


@query(
    "check_reviews",
    f"WITH {sql.REVIEWS} "
    + sql.check_rows(
        "r",
        "order_reviews",
        [
            sql.complete("order_id"),
            sql.complete("review_id"),
            sql.complete("review_creation_date"),
            sql.typed("review_score", "Integral"),
        ],
    ),
)
def check_reviews(spark, d):
    return _rounded(checks.run_checks(src.order_reviews(spark, d), checks.ORDER_REVIEWS_CHECK))


@query(
    "check_status_unique",
    f"WITH {sql.ORDERS} "
    + sql.check_rows("o", "Check", [sql.unique("order_status", "o"), sql.complete("order_approved_at")], "Warning"),
)
def check_status_unique(spark, d):
    check = checks.Check("Check", checks.WARNING).is_unique("order_status").is_complete("order_approved_at")
    return _rounded(checks.run_checks(src.orders(spark, d), check))


@query(
    "check_summary",
    f"""SELECT "check", check_level, bool_and(constraint_status = 'Success') AS passed,
      count(*) FILTER (WHERE constraint_status <> 'Success') AS n_failed
    FROM ((SELECT "check", check_level, constraint_status FROM ({ORDERS_SQL}))
      UNION ALL (SELECT "check", check_level, constraint_status FROM ({ITEMS_SQL}))) GROUP BY 1, 2""",
)
def check_summary(spark, d):
    results = checks.run_checks(src.orders(spark, d), checks.ORDERS_CHECK).unionByName(
        checks.run_checks(src.order_items(spark, d), checks.ORDER_ITEMS_CHECK)
    )
    return checks.check_summary(results)


def _exact(profiled):
    digits = {"completeness": 9, "mean": 4, "sum": 2, "std_dev": 4}
    out = profiled.withColumns({c: F.round(c, n) for c, n in digits.items()})
    return out.drop("approx_distinct", "percentiles")


@query(
    "profile_orders",
    f"WITH {sql.ORDERS} "
    + sql.profile_rows(
        "o",
        [
            ("order_id", "Integral", True),
            ("customer_id", "Integral", True),
            ("order_status", "String", False),
            ("order_purchase_timestamp", "String", False),
            ("order_approved_at", "String", False),
            ("order_delivered_carrier_date", "String", False),
            ("order_delivered_customer_date", "String", False),
            ("order_estimated_delivery_date", "String", False),
        ],
    ),
)
def profile_orders(spark, d):
    return _exact(profile.profile(src.orders(spark, d), percentiles=False))


@query(
    "profile_items",
    f"WITH {sql.ITEMS} "
    + sql.profile_rows(
        "i",
        [
            ("order_id", "Integral", True),
            ("order_item_id", "Integral", True),
            ("product_id", "Integral", True),
            ("seller_id", "Integral", True),
            ("shipping_limit_date", "String", False),
            ("price", "Fractional", True),
            ("freight_value", "Fractional", True),
        ],
    ),
)
def profile_items(spark, d):
    return _exact(profile.profile(src.order_items(spark, d), percentiles=False))


ITEM_COLUMNS = ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value")
CLOSE = "SELECT column, TRUE AS distinct_within, TRUE AS percentiles_within FROM (VALUES {}) AS t(column)".format(
    ", ".join(f"('{c}')" for c in ITEM_COLUMNS)
).replace("column", '"column"')


def _within(df, profiled, distinct_error, rank_error=0.01):
    """Whether the sketched figures of a profile lie within their error of the exact ones.

    A percentile p is within if at most p + error of the values are smaller and at least p - error not larger.
    """
    asked = (25, 50, 75)
    checked = None
    for r in profiled.select("column", "approx_distinct", "n_non_null", "percentiles").collect():
        # Each column alone: rows are counted by value once, figures are taken from the values.
        values = df.select(F.col(r["column"]).alias("v")).filter(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        value, n = F.col("v").cast("double"), r["n_non_null"]
        aggs, right = [F.count(F.lit(1)).alias("d")], F.lit(True)
        for p in asked if r["percentiles"] else ():
            q = F.lit(r["percentiles"][p - 1])
            below, upto = (F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (value < q, value <= q))
            aggs += [F.coalesce(below, F.lit(0)).alias(f"l{p}"), F.coalesce(upto, F.lit(0)).alias(f"u{p}")]
            right = right & (F.col(f"l{p}") <= (p / 100 + rank_error) * n) & (F.col(f"u{p}") >= (p / 100 - rank_error) * n)
        near = F.abs(F.col("d") - r["approx_distinct"]) <= distinct_error * F.col("d")
        row = values.agg(*aggs).select(
            F.lit(r["column"]).alias("column"), near.alias("distinct_within"), right.alias("percentiles_within")
        )
        checked = row if checked is None else checked.unionByName(row)
    return checked


@query("profile_approximate", CLOSE)
def profile_approximate(spark, d):
    """Distinct counts (three times five percent) and percentiles (ranks, one percent) are as near as they should be."""
    items = src.order_items(spark, d)
    return _within(items, profile.profile(items), 0.15)


@query(
    "profile_merged",
    f"WITH {sql.ITEMS} SELECT * FROM ("
    + sql.profile_rows(
        "i",
        [(c, k, k != "String") for c, k in zip(ITEM_COLUMNS, ["Integral"] * 4 + ["String"] + ["Fractional"] * 2)],
    )
    + f''') JOIN ({CLOSE}) USING ("column")''',
)
def profile_merged(spark, d):
    """The profile of the items merged from one of each year and line, after two years were rewritten.

    Exact figures must be those of the whole; sketched ones lie within their stated error.
    """
    items = src.order_items(spark, d)
    path, store, parts = scratch_path(spark, "profiled"), scratch_path(spark, "partials"), ["y", "line"]
    placed = items.withColumns({"y": F.coalesce(F.year("shipping_limit_date"), F.lit(0)) % 8, "line": F.col("order_item_id") % 2})
    wrong = placed.withColumn("price", F.when(F.col("y") < 2, F.col("price") * 3 + 1).otherwise(F.col("price")))
    write_table(wrong, path, parts)
    if not path_exists(spark, path):  # no rows, no partitions
        nothing = profile.profile(items)
        return _exact(nothing).join(_within(items, nothing, 0), "column")
    partials.refresh_partials(spark, path, store, parts)
    fixed = placed.filter("y < 2")
    staged = fresh(path, "staged")
    write_table(fixed, staged, parts)
    folders = [f"y={y}/line={n}" for y in (0, 1) for n in (0, 1) if Folders(spark, path).exists(f"{path}/y={y}/line={n}")]
    replace_partitions(spark, staged, path, folders)
    partials.refresh_partials(spark, path, store, parts, folders)
    merged = partials.stored_profile(spark, store).filter(~F.col("column").isin(parts))
    return _exact(merged).join(_within(items, merged, partials.DISTINCT_ERROR), "column")


SUGGESTED = f"""WITH {sql.ORDERS},
c AS (SELECT "column", n / total AS ratio, total FROM (SELECT count(*) AS total FROM o), (
  UNPIVOT (SELECT count(COLUMNS(*)) AS "\\0" FROM o) ON COLUMNS(*) INTO NAME "column" VALUE n)),
v AS (SELECT order_status AS v, count(*) AS n FROM o WHERE order_status IS NOT NULL GROUP BY 1),
s AS (SELECT v, n, sum(n) OVER () AS total,
  coalesce(sum(n) OVER (ORDER BY n DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM v),
k AS (SELECT * FROM s WHERE before / total < {profile.FRACTIONAL_CATEGORY_SHARE})
SELECT "column", 'CompleteIfComplete' AS rule, "column" || ' is not null' AS description, 'Completeness: 1.0' AS current_value
FROM c WHERE ratio = 1
UNION ALL SELECT "column", 'RetainCompleteness', "column" || ' is at least '
  || printf('%.2f', ratio - {profile.Z_95} * sqrt(ratio * (1 - ratio) / total)) || ' complete', 'Completeness: ' || CAST(ratio AS VARCHAR)
FROM c WHERE ratio > 0.2 AND ratio < 1
UNION ALL SELECT 'order_id', 'NonNegativeNumbers', 'order_id has no negative values', 'Minimum: ' || CAST(CAST(min(order_id) AS DOUBLE) AS VARCHAR) FROM o
UNION ALL SELECT 'customer_id', 'NonNegativeNumbers', 'customer_id has no negative values',
  'Minimum: ' || CAST(CAST(min(customer_id) AS DOUBLE) AS VARCHAR) FROM o
UNION ALL SELECT 'order_status', 'CategoricalRange',
  'order_status has value range ' || string_agg(chr(39) || v || chr(39), ', ' ORDER BY n DESC, v), 'Values: ' || count(*) FROM v
UNION ALL SELECT 'order_status', 'FractionalCategoricalRange',
  'order_status has value range ' || string_agg(chr(39) || v || chr(39), ', ' ORDER BY n DESC, v) || ' for at least '
  || printf('%.2f', sum(n) / any_value(total)) || ' of values', 'Share: ' || CAST(sum(n) / any_value(total) AS VARCHAR)
FROM k HAVING count(*) < (SELECT count(*) FROM v)"""


@query("constraint_suggestions", SUGGESTED)
def constraint_suggestions(spark, d):
    return profile.suggest(src.orders(spark, d))


@query(
    "column_histogram",
    f"""WITH {sql.PAYMENTS}, v AS (
      SELECT 'payment_type' AS "column", coalesce(payment_type, 'NullValue') AS value FROM p
      UNION ALL SELECT 'payment_installments', CAST(payment_installments AS VARCHAR) FROM p)
    SELECT "column", value, count(*) AS absolute, round(count(*) / (SELECT count(*) FROM p), 9) AS ratio FROM v GROUP BY 1, 2""",
)
def column_histogram(spark, d):
    counts = profile.histogram(src.order_payments(spark, d), ["payment_type", "payment_installments"])
    return counts.withColumn("ratio", F.round("ratio", 9))


@query(
    "metric_analysis",
    f"""WITH {sql.ORDERS}
    SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM o
    UNION ALL SELECT 'Column', 'order_id', 'Completeness', round(count(order_id) / count(*), 9) FROM o
    UNION ALL SELECT 'Column', 'order_approved_at', 'Completeness', round(count(order_approved_at) / count(*), 9) FROM o""",
)
def metric_analysis(spark, d):
    rows = profile.analyze(src.orders(spark, d), ["order_id", "order_approved_at"])
    return rows.withColumn("value", F.round("value", 9))


@query(
    "metric_history",
    f"""WITH {sql.ITEMS}, m AS (
      SELECT 'Size' AS name, '*' AS instance, CAST(count(*) AS DOUBLE) AS value FROM i
      UNION ALL SELECT 'Completeness', 'price', count(price) / count(*) FROM i)
    SELECT m.*, unnest([1000::BIGINT, 2000::BIGINT]) AS result_time_ms FROM m""",
)
def metric_history(spark, d):
    root = scratch_path(spark, "metrics")
    rows = profile.analyze(src.order_items(spark, d), ["price"])
    for at in (1000, 2000):
        save_metrics(rows, root, "order_items", "metrics", at_ms=at)
    schema = "entity string, instance string, name string, value double"
    history = load_metrics(spark, root, "order_items", "metrics", schema)
    return history.select("name", "instance", "value", "result_time_ms")


@query(
    "review_validity_split",
    f"""WITH {sql.REVIEWS} SELECT coalesce({REVIEW_IS_VALID}, false) AS valid, count(*) AS n_rows,
      CAST(sum(length(review_comment_message)) AS BIGINT) AS n_chars FROM r GROUP BY 1""",
)
def review_validity_split(spark, d):
    good, bad = split_valid(src.order_reviews(spark, d), REVIEW_IS_VALID)
    both = good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))
    return both.groupBy("valid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("review_comment_message")).alias("n_chars")
    )


@query(
    "valid_reviews",
    f"""WITH {sql.REVIEWS} SELECT order_id, review_id, review_score, review_creation_date FROM r WHERE {REVIEW_IS_VALID}""",
)
def valid_reviews(spark, d):
    good, _ = split_valid(src.order_reviews(spark, d), REVIEW_IS_VALID)
    return good.select("order_id", "review_id", "review_score", "review_creation_date")


@query(
    "null_counts",
    f"""WITH {sql.REVIEWS} SELECT count(*) FILTER (WHERE review_score IS NULL) AS null_scores,
      count(*) FILTER (WHERE review_score IS NOT NULL) AS scores,
      count(*) FILTER (WHERE review_comment_message IS NULL) AS null_messages FROM r""",
)
def null_counts(spark, d):
    return src.order_reviews(spark, d).agg(
        F.count_if(F.col("review_score").isNull()).alias("null_scores"),
        F.count("review_score").alias("scores"),
        F.count_if(F.col("review_comment_message").isNull()).alias("null_messages"),
    )


@query(
    "number_text_events",
    """SELECT event_type, count(*) AS n_rows, count(TRY_CAST(n AS INTEGER)) AS n_numbers
    FROM (SELECT event_type, replace(split_part(props, ': ', 2), '}', '') AS n FROM events) GROUP BY 1""",
)
def number_text_events(spark, d):
    text = F.replace(F.split_part("props", F.lit(": "), F.lit(2)), F.lit("}"), F.lit(""))
    rows = src.table(spark, d, "events").select("event_type", text.alias("n"))
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(is_number_text("n")).alias("n_numbers")
    )
