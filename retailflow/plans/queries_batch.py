"""Dashboard, slice, join, merge and life-cycle queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailflow.functions.text import pg_initcap, split_words, words
from retailflow.functions.time import month_text
from retailflow.model import ORDER_ITEMS, ORDER_REVIEWS, ORDERS, WAREHOUSE_KEYS
from retailflow.operators import aggregates as agg
from retailflow.operators import joins, lifecycle, slices
from retailflow.operators.merge import field_upsert, insert_new, keyed_update, merge
from retailflow.operators.snapshots import StateSnapshots
from retailflow.plans import oracles as sql
from retailflow.plans.catalogue import query
from retailflow.session import scratch_path, widen
from retailflow.sources import sample_tables as src

DAY = "1998-10-03"
MONTH = "1998-10"
STATE_AT = "1999-01-01"
PURCHASED = "order_purchase_timestamp"


def money(column):
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


# --- dashboard ---------------------------------------------------------------
@query(
    "status_ranked_counts",
    f"""WITH {sql.ORDERS}, c AS (SELECT order_status, count(*) AS count FROM o GROUP BY 1)
    SELECT row_number() OVER (ORDER BY count DESC, order_status) || '-' || order_status AS order_status, count FROM c""",
)
def status_ranked_counts(spark, d):
    return agg.status_ranked_counts(src.orders(spark, d))


@query(
    "monthly_order_totals",
    "SELECT strftime(o_orderdate, '%Y-%m') AS yearmonth, count(*) AS total FROM orders GROUP BY 1",
)
def monthly_order_totals(spark, d):
    return agg.monthly_totals(src.orders(spark, d), PURCHASED)


@query(
    "session_of_day_counts",
    """SELECT CASE WHEN CAST(ts AS TIME) BETWEEN '00:00' AND '06:00' THEN '1-Dawn'
      WHEN CAST(ts AS TIME) BETWEEN '06:00' AND '12:00' THEN '2-Morning'
      WHEN CAST(ts AS TIME) BETWEEN '12:00' AND '18:00' THEN '3-Afternoon'
      WHEN CAST(ts AS TIME) BETWEEN '18:00' AND '23:59' THEN '4-Evening' END AS session,
    count(*) AS count FROM events GROUP BY 1""",
)
def session_of_day_counts(spark, d):
    return agg.session_counts(src.table(spark, d, "events"), "ts")


@query(
    "city_counts_normalised",
    rf"""WITH {sql.CITIES}, n AS (
      SELECT CASE WHEN geolocation_city = 'são paulo' THEN 'sao paulo' ELSE geolocation_city END AS c FROM g)
    SELECT array_to_string(list_transform(regexp_extract_all(lower(c), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'),
      lambda x: upper(x[1]) || x[2:]), '') AS city, count(*) AS count FROM n GROUP BY 1""",
)
def city_counts_normalised(spark, d):
    return agg.city_counts(src.geolocation(spark, d))


@query(
    "payment_type_by_month",
    f"""WITH {sql.ORDERS}, {sql.PAYMENTS}
    SELECT strftime(order_purchase_timestamp, '%Y-%m') AS yearmonth, payment_type, count(o.order_id) AS count
    FROM o JOIN p ON o.order_id = p.order_id WHERE payment_type IS NOT NULL GROUP BY 1, 2""",
)
def payment_type_by_month(spark, d):
    return agg.payment_type_by_month(src.orders(spark, d), src.order_payments(spark, d))


@query(
    "review_words",
    f"""SELECT word, count(*) AS count FROM (
      SELECT unnest({sql.WORDS}) AS word FROM documents WHERE text IS NOT NULL) GROUP BY 1""",
)
def review_words(spark, d):
    found = split_words(widen(src.table(spark, d, "documents").select("text")), "text")
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@query(
    "review_word_totals",
    f"""SELECT doc_id, len({sql.WORDS}) AS n_words, len(list_distinct({sql.WORDS})) AS n_distinct FROM documents""",
)
def review_word_totals(spark, d):
    docs = widen(src.table(spark, d, "documents").select("doc_id", "text"))
    found = docs.select("doc_id", words("text").alias("w"))
    return found.select(
        "doc_id",
        F.size("w").cast("bigint").alias("n_words"),
        F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"),
    )


@query(
    "product_names_initcap",
    r"""SELECT array_to_string(list_transform(regexp_extract_all(lower(p_name || '-' || p_type),
      '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda x: upper(x[1]) || x[2:]), '') AS name, count(*) AS n
    FROM part GROUP BY 1""",
)
def product_names_initcap(spark, d):
    raw = src.table(spark, d, "part").groupBy("p_name", "p_type").agg(F.count(F.lit(1)).alias("n"))
    name = pg_initcap(F.concat_ws("-", "p_name", "p_type"))
    return raw.groupBy(name.alias("name")).agg(F.sum("n").alias("n"))


@query(
    "order_time_range",
    "SELECT min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(*) AS n_rows FROM orders",
)
def order_time_range(spark, d):
    return agg.time_range(src.orders(spark, d), PURCHASED)


@query(
    "order_month_groups",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    count(*) AS n_rows FROM orders GROUP BY 1, 2""",
)
def order_month_groups(spark, d):
    return agg.time_groups(src.orders(spark, d), PURCHASED)


@query(
    "customer_distinct_pairs",
    "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
)
def customer_distinct_pairs(spark, d):
    return src.table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query(
    "first_order_per_customer",
    f"""WITH {sql.ORDERS} SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM o
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id) = 1""",
)
def first_order_per_customer(spark, d):
    columns = ["order_id", "customer_id", "order_status", PURCHASED]
    return agg.distinct_on(src.orders(spark, d).select(columns), ["customer_id"], [PURCHASED])


@query(
    "largest_payments",
    f"""WITH {sql.PAYMENTS} SELECT order_id, payment_type, payment_value FROM p
    ORDER BY payment_value DESC, order_id LIMIT 10""",
)
def largest_payments(spark, d):
    rows = src.order_payments(spark, d).select("order_id", "payment_type", "payment_value")
    return rows.orderBy(F.desc("payment_value"), "order_id").limit(10)


@query(
    "review_sample",
    f"""WITH {sql.REVIEWS} SELECT order_id, review_comment_title, review_comment_message FROM r
    WHERE review_comment_message IS NOT NULL
    ORDER BY md5('7|' || coalesce(CAST(order_id AS VARCHAR), '')), order_id, review_comment_title, review_comment_message LIMIT 2""",
)
def review_sample(spark, d):
    reviews = src.order_reviews(spark, d).select("order_id", "review_comment_title", "review_comment_message")
    return agg.sample_rows(reviews, 2, "review_comment_message", ["order_id"], seed=7)


@query(
    "key_uniqueness_probe",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
    count(*) FILTER (WHERE n > 1) AS n_repeated_keys
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def key_uniqueness_probe(spark, d):
    return agg.key_probe(src.order_items(spark, d), ["order_id", "order_item_id"])


@query(
    "frame_summary",
    sql.summary_rows(
        "events",
        [
            ("event_id", "CAST(event_id AS DOUBLE)"),
            ("ts", "epoch_us(ts) / 1e6"),
            ("user_id", "CAST(user_id AS DOUBLE)"),
            ("event_type", None),
            ("value", "value"),
            ("props", None),
        ],
    ),
)
def frame_summary(spark, d):
    out = agg.frame_summary(src.table(spark, d, "events"))
    digits = {"mean": 2, "std": 2, "min": 3, "max": 3}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("partition_skew")
def partition_skew(spark, d):
    return agg.partition_skew(src.orders(spark, d), PURCHASED)


@query(
    "partition_skew_totals",
    "SELECT count(*) AS n_rows, min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders",
)
def partition_skew_totals(spark, d):
    """The partition rows added up: what no file layout changes."""
    per_partition = agg.partition_skew(src.orders(spark, d), PURCHASED)
    return per_partition.agg(
        F.sum("n_rows").alias("n_rows"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value")
    )


# --- slices ------------------------------------------------------------------
@query(
    "day_slice_orders",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o
    WHERE date_trunc('day', order_purchase_timestamp) = DATE '{DAY}'""",
)
def day_slice_orders(spark, d):
    return slices.day_slice(src.orders(spark, d), PURCHASED, DAY)


@query(
    "lookback_slice_orders",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o
    WHERE date_trunc('day', order_purchase_timestamp) BETWEEN DATE '{DAY}' - 7 AND DATE '{DAY}'""",
)
def lookback_slice_orders(spark, d):
    return slices.day_slice(src.orders(spark, d), PURCHASED, DAY, lookback_days=7)


@query(
    "month_slice_orders",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o
    WHERE strftime(order_purchase_timestamp, '%Y-%m') = '{MONTH}'""",
)
def month_slice_orders(spark, d):
    return slices.month_slice(src.orders(spark, d), PURCHASED, MONTH)


@query(
    "between_orders",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o
    WHERE order_purchase_timestamp BETWEEN '1997-01-01' AND '1998-08-31'""",
)
def between_orders(spark, d):
    return slices.between_slice(src.orders(spark, d), PURCHASED, "1997-01-01", "1998-08-31")


@query(
    "orders_outside_year",
    """SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n FROM orders
    WHERE year(o_orderdate) <> 1996 GROUP BY 1""",
)
def orders_outside_year(spark, d):
    kept = src.orders(spark, d).filter(F.year(PURCHASED) != 1996)
    return kept.groupBy(F.date_format(PURCHASED, "yyyy").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "next_cursor_days",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS cursor, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_cursor,
    count(*) AS n FROM orders GROUP BY 1, 2""",
)
def next_cursor_days(spark, d):
    days = src.orders(spark, d).groupBy(F.to_date(PURCHASED).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    cursor = F.date_format("day", "yyyy-MM-dd").alias("cursor")
    return days.select(cursor, F.date_format(F.date_add("day", 1), "yyyy-MM-dd").alias("next_cursor"), "n")


# --- joins -------------------------------------------------------------------
@query(
    "day_children_inner",
    f"""WITH {sql.ORDERS}, {sql.ITEMS} SELECT i.* FROM o JOIN i ON o.order_id = i.order_id
    WHERE date_trunc('day', order_purchase_timestamp) = DATE '{DAY}'""",
)
def day_children_inner(spark, d):
    return joins.day_children(src.orders(spark, d), src.order_items(spark, d), DAY)


@query(
    "day_children_left_compat",
    f"""WITH {sql.ORDERS}, {sql.ITEMS} SELECT i.* FROM o LEFT JOIN i ON o.order_id = i.order_id
    WHERE date_trunc('day', order_purchase_timestamp) = DATE '{DAY}'""",
)
def day_children_left_compat(spark, d):
    return joins.day_children(src.orders(spark, d), src.order_items(spark, d), DAY, keep_empty=True)


@query(
    "children_right_join",
    f"""WITH {sql.ORDERS}, {sql.ITEMS}, sel AS (SELECT order_id FROM o
      WHERE date_trunc('day', order_purchase_timestamp) = DATE '{DAY}')
    SELECT i.* FROM i RIGHT JOIN sel ON i.order_id = sel.order_id""",
)
def children_right_join(spark, d):
    return joins.children_right(src.orders(spark, d), src.order_items(spark, d), DAY)


@query(
    "selected_semi",
    f"""WITH {sql.ORDERS}, {sql.ITEMS} SELECT i.* FROM i WHERE order_id IN (SELECT order_id FROM o
      WHERE date_trunc('day', order_purchase_timestamp) = DATE '{DAY}')""",
)
def selected_semi(spark, d):
    return joins.children_of_selected(src.orders(spark, d), src.order_items(spark, d), DAY)


@query(
    "orders_anti",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = order_id)""",
)
def orders_anti(spark, d):
    return joins.orders_without(src.orders(spark, d), src.order_items(spark, d))


@query(
    "order_events_wide",
    f"""WITH {sql.ORDERS}, {sql.ITEMS}, {sql.PAYMENTS}
    SELECT o.order_id, order_status, order_item_id, product_id, price, payment_type, payment_value
    FROM o LEFT JOIN i ON o.order_id = i.order_id LEFT JOIN p ON o.order_id = p.order_id""",
)
def order_events_wide(spark, d):
    wide = joins.order_fan_out(src.orders(spark, d), src.order_items(spark, d), src.order_payments(spark, d))
    return wide.select(
        "order_id", "order_status", "order_item_id", "product_id", "price", "payment_type", "payment_value"
    )


@query(
    "items_with_parent_time",
    f"""WITH {sql.ORDERS}, {sql.ITEMS} SELECT i.*, order_purchase_timestamp FROM i JOIN o ON o.order_id = i.order_id
    WHERE strftime(order_purchase_timestamp, '%Y-%m') = '{MONTH}'""",
)
def items_with_parent_time(spark, d):
    return joins.with_parent_time(src.order_items(spark, d), src.orders(spark, d), MONTH)


@query(
    "payments_at_approval",
    f"""WITH {sql.ORDERS}, {sql.PAYMENTS}, e AS (
      SELECT p.*, order_approved_at AS timestamp, order_purchase_timestamp AS purchased_timestamp
      FROM p JOIN o ON o.order_id = p.order_id)
    SELECT *, round((epoch_us(timestamp) - (SELECT min(epoch_us(purchased_timestamp)) FROM e)) / 1e6 / 86400, 6) AS ttl
    FROM e WHERE timestamp IS NOT NULL""",
)
def payments_at_approval(spark, d):
    times = [PURCHASED, "order_approved_at"]
    rows = joins.with_parent_time(src.order_payments(spark, d), src.orders(spark, d), times=times)
    events = lifecycle.child_events(rows, "order_approved_at")
    origin = rows.select(F.col(PURCHASED).alias("purchased_timestamp"))
    return lifecycle.with_ttl(events, origin=origin).withColumn("ttl", F.round("ttl", 6))


@query(
    "items_at_purchase",
    f"""WITH {sql.ORDERS}, {sql.ITEMS}
    SELECT strftime(order_purchase_timestamp, '%Y-%m') AS yearmonth, count(*) AS n_events, {sql.money('price')} AS price
    FROM i JOIN o ON o.order_id = i.order_id WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1""",
)
def items_at_purchase(spark, d):
    rows = joins.with_parent_time(src.order_items(spark, d), src.orders(spark, d))
    events = lifecycle.child_events(rows, PURCHASED)
    months = events.groupBy(F.trunc("timestamp", "month").alias("m"))
    out = months.agg(F.count(F.lit(1)).alias("n_events"), money("price").alias("price"))
    return out.select(month_text("m").alias("yearmonth"), "n_events", "price")


# --- merges ------------------------------------------------------------------
# A batch of late orders arrives for a table that holds earlier ones; the ranges overlap.
ORDER_REST = [c for c in sql.ORDER_COLUMNS.split(", ") if c != "order_id"]
ITEM_REST = ["price", "freight_value"]
ORDERS_BATCH = f"""{sql.ORDERS},
  t AS (SELECT * REPLACE ('created' AS order_status, CAST(NULL AS TIMESTAMP) AS order_approved_at)
    FROM o WHERE order_purchase_timestamp < '1999-01-01'),
  s AS (SELECT * REPLACE (customer_id + 1 AS customer_id) FROM o WHERE order_purchase_timestamp >= '1998-01-01')"""
ITEMS_BATCH = f"""{sql.ITEMS},
  t AS (SELECT * FROM i WHERE shipping_limit_date < '1999-01-01'),
  s AS (SELECT * REPLACE (price + 1 AS price, freight_value + 1 AS freight_value)
    FROM i WHERE shipping_limit_date >= '1998-01-01')"""


def orders_batch(spark, d):
    orders = src.orders(spark, d)
    target = slices.days_slice(orders, PURCHASED, "1900-01-01", "1999-01-01").withColumns(
        {"order_status": F.lit("created"), "order_approved_at": F.lit(None).cast("timestamp_ntz")}
    )
    source = slices.days_slice(orders, PURCHASED, "1998-01-01", "2100-01-01")
    return target, source.withColumn("customer_id", F.col("customer_id") + 1)


def items_batch(spark, d):
    items = src.order_items(spark, d)
    target = slices.days_slice(items, "shipping_limit_date", "1900-01-01", "1999-01-01")
    source = slices.days_slice(items, "shipping_limit_date", "1998-01-01", "2100-01-01")
    return target, source.withColumns({c: F.col(c) + 1 for c in ITEM_REST})


@query(
    "merge_partial_update",
    f"WITH {ORDERS_BATCH} " + sql.merged("t", "s", ["order_id"], ORDER_REST, list(ORDERS.update)),
)
def merge_partial_update(spark, d):
    target, source = orders_batch(spark, d)
    return merge(target, source, ORDERS.keys, ORDERS.update)


@query(
    "merge_update_all",
    f"WITH {ITEMS_BATCH} " + sql.merged("t", "s", ORDER_ITEMS.keys, ITEM_REST, ITEM_REST),
)
def merge_update_all(spark, d):
    target, source = items_batch(spark, d)
    return merge(target, source, ORDER_ITEMS.keys)


@query(
    "merge_insert_only",
    f"WITH {ITEMS_BATCH} " + sql.merged("t", "s", ORDER_ITEMS.keys, ITEM_REST, []),
)
def merge_insert_only(spark, d):
    target, source = items_batch(spark, d)
    return merge(target, source, ORDER_ITEMS.keys, update=None)


PAYMENTS_BATCH = f"""{sql.PAYMENTS},
  t AS (SELECT * REPLACE (0.0::DOUBLE AS payment_value) FROM p WHERE payment_installments <= 3),
  s AS (SELECT * FROM p WHERE payment_installments >= 3)"""


def payments_batch(spark, d):
    payments = src.order_payments(spark, d)
    target = payments.filter("payment_installments <= 3").withColumn("payment_value", F.lit(0.0))
    return target, payments.filter("payment_installments >= 3")


@query(
    "merge_three_key",
    f"WITH {PAYMENTS_BATCH} "
    + sql.merged(
        "t", "s", ["order_id", "payment_sequential", "payment_installments"],
        ["payment_type", "payment_value"], ["payment_type", "payment_value"],
    ),
)
def merge_three_key(spark, d):
    target, source = payments_batch(spark, d)
    return merge(target, source, ["order_id", "payment_sequential", "payment_installments"])


@query(
    "merge_four_key",
    f"WITH {PAYMENTS_BATCH} "
    + sql.merged("t", "s", WAREHOUSE_KEYS["order_payments"], ["payment_value"], ["payment_value"]),
)
def merge_four_key(spark, d):
    target, source = payments_batch(spark, d)
    return merge(target, source, WAREHOUSE_KEYS["order_payments"])


REVIEW_REST = [
    "review_answer_timestamp", "review_comment_message", "review_comment_title",
    "review_creation_date", "review_score",
]
REVIEWS_BATCH = f"""{sql.REVIEWS},
  t AS (SELECT * REPLACE (CAST(NULL AS INTEGER) AS review_score) FROM r WHERE review_comment_title < 'src5'),
  s AS (SELECT * FROM r WHERE review_comment_title >= 'src3')"""


@query(
    "merge_reviews",
    f"WITH {REVIEWS_BATCH} " + sql.merged("t", "s", ORDER_REVIEWS.keys, REVIEW_REST, REVIEW_REST),
)
def merge_reviews(spark, d):
    reviews = src.order_reviews(spark, d)
    target = reviews.filter("review_comment_title < 'src5'").withColumn("review_score", F.lit(None).cast("int"))
    return merge(target, reviews.filter("review_comment_title >= 'src3'"), ORDER_REVIEWS.keys)


@query(
    "insert_on_conflict_nothing",
    f"""WITH {sql.ITEMS}, t AS (SELECT * FROM i WHERE shipping_limit_date < '1998-01-01'
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
          ORDER BY shipping_limit_date, product_id, seller_id, price, freight_value) = 1),
      s AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
          ORDER BY shipping_limit_date, product_id, seller_id, price, freight_value) = 1)
    SELECT * FROM t UNION ALL SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t
      WHERE t.order_id = s.order_id AND t.order_item_id = s.order_item_id)""",
)
def insert_on_conflict_nothing(spark, d):
    keys = ["order_id", "order_item_id"]
    items = src.order_items(spark, d)
    early = slices.days_slice(items, "shipping_limit_date", "1900-01-01", "1998-01-01")
    target = agg.distinct_on(early, keys, ["shipping_limit_date"])
    return insert_new(target, items, keys, order_by=["shipping_limit_date"])


@query(
    "keyed_update",
    f"WITH {ORDERS_BATCH} "
    + sql.merged("t", "s", ["order_id"], ORDER_REST, ["order_status", "order_approved_at"], insert=False),
)
def keyed_update_orders(spark, d):
    target, source = orders_batch(spark, d)
    changes = source.select("order_id", "order_status", "order_approved_at")
    return keyed_update(target, changes, ["order_id"], ["order_status", "order_approved_at"])


@query(
    "field_upsert",
    f"""WITH {sql.REVIEWS}, t AS (SELECT order_id, review_id, review_comment_title, review_score FROM r
        WHERE review_comment_title < 'src5'),
      s AS (SELECT order_id, review_id, CAST(NULL AS VARCHAR) AS review_comment_title, 3 AS review_score FROM r
        WHERE review_comment_title >= 'src3') """
    + sql.merged("t", "s", ORDER_REVIEWS.keys, ["review_comment_title", "review_score"], ["review_score"]),
)
def field_upsert_reviews(spark, d):
    reviews = src.order_reviews(spark, d).select("order_id", "review_id", "review_comment_title", "review_score")
    target = reviews.filter("review_comment_title < 'src5'")
    source = reviews.filter("review_comment_title >= 'src3'").select("order_id", "review_id", F.lit(3).alias("review_score"))
    return field_upsert(target, source, ORDER_REVIEWS.keys)


@query(
    "merge_idempotent_count",
    f"""WITH {ITEMS_BATCH}, m AS ({sql.merged("t", "s", ORDER_ITEMS.keys, ITEM_REST, ITEM_REST)})
    SELECT count(*) AS n_rows, {sql.money('price')} AS price, {sql.money('freight_value')} AS freight_value FROM m""",
)
def merge_idempotent_count(spark, d):
    target, source = items_batch(spark, d)
    once = merge(target, source, ORDER_ITEMS.keys)
    twice = merge(once, source, ORDER_ITEMS.keys)
    return twice.agg(
        F.count(F.lit(1)).alias("n_rows"), money("price").alias("price"), money("freight_value").alias("freight_value")
    )


@query(
    "completed_review_events",
    f"""WITH {sql.REVIEWS} SELECT order_id, review_id, review_creation_date, CAST(NULL AS INTEGER) AS review_score,
      CAST(NULL AS VARCHAR) AS review_comment_title FROM r""",
)
def completed_review_events(spark, d):
    """Created events hold three fields; the rest of the document is completed with nulls."""
    created = src.order_reviews(spark, d).select("order_id", "review_id", "review_creation_date")
    document = {
        "order_id": "bigint",
        "review_id": "string",
        "review_creation_date": "timestamp_ntz",
        "review_score": "int",
        "review_comment_title": "string",
    }
    return slices.complete_fields(created, document)


# --- life cycle --------------------------------------------------------------
STAGES = [
    (0, "purchased", "order_purchase_timestamp", "'created'"),
    (1, "approved", "order_approved_at", "'approved'"),
    (2, "delivered_carrier", "order_delivered_carrier_date", "'shipped'"),
    (3, "delivered_customer", "order_delivered_customer_date", "'delivered'"),
    (4, "estimated_delivery", "order_estimated_delivery_date", "order_status"),
]
EVENTS_SQL = "\nUNION ALL ".join(
    f"SELECT order_id, customer_id, order_estimated_delivery_date, order_purchase_timestamp AS purchased_timestamp,"
    f" {i} AS ordinal, '{stage}' AS stage, {column} AS timestamp, {status} AS order_status FROM s"
    f" WHERE order_purchase_timestamp IS NOT NULL AND {column} IS NOT NULL"
    for i, stage, column, status in STAGES
)


@query("lifecycle_events", f"WITH {sql.SHIPPED} {EVENTS_SQL}")
def lifecycle_events(spark, d):
    return lifecycle.to_events(src.shipped_orders(spark, d))


@query(
    "event_ttl",
    f"""WITH {sql.SHIPPED}, e AS ({EVENTS_SQL})
    SELECT order_id, stage, timestamp,
      round((epoch_us(timestamp) - (SELECT min(epoch_us(order_purchase_timestamp)) FROM s)) / 1e6 / 86400, 6) AS ttl FROM e""",
)
def event_ttl(spark, d):
    orders = src.shipped_orders(spark, d)
    origin = src.orders(spark, d).select(F.col(PURCHASED).alias("purchased_timestamp"))
    events = lifecycle.with_ttl(lifecycle.to_events(orders), origin=origin, sort_by=["order_id", "ordinal"])
    return events.select("order_id", "stage", "timestamp", F.round("ttl", 6).alias("ttl"))


@query("state_as_of", f"WITH {sql.SHIPPED} " + sql.state_at("s", STATE_AT))
def state_as_of(spark, d):
    return lifecycle.state_as_of(lifecycle.to_events(src.shipped_orders(spark, d)), STATE_AT)


@query("state_as_of_wide", f"WITH {sql.SHIPPED} " + sql.state_at("s", STATE_AT))
def state_as_of_wide(spark, d):
    return lifecycle.order_state_at(src.shipped_orders(spark, d), STATE_AT)


@query("state_as_of_snapshots", f"WITH {sql.SHIPPED} " + sql.state_at("s", STATE_AT))
def state_as_of_snapshots(spark, d):
    """The state from the last yearly snapshot and the tail; a quarter of the events comes late, some come twice."""
    events = lifecycle.to_events(src.shipped_orders(spark, d))
    late = F.pmod(F.xxhash64("order_id", "stage"), F.lit(4)) == 0
    table = StateSnapshots(spark, scratch_path(spark, "state_snapshots"), every=12)
    table.append(events.filter(~late | (F.col("stage") == "approved")))
    table.append(events.filter(late))
    return table.as_of(STATE_AT)


@query("final_state", f"WITH {sql.SHIPPED} " + sql.state_at("s", "2100-01-01"))
def final_state(spark, d):
    return lifecycle.state_as_of(lifecycle.to_events(src.shipped_orders(spark, d)), "2100-01-01")


@query(
    "stage_counts",
    f"WITH {sql.SHIPPED}, e AS ({EVENTS_SQL}) SELECT stage, count(*) AS n_events FROM e GROUP BY 1",
)
def stage_counts(spark, d):
    return lifecycle.stage_counts(lifecycle.to_events(src.shipped_orders(spark, d)))


@query(
    "month_list",
    """SELECT strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)),
      date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM orders""",
)
def month_list(spark, d):
    return lifecycle.month_list(src.orders(spark, d), PURCHASED)


@query(
    "month_list_compat",
    """SELECT strftime(unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 MONTH)), '%Y-%m') AS month
    FROM (SELECT o_orderdate AS ts FROM orders WHERE year(o_orderdate) <> 1995)""",
)
def month_list_compat(spark, d):
    rest = src.orders(spark, d).filter(F.year(PURCHASED) != 1995)
    return lifecycle.month_list(rest, PURCHASED, compat=True)


REVIEW_AT = "2017-01-01 08:00:00"


@query(
    "review_state",
    f"""WITH {sql.REVIEWS}
    SELECT review_id, order_id, review_creation_date,
      CASE WHEN review_answer_timestamp <= TIMESTAMP '{REVIEW_AT}' THEN review_score END AS review_score,
      CASE WHEN review_answer_timestamp <= TIMESTAMP '{REVIEW_AT}' THEN review_comment_title END AS review_comment_title,
      CASE WHEN review_answer_timestamp <= TIMESTAMP '{REVIEW_AT}' THEN review_comment_message END AS review_comment_message,
      CASE WHEN review_answer_timestamp <= TIMESTAMP '{REVIEW_AT}' THEN review_answer_timestamp END AS review_answer_timestamp
    FROM r WHERE review_creation_date <= TIMESTAMP '{REVIEW_AT}'""",
)
def review_state(spark, d):
    return lifecycle.review_state(lifecycle.review_events(src.order_reviews(spark, d)), REVIEW_AT)
