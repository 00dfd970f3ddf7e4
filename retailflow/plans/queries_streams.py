"""Change-stream queries: message decoding in batch, and the same through streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailflow.plans import oracles as sql
from retailflow.plans.catalogue import query
from retailflow.session import scratch_path
from retailflow.sources import sample_tables as src
from retailflow.streaming import decode, monitor, sinks, state
from retailflow.streaming.handover import snapshot_then_tail
from retailflow.streaming.sources import read_change_stream

EPOCH = "1970-01-01 00:00:00"
TIMES = decode.ORDER_TIMES


def _micros(column):
    # Source times carry no zone; the offset from the epoch is taken in UTC.
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(column))


def _zone_free(df, columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def order_changes(spark, d):
    """Order messages: times as epoch microseconds, with a sub-millisecond part."""
    orders = src.shipped_orders(spark, d)
    return orders.withColumns({c: _micros(c) + 123456 for c in TIMES})


def item_changes(spark, d):
    items = src.order_items(spark, d)
    return items.select(
        "order_id",
        "seller_id",
        "product_id",
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        _micros("shipping_limit_date").alias("shipping_limit_date"),
        "freight_value",
        "price",
    )


def review_changes(spark, d):
    """Review messages: one JSON text each, with ISO times and the score as text."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    reviews = src.order_reviews(spark, d).withColumns(
        {
            "order_id": F.col("order_id").cast("string"),
            "review_score": F.col("review_score").cast("string"),
            "review_creation_date": F.date_format("review_creation_date", iso),
            "review_answer_timestamp": F.date_format("review_answer_timestamp", iso),
        }
    )
    return reviews.select(F.to_json(F.struct(*decode.REVIEW_FIELDS)).alias("payload"))


def _milli(column: str) -> str:
    return f"make_timestamp((epoch_us({column}) + 123456) // 1000 * 1000) AS {column}"


ORDERS_DECODED = f"""WITH {sql.SHIPPED} SELECT order_id, customer_id, order_status,
  {', '.join(_milli(c) for c in TIMES)} FROM s"""
ITEMS_DECODED = f"""WITH {sql.ITEMS} SELECT order_id, seller_id, product_id, CAST(order_item_id AS BIGINT) AS order_item_id,
  shipping_limit_date, freight_value, price FROM i"""
REVIEWS_DECODED = f"""WITH {sql.REVIEWS} SELECT CAST(order_id AS VARCHAR) AS order_id, review_id, review_score,
  review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp FROM r"""


def _orders_view(df):
    return _zone_free(df, TIMES).select("order_id", "customer_id", "order_status", *TIMES)


def _items_view(df):
    money = {c: F.col(c).cast("double") for c in ("freight_value", "price")}
    return _zone_free(df, ["shipping_limit_date"]).withColumns(money)


@query("cdc_orders_decoded", ORDERS_DECODED)
def cdc_orders_decoded(spark, d):
    return _orders_view(decode.orders_rows(order_changes(spark, d)))


@query("cdc_items_decoded", ITEMS_DECODED)
def cdc_items_decoded(spark, d):
    return _items_view(decode.items_rows(item_changes(spark, d)))


@query(
    "cdc_items_compat_totals",
    f"""WITH {sql.ITEMS} SELECT seller_id, CAST(sum(CAST(price AS DECIMAL(10,0))) AS DOUBLE) AS price,
      CAST(sum(CAST(freight_value AS DECIMAL(10,0))) AS DOUBLE) AS freight_value FROM i GROUP BY 1""",
)
def cdc_items_compat_totals(spark, d):
    rows = decode.items_rows(item_changes(spark, d), compat=True)
    return rows.groupBy("seller_id").agg(
        F.sum("price").cast("double").alias("price"), F.sum("freight_value").cast("double").alias("freight_value")
    )


@query("cdc_reviews_decoded", REVIEWS_DECODED)
def cdc_reviews_decoded(spark, d):
    return decode.reviews_rows(review_changes(spark, d))


# --- change envelopes --------------------------------------------------------
# Event types stand for operations.
OPS = {"signup": "c", "purchase": "u", "view": "r", "click": "u", "error": "d"}
FEED_OPS = {"signup": "insert", "purchase": "update", "view": "replace", "click": "invalidate", "error": "delete"}
EVENT_ROW = "event_id bigint, user_id bigint, event_type string, value double"


def _operation(mapping):
    chain = F
    for kind, op in mapping.items():
        chain = chain.when(F.col("event_type") == kind, F.lit(op))
    return chain


def change_envelopes(spark, d):
    events = src.table(spark, d, "events").withColumn("op", _operation(OPS))
    row = F.struct("event_id", "user_id", "event_type", "value")
    envelope = F.struct(
        "op",
        F.when(F.col("op") != "c", row).alias("before"),
        F.when(F.col("op") != "d", row).alias("after"),
        F.struct(F.when(F.col("event_type") == "click", F.lit("clicks")).otherwise(F.lit("events")).alias("table")).alias(
            "source"
        ),
    )
    return events.select(F.to_json(envelope).alias("value"))


@query(
    "cdc_unwrap",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'",
)
def cdc_unwrap(spark, d):
    return decode.unwrap_cdc(change_envelopes(spark, d), EVENT_ROW)


@query(
    "cdc_table_filter",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'click')",
)
def cdc_table_filter(spark, d):
    return decode.unwrap_cdc(change_envelopes(spark, d), EVENT_ROW, table="events")


@query(
    "changefeed_filter",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('signup', 'purchase', 'view')",
)
def changefeed_filter(spark, d):
    events = src.table(spark, d, "events").withColumn("operationType", _operation(FEED_OPS))
    document = F.struct("event_id", "user_id", "event_type", "value").alias("fullDocument")
    feed = events.select(F.to_json(F.struct("operationType", document)).alias("value"))
    return decode.filter_changes(feed, EVENT_ROW)


LATEST = """SELECT user_id, event_id, event_type, value, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("cdc_latest_state", LATEST)
def cdc_latest_state(spark, d):
    events = src.table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return sinks.latest_state(events, ["user_id"], ["ts", "event_id"])


# --- streams -----------------------------------------------------------------
def _feed(df, spark, name, files_per_batch=1000):
    """Write messages as Parquet files and open them as a stream."""
    path = scratch_path(spark, f"{name}_feed")
    df.write.parquet(path)
    return read_change_stream(spark, path, "parquet", df.schema, files_per_batch=files_per_batch)


def _through_files(rows, spark, name):
    """Run an append stream to its end and read what it wrote."""
    path = scratch_path(spark, f"{name}_out")
    sinks.start_files(rows, path, scratch_path(spark, f"{name}_checkpoint")).awaitTermination()
    return spark.read.parquet(path)


@query("stream_orders_rows", ORDERS_DECODED)
def stream_orders_rows(spark, d):
    rows = decode.orders_rows(_feed(order_changes(spark, d), spark, "orders"))
    return _orders_view(_through_files(rows, spark, "orders"))


@query("stream_items_rows", ITEMS_DECODED)
def stream_items_rows(spark, d):
    rows = decode.items_rows(_feed(item_changes(spark, d), spark, "items"))
    return _items_view(_through_files(rows, spark, "items"))


@query("stream_reviews_rows", REVIEWS_DECODED)
def stream_reviews_rows(spark, d):
    rows = decode.reviews_rows(_feed(review_changes(spark, d), spark, "reviews"))
    return _through_files(rows, spark, "reviews")


@query("stream_payments_rows", f"WITH {sql.PAYMENTS} SELECT * FROM p")
def stream_payments_rows(spark, d):
    rows = decode.payments_rows(_feed(src.order_payments(spark, d), spark, "payments"))
    return _through_files(rows, spark, "payments")


@query(
    "stream_statement_set",
    """SELECT 'orders' AS stream, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'order_items', count(*) FROM lineitem
    UNION ALL SELECT 'order_payments', count(*) FROM orders
    UNION ALL SELECT 'order_reviews', count(*) FROM documents""",
)
def stream_statement_set(spark, d):
    """Four streams into JSON document folders, run as one set."""
    root = scratch_path(spark, "index")
    streams = {
        "orders": decode.orders_rows(_feed(order_changes(spark, d), spark, "orders")),
        "order_items": decode.items_rows(_feed(item_changes(spark, d), spark, "items")),
        "order_payments": decode.payments_rows(_feed(src.order_payments(spark, d), spark, "payments")),
        "order_reviews": decode.reviews_rows(_feed(review_changes(spark, d), spark, "reviews")),
    }
    running = sinks.start_all(
        {n: (df, sinks.index_sink(sinks.json_writer(f"{root}/{n}"))) for n, df in streams.items()},
        scratch_path(spark, "index_checkpoints"),
    )
    rows = None
    for name, started in running.items():
        started.awaitTermination()
        documents = spark.read.schema("order_id string").json(f"{root}/{name}")
        one = documents.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stream"), "n_rows")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("stream_upsert_state", LATEST)
def stream_upsert_state(spark, d):
    """Keyed upsert over four micro-batches, the first three compacted; the last version per user."""
    events = src.table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    log = scratch_path(spark, "state")
    sink = sinks.upsert_sink(["user_id"], ["ts", "event_id"], sinks.version_writer(log))
    parts = spark.sparkContext.defaultParallelism
    stream = _feed(events.repartition(4 * parts, "event_id"), spark, "events", files_per_batch=parts)
    sinks.start_sink(stream, sink, scratch_path(spark, "state_checkpoint")).awaitTermination()
    sinks.compact_versions(spark, log, ["user_id"], ["ts", "event_id"])
    return sinks.read_state(spark, log, ["user_id"], ["ts", "event_id"])


@query("stream_state_updates", LATEST.replace("FROM events", "FROM events WHERE user_id IS NOT NULL"))
def stream_state_updates(spark, d):
    """The last event of each user, kept by a stateful stream: several batches, late and repeated events, one restart."""
    events = src.table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    feed, table, checkpoint = (scratch_path(spark, n) for n in ("state_feed", "state_table", "state_restart"))
    parts = spark.sparkContext.defaultParallelism
    # By hash: every file holds early and late events, so later batches bring older events too.
    mixed = events.repartition(2 * parts, F.xxhash64("event_id"))
    for again in (mixed, mixed.filter("event_id % 3 = 0")):
        again.write.mode("append").parquet(feed)
        stream = read_change_stream(spark, feed, "parquet", events.schema, files_per_batch=parts)
        state.start_state(stream, ["user_id"], ["ts", "event_id"], table, checkpoint, buckets=4).awaitTermination()
    return state.read_state_table(spark, table)


@query(
    "cdc_reviews_from_topic",
    REVIEWS_DECODED,
)
def cdc_reviews_from_topic(spark, d):
    """Records as they come from a topic: a value that holds one payload text."""
    records = review_changes(spark, d).select(F.to_json(F.struct("payload")).cast("binary").alias("value"))
    return decode.reviews_rows(decode.decode_kafka(records, "json", "payload string"))


@query(
    "stream_row_counts",
    "SELECT 'orders' AS stream, count(*) AS n_rows FROM orders UNION ALL SELECT 'events', count(*) FROM events",
)
def stream_row_counts(spark, d):
    """Rows that finished streams have delivered, counted in the sink: progress reports are kept for 100 batches only."""
    rows = None
    for name, df in (("orders", order_changes(spark, d)), ("events", src.table(spark, d, "events"))):
        out = scratch_path(spark, f"{name}_counted")
        started = sinks.start_files(_feed(df, spark, name), out, scratch_path(spark, f"{name}_checkpoint"))
        started.awaitTermination()
        delivered = spark.read.schema(df.schema).parquet(out).agg(F.count(F.lit(1)).alias("n_rows"))
        one = delivered.select(F.lit(name).alias("stream"), "n_rows")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query(
    "stream_batch_counts",
    """SELECT 'orders' AS stream, count(*) AS n_rows, max(o_orderdate)::TIMESTAMP AS last_time, true AS complete FROM orders
    UNION ALL SELECT 'events', count(*), max(ts)::TIMESTAMP, true FROM events""",
)
def stream_batch_counts(spark, d):
    """Rows and latest time of two streams, added up from what each micro-batch reported while it ran."""
    root = scratch_path(spark, "reports")
    feeds = {"orders": (src.table(spark, d, "orders"), "o_orderdate"), "events": (src.table(spark, d, "events"), "ts")}
    parts = spark.sparkContext.defaultParallelism
    with monitor.BatchLog(spark, root) as log:
        for name, (df, time) in feeds.items():
            feed = _feed(df.repartition(4 * parts), spark, f"{name}_watched", files_per_batch=parts)
            out = monitor.watched(feed, time).writeStream.queryName(name).trigger(availableNow=True)
            out = out.option("checkpointLocation", scratch_path(spark, f"{name}_watched_checkpoint"))
            running = out.format("parquet").start(scratch_path(spark, f"{name}_watched_out"))
            running.awaitTermination()
            log.drain(running)
    return monitor.stream_totals(monitor.read_reports(spark, root))


@query(
    "stream_snapshot_then_tail",
    """SELECT user_id, event_id, event_type, value, ts FROM events WHERE user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def stream_snapshot_then_tail(spark, d):
    """The last event of each user: a third is there before the snapshot, a third comes while it is taken, the rest after."""
    events = src.table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    log, root, table = (scratch_path(spark, n) for n in ("handover_log", "handover", "handover_state"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    lo, hi = events.agg(F.min("event_id")).scalar(), events.agg(F.max("event_id")).scalar()
    dealt = events.withColumn("third", F.floor(3 * (F.col("event_id") - lo) / (hi - lo + 1)))

    def arrive(condition):
        dealt.filter(condition).select(*events.columns).write.mode("append").parquet(log)

    def snapshot():
        arrive("third = 1")
        return sinks.latest_state(spark.read.schema(ddl).parquet(log).dropna(subset=["user_id"]), ["user_id"], ["event_id"])

    for arriving in ("third = 0", "third = 2 OR event_id % 7 = 0"):
        arrive(arriving)
        stream = snapshot_then_tail(spark, snapshot, log, ddl, "event_id", root)
        checkpoint = f"{root}/checkpoint"
        state.start_state(stream, ["user_id"], ["event_id"], table, checkpoint, buckets=4).awaitTermination()
    return state.read_state_table(spark, table)
