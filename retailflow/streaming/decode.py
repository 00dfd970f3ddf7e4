"""Row maps from change messages to typed rows.

Every function works on a streaming and on a batch frame alike; none keeps state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.functions.time import iso_to_timestamp, micros_to_timestamp

# ---------------------------------------------------------------------------
# Message schemas (times are epoch microseconds).
# ---------------------------------------------------------------------------
ORDERS_CHANGE_DDL = """
    order_id string,
    customer_id string,
    order_status string,
    order_approved_at bigint,
    order_purchase_timestamp bigint,
    order_delivered_carrier_date bigint,
    order_delivered_customer_date bigint,
    order_estimated_delivery_date bigint
"""

ITEMS_CHANGE_DDL = """
    order_id string,
    seller_id string,
    product_id string,
    order_item_id bigint,
    shipping_limit_date bigint,
    freight_value double,
    price double
"""

PAYMENTS_CHANGE_DDL = """
    order_id string,
    payment_type string,
    payment_sequential bigint,
    payment_installments bigint,
    payment_value double
"""

REVIEW_FIELDS = [
    "order_id",
    "review_id",
    "review_score",
    "review_comment_title",
    "review_comment_message",
    "review_creation_date",
    "review_answer_timestamp",
]

ORDER_TIMES = [
    "order_approved_at",
    "order_purchase_timestamp",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

KEPT_OPS = ("c", "u", "r")
KEPT_CHANGES = ("insert", "update", "replace")
REGISTRY_HEADER_BYTES = 5
# ---------------------------------------------------------------------------


def orders_rows(df: DataFrame) -> DataFrame:
    """Order changes with their five times decoded."""
    return df.withColumns({c: micros_to_timestamp(c) for c in ORDER_TIMES})


def items_rows(df: DataFrame, compat: bool = False) -> DataFrame:
    """Item changes; money as decimal(10,2), or rounded to units with ``compat``."""
    money = "decimal(10,0)" if compat else "decimal(10,2)"
    return df.withColumns(
        {
            "shipping_limit_date": micros_to_timestamp("shipping_limit_date"),
            "freight_value": F.col("freight_value").cast(money),
            "price": F.col("price").cast(money),
        }
    )


def reviews_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Review changes from JSON text; the text is parsed once for all fields.

    A score or time that does not parse gives null.
    """
    schema = ", ".join(f"{f} string" for f in REVIEW_FIELDS)
    parsed = df.select(F.from_json(payload, schema).alias("r")).select("r.*")
    return parsed.withColumns(
        {
            "review_score": F.col("review_score").try_cast("int"),
            "review_creation_date": iso_to_timestamp("review_creation_date"),
            "review_answer_timestamp": iso_to_timestamp("review_answer_timestamp"),
        }
    )


def payments_rows(df: DataFrame) -> DataFrame:
    """Payment changes, unchanged."""
    return df.select("*")


def unwrap_cdc(df: DataFrame, row_ddl: str, value: str = "value", table: str | None = None) -> DataFrame:
    """After-images of change envelopes; deletes and tombstones drop out.

    ``table`` keeps the changes of one source table only.
    """
    envelope = f"op string, after struct<{_struct(row_ddl)}>, source struct<table:string>"
    changes = df.select(F.from_json(value, envelope).alias("e")).select("e.*")
    kept = changes.filter(F.col("op").isin(*KEPT_OPS) & F.col("after").isNotNull())
    if table:
        kept = kept.filter(F.col("source.table") == table)
    return kept.select("after.*")


def filter_changes(
    df: DataFrame, document_ddl: str, value: str = "value", ops: tuple[str, ...] = KEPT_CHANGES
) -> DataFrame:
    """Full documents of a change feed, for the given operations."""
    feed = f"operationType string, fullDocument struct<{_struct(document_ddl)}>"
    changes = df.select(F.from_json(value, feed).alias("e")).select("e.*")
    kept = changes.filter(F.col("operationType").isin(*ops) & F.col("fullDocument").isNotNull())
    return kept.select("fullDocument.*")


def decode_kafka(df: DataFrame, fmt: str, schema: str) -> DataFrame:
    """Typed rows of a Kafka ``value``.

    ``json`` takes a DDL schema. ``avro`` takes an Avro schema in JSON and drops
    the schema-registry header; it needs the spark-avro jar.
    """
    if fmt == "json":
        return df.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        body = F.expr(f"substring(value, {REGISTRY_HEADER_BYTES + 1})")
        return df.select(from_avro(body, schema).alias("v")).select("v.*")
    raise ValueError("fmt must be 'json' or 'avro'")


def _struct(ddl: str) -> str:
    fields = T.StructType.fromDDL(ddl).fields
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in fields)
