"""The eight retail tables: schemas, keys, partitions and value domains."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Column names, types, keys and domains of the retail data set.
# ---------------------------------------------------------------------------
ORDERS_DDL = """
    order_id string,
    customer_id string,
    order_status string,
    order_purchase_timestamp timestamp,
    order_approved_at timestamp,
    order_delivered_carrier_date timestamp,
    order_delivered_customer_date timestamp,
    order_estimated_delivery_date timestamp
"""

ORDER_ITEMS_DDL = """
    order_id string,
    order_item_id int,
    product_id string,
    seller_id string,
    shipping_limit_date timestamp,
    price decimal(10,2),
    freight_value decimal(10,2)
"""

ORDER_PAYMENTS_DDL = """
    order_id string,
    payment_sequential int,
    payment_type string,
    payment_installments int,
    payment_value decimal(10,2)
"""

ORDER_REVIEWS_DDL = """
    order_id string,
    review_id string,
    review_answer_timestamp timestamp,
    review_comment_message string,
    review_comment_title string,
    review_creation_date timestamp,
    review_score int
"""

CUSTOMERS_DDL = """
    customer_id string,
    customer_unique_id string,
    customer_zip_code_prefix int,
    customer_city string,
    customer_state string
"""

GEOLOCATION_DDL = """
    geolocation_zip_code_prefix int,
    geolocation_lat double,
    geolocation_lng double,
    geolocation_city string,
    geolocation_state string
"""

PRODUCTS_DDL = """
    product_id string,
    product_category_name string,
    product_name_lenght int,
    product_description_lenght int,
    product_photos_qty int,
    product_weight_g int,
    product_length_cm int,
    product_height_cm int,
    product_width_cm int
"""

SELLERS_DDL = """
    seller_id string,
    seller_zip_code_prefix int,
    seller_city string,
    seller_state string
"""

ORDER_STATUSES = [
    "approved",
    "processing",
    "invoiced",
    "canceled",
    "delivered",
    "shipped",
    "unavailable",
    "created",
]

PAYMENT_TYPES = ["credit_card", "debit_card", "voucher", "boleto", "not_defined"]

REVIEW_ID_LENGTH = 32

FIRST_DAY = "2017-01-01"
BACKFILL_END = "2018-12-31"
BI_START = "2017-01-01"
BI_END = "2018-08-31"
# ---------------------------------------------------------------------------

DATE_PARTS = ["year", "month", "day"]

# Tables whose texts hold line breaks: their landing files cannot be split when read.
LINE_BREAKS = {"order_reviews"}


@dataclass(frozen=True)
class TableSpec:
    """How one retail table is laid out and merged.

    ``update`` is ``"*"`` (all non-key columns), a list of columns, or ``None``
    for an insert-only merge. ``partition_time`` names the column that fixes the
    year/month/day partition; ``None`` with ``partitioned=True`` means the day
    cursor of the load fixes it.
    """

    name: str
    ddl: str
    keys: list[str] = field(default_factory=list)
    update: str | list[str] | None = "*"
    partition_time: str | None = None
    partitioned: bool = False
    slice_time: str | None = None


ORDERS = TableSpec(
    "orders",
    ORDERS_DDL,
    keys=["order_id"],
    update=[
        "order_status",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    ],
    partition_time="order_purchase_timestamp",
    partitioned=True,
    slice_time="order_purchase_timestamp",
)

ORDER_ITEMS = TableSpec(
    "order_items",
    ORDER_ITEMS_DDL,
    keys=["order_id", "product_id", "seller_id", "order_item_id", "shipping_limit_date"],
    partitioned=True,
)

ORDER_PAYMENTS = TableSpec(
    "order_payments",
    ORDER_PAYMENTS_DDL,
    keys=["order_id", "payment_sequential", "payment_installments"],
    partitioned=True,
)

ORDER_REVIEWS = TableSpec(
    "order_reviews",
    ORDER_REVIEWS_DDL,
    keys=["review_id", "order_id"],
    partition_time="review_creation_date",
    partitioned=True,
    slice_time="review_creation_date",
)

CUSTOMERS = TableSpec("customers", CUSTOMERS_DDL, keys=["customer_id"])
GEOLOCATION = TableSpec("geolocation", GEOLOCATION_DDL)
PRODUCTS = TableSpec("products", PRODUCTS_DDL, keys=["product_id"])
SELLERS = TableSpec("sellers", SELLERS_DDL, keys=["seller_id"])

FACTS = {t.name: t for t in (ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS)}
DIMENSIONS = {t.name: t for t in (CUSTOMERS, GEOLOCATION, PRODUCTS, SELLERS)}
TABLES = {**FACTS, **DIMENSIONS}

# The warehouse merges payments on one more column than the lakehouse.
WAREHOUSE_KEYS = {
    **{t.name: t.keys for t in FACTS.values()},
    "order_payments": ORDER_PAYMENTS.keys + ["payment_type"],
}

REVIEW_IS_VALID = (
    "order_id IS NOT NULL AND review_id IS NOT NULL AND review_score IS NOT NULL "
    f"AND review_creation_date IS NOT NULL AND length(review_id) = {REVIEW_ID_LENGTH}"
)
