"""Day pipelines and table merges that move rows, end to end through files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailflow.functions.time import next_day
from retailflow.model import DATE_PARTS, FACTS
from retailflow.operators import joins
from retailflow.operators.slices import add_date_parts
from retailflow.plans import lake as lakes
from retailflow.plans import oracles as sql
from retailflow.plans.catalogue import query
from retailflow.plans.queries_batch import DAY, PURCHASED
from retailflow.plans.queries_files import DAY_PARTS
from retailflow.session import scratch_name, scratch_path
from retailflow.sinks.keyindex import open_index
from retailflow.sinks.tables import create_table_ddl, merge_into_path, path_exists
from retailflow.sources import sample_tables as src

DAYS = 3
END = next_day(DAY, DAYS)
IN_DAYS = f"order_purchase_timestamp >= '{DAY}' AND order_purchase_timestamp < '{END}'"
PARTS = DAY_PARTS.format(t="order_purchase_timestamp")
# Landing files carry the model's types: ids are text.
TEXT_ORDERS = """CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
  order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
  order_estimated_delivery_date"""


def _doubles(df):
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema.fields if f.dataType.typeName() == "decimal"})


def _stored(spark, path: str, like):
    """The table at ``path``, or no rows of the same columns where no day had any."""
    return spark.read.parquet(path) if path_exists(spark, path) else like.limit(0)


def _landed(spark, name: str):
    """No rows, with the columns that a landed and loaded table has."""
    ddl = FACTS[name].ddl + ", " + ", ".join(f"{c} int" for c in DATE_PARTS)
    return spark.createDataFrame([], ddl)


def _run_days(spark, d, name: str, again: bool = False):
    """Landing file, check, merge and warehouse of one day after the other, by the cursor."""
    lake = lakes.Lake(scratch_path(spark, "flow"), first_day=DAY)
    tables = src.retail_tables(spark, d)

    def one(day: str) -> None:
        lookback = 1 if again and day != DAY else 0
        lakes.extract_day(tables, name, day, lake.root, lookback)
        lakes.lakehouse_day(spark, lake, name, day)
        lakes.warehouse_day(spark, lake, name, day)

    for _ in range(DAYS):
        lakes.run_next_day(spark, lake, name, one)
    if lakes.read_cursor(spark, lake, name) != END:
        raise AssertionError("the cursor did not follow the days")
    return lake


@query("day_pipeline_rows", f"WITH {sql.ORDERS} SELECT {TEXT_ORDERS}, {PARTS} FROM o WHERE {IN_DAYS}")
def day_pipeline_rows(spark, d):
    """Three days of orders, each with a lookback of one day, as the warehouse holds them."""
    lake = _run_days(spark, d, "orders", again=True)
    return _stored(spark, lake.warehouse("orders"), _landed(spark, "orders"))


@query(
    "day_pipeline_payments",
    f"""WITH {sql.ORDERS}, {sql.PAYMENTS} SELECT CAST(p.order_id AS VARCHAR) AS order_id, payment_sequential, payment_type,
      payment_installments, payment_value, {PARTS} FROM p JOIN o ON p.order_id = o.order_id WHERE {IN_DAYS}""",
)
def day_pipeline_payments(spark, d):
    """Three days of payments, partitioned by the cursor of their load."""
    lake = _run_days(spark, d, "order_payments")
    return _doubles(_stored(spark, lake.warehouse("order_payments"), _landed(spark, "order_payments")))


@query(
    "warehouse_items_of_day",
    f"""WITH {sql.ORDERS}, {sql.ITEMS} SELECT i.* FROM i JOIN o ON i.order_id = o.order_id
    WHERE CAST(order_purchase_timestamp AS DATE) = DATE '{DAY}'""",
)
def warehouse_items_of_day(spark, d):
    """Items of the orders in one partition of the lakehouse, merged twice into the warehouse."""
    lake = lakes.Lake(scratch_path(spark, "flow"), partition_by=("year", "month"))
    tables = src.retail_tables(spark, d)
    for name in ("orders", "order_items"):
        lakes.backfill(tables, lake, name, DAY, END, test=False)  # some freight is free
    for _ in range(2):
        lakes.warehouse_day(spark, lake, "order_items", DAY, through_orders=True)
    return _stored(spark, lake.warehouse("order_items"), tables["order_items"]).drop(*DATE_PARTS)


@query(
    "dimension_pipeline",
    """SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
      c_mktsegment AS customer_city, 'BR' AS customer_state FROM customer""",
)
def dimension_pipeline(spark, d):
    """A dimension through landing file, lakehouse and warehouse, refreshed twice."""
    lake = lakes.Lake(scratch_path(spark, "flow"))
    customers = src.customers(spark, d)
    lakes.refresh_dimension(customers.withColumn("customer_city", F.lit("old")), lake, "customers")
    lakes.refresh_dimension(customers, lake, "customers")
    return spark.read.parquet(lake.warehouse("customers"))


@query(
    "merge_moved_partition",
    f"""WITH {sql.ORDERS}, m AS (SELECT * REPLACE (CASE WHEN order_id % 7 = 0
      THEN order_purchase_timestamp + INTERVAL 400 DAY ELSE order_purchase_timestamp END AS order_purchase_timestamp) FROM o)
    SELECT {sql.ORDER_COLUMNS}, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
      CAST(month(order_purchase_timestamp) AS INTEGER) AS month FROM m""",
)
def merge_moved_partition(spark, d):
    """Corrected times move every seventh order to another month of the table."""
    path = scratch_path(spark, "moved")
    orders = add_date_parts(src.orders(spark, d), PURCHASED).drop("day")
    merge_into_path(orders, path, ["order_id"], "*", ["year", "month"])
    late = orders.filter(F.col("order_id") % 7 == 0).drop("year", "month")
    late = late.withColumn(PURCHASED, F.col(PURCHASED) + F.expr("INTERVAL 400 DAY"))
    late = add_date_parts(late, PURCHASED).drop("day")
    merge_into_path(late, path, ["order_id"], "*", ["year", "month"])
    return spark.read.parquet(path)


@query(
    "merge_by_key_index",
    f"""WITH {sql.ORDERS}, m AS (SELECT * REPLACE (
        CASE WHEN order_id % 14 = 7 THEN order_purchase_timestamp + INTERVAL 400 DAY ELSE order_purchase_timestamp END
          AS order_purchase_timestamp,
        CASE WHEN order_id % 7 = 0 THEN 'moved' ELSE order_status END AS order_status) FROM o)
    SELECT {sql.ORDER_COLUMNS}, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
      CAST(month(order_purchase_timestamp) AS INTEGER) AS month, TRUE AS indexed,
      (SELECT count(DISTINCT order_id) FROM o) AS index_pairs FROM m""",
)
def merge_by_key_index(spark, d):
    """Orders move to another month and half of them back; an index tells the partitions of a batch's keys.

    ``indexed`` says that a row's key and partition are in the index, ``index_pairs`` counts its entries.
    """
    path, parts = scratch_path(spark, "indexed"), ["year", "month"]
    orders = add_date_parts(src.orders(spark, d), PURCHASED).drop("day")
    merge_into_path(orders, path, ["order_id"], "*", parts, index_buckets=8)
    moved = orders.filter(F.col("order_id") % 7 == 0).withColumn("order_status", F.lit("moved")).drop(*parts)
    late = moved.withColumn(PURCHASED, F.col(PURCHASED) + F.expr("INTERVAL 400 DAY"))
    for batch in (late, moved.filter(F.col("order_id") % 14 == 0)):
        merge_into_path(add_date_parts(batch, PURCHASED).drop("day"), path, ["order_id"], "*", parts)
    table = spark.read.parquet(path)
    index = open_index(spark, path, ["order_id"], parts)
    if index is None:
        return table.withColumns({"indexed": F.lit(True), "index_pairs": F.lit(0).cast("long")})
    pairs = index.entries()
    named = pairs.select(*[F.col(c).alias(f"__{c}") for c in pairs.columns], F.lit(True).alias("indexed"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in pairs.columns])
    found = table.join(named, same, "left").withColumn("indexed", F.coalesce("indexed", F.lit(False)))
    return found.select(*table.columns, "indexed", F.lit(pairs.count()).cast("long").alias("index_pairs"))


@query(
    "merge_null_partition",
    f"""WITH {sql.ORDERS}, m AS (
      SELECT * REPLACE (CASE WHEN order_id % 5 = 0 THEN order_purchase_timestamp WHEN order_id % 5 = 1 THEN NULL
        ELSE order_approved_at END AS order_approved_at) FROM o)
    SELECT {sql.ORDER_COLUMNS}, CAST(year(order_approved_at) AS INTEGER) AS approved_year FROM m""",
)
def merge_null_partition(spark, d):
    """Orders leave the partition of those not approved, others enter it."""
    path = scratch_path(spark, "approved")
    orders = src.orders(spark, d)
    year = F.year("order_approved_at").alias("approved_year")
    merge_into_path(orders.select("*", year), path, ["order_id"], "*", ["approved_year"])
    rest = F.col("order_id") % 5
    changed = orders.filter(rest < 2).withColumn("order_approved_at", F.when(rest == 0, F.col(PURCHASED)))
    merge_into_path(changed.select("*", year), path, ["order_id"], "*", ["approved_year"])
    return spark.read.parquet(path)


@query(
    "declared_table_load",
    f"""WITH {sql.PAYMENTS} SELECT order_id, payment_sequential, payment_installments, payment_value, payment_type FROM p""",
)
def declared_table_load(spark, d):
    """A table declared with required columns and partitions, then loaded."""
    name = scratch_name(spark, "payments_declared")
    columns = {
        "order_id": "bigint",
        "payment_sequential": "int",
        "payment_installments": "int",
        "payment_value": "double",
        "payment_type": "string",
    }
    ddl = create_table_ddl(name, columns, ["order_id"], ["payment_type"], {"purpose": "load"})
    spark.sql(f"{ddl} LOCATION '{scratch_path(spark, name)}'")
    rows = src.order_payments(spark, d).select(*columns)
    rows.write.mode("overwrite").insertInto(name)
    return spark.table(name)


@query(
    "order_events_wide_split",
    f"""WITH {sql.ORDERS}, {sql.ITEMS}, {sql.PAYMENTS}
    SELECT o.order_id, order_status, order_item_id, product_id, price, payment_type, payment_value
    FROM o LEFT JOIN i ON o.order_id = i.order_id LEFT JOIN p ON o.order_id = p.order_id""",
)
def order_events_wide_split(spark, d):
    """``order_events_wide`` with every order of more than three children joined apart."""
    wide = joins.order_fan_out(
        src.orders(spark, d), src.order_items(spark, d), src.order_payments(spark, d), hot_rows=3
    )
    return wide.select(
        "order_id", "order_status", "order_item_id", "product_id", "price", "payment_type", "payment_value"
    )
