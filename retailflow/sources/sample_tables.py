"""Retail tables derived from a TPC-H-like Parquet folder.

Each function maps whole input tables to the retail model, with ids kept in
their native type so that joins and filters need no casts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Fixed values of the derivation.
STATUS_OF = {"F": "delivered", "O": "created", "P": "processing"}
PAYMENT_OF = {
    "1": "credit_card",
    "2": "debit_card",
    "3": "voucher",
    "4": "boleto",
    "5": "not_defined",
}
ESTIMATE_DAYS = 30
REVIEW_EPOCH = "2017-01-01 00:00:00"
MINUTES_PER_YEAR = 525600
CITY_OF_REGION = {1: "são paulo", 2: "sao paulo", 3: "santa bárbara d'oeste"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _recode(key, mapping: dict):
    chain = F
    for k, v in mapping.items():
        chain = chain.when(key == k, F.lit(v))
    return chain


def _days_after(ts: str, days: int):
    return F.col(ts) + F.expr(f"interval {days} day")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without delivery dates."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _recode(F.col("o_orderstatus"), STATUS_OF).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "O", _days_after("o_orderdate", 1)).alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        _days_after("o_orderdate", ESTIMATE_DAYS).alias("order_estimated_delivery_date"),
    )


def shipped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the first and last ship date of their items as delivery dates."""
    dates = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    base = orders(spark, sf_dir)
    joined = base.join(dates, "order_id", "left")
    return joined.select(
        *[
            F.col("first_ship").alias(c) if c == "order_delivered_carrier_date"
            else F.col("last_ship").alias(c) if c == "order_delivered_customer_date"
            else F.col(c)
            for c in base.columns
        ]
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.round(F.col("l_quantity") * F.col("l_tax"), 2).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        _recode(code, PAYMENT_OF).alias("payment_type"),
        code.cast("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews: scored by label, with some short ids for toxic ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    minutes = F.pmod("doc_id", F.lit(MINUTES_PER_YEAR))
    epoch = F.lit(REVIEW_EPOCH).cast("timestamp_ntz")
    created = F.timestamp_add("MINUTE", minutes, epoch)
    digest = F.md5(F.col("doc_id").cast("string"))
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("order_id"),
        F.when(F.col("toxic") == 1, F.substring(digest, 1, 8)).otherwise(digest).alias("review_id"),
        F.timestamp_add("SECOND", F.col("n_chars"), created).alias("review_answer_timestamp"),
        F.col("text").alias("review_comment_message"),
        F.col("source").alias("review_comment_title"),
        created.alias("review_creation_date"),
        (F.col("quality") * 4 + 1).alias("review_score"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.lit("BR").alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.lit("BR").alias("seller_state"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.col("p_size").alias("product_weight_g"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a city by nation; some regions share one oddly spelt city."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    city = F.coalesce(_recode(F.col("n_regionkey"), CITY_OF_REGION), F.lower("n_name"))
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        city.alias("geolocation_city"),
        F.col("c_mktsegment").alias("geolocation_state"),
    )


RETAIL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "geolocation": geolocation,
}


def retail_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf_dir) for name, make in RETAIL.items()}
