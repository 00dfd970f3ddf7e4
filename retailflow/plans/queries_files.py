"""Source, sink, catalog, day-load, BI and translation queries.

They write what they derive from the sample tables below the session's scratch
folder and read it back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from retailflow.functions.text import PROMPT_PREFIX, prompt, translate_columns
from retailflow.functions.time import month_text, next_day
from retailflow.model import DATE_PARTS, FACTS, ORDER_ITEMS
from retailflow.operators.layout import bucketed
from retailflow.operators.merge import merge
from retailflow.operators.slices import add_date_parts, partition_slice
from retailflow.plans import lake as lakes
from retailflow.plans import oracles as sql
from retailflow.plans.bi import build_bi_tables, translate_month
from retailflow.plans.catalogue import query
from retailflow.plans.queries_batch import (
    DAY,
    ITEM_REST,
    ITEMS_BATCH,
    PURCHASED,
    items_batch,
    money,
)
from retailflow.session import scratch_name, scratch_path, widen
from retailflow.sinks.landing import write_csv
from retailflow.sinks.tables import (
    clear_target,
    create_table,
    path_exists,
    refresh_table,
    replicate,
    write_table,
)
from retailflow.sources import files
from retailflow.sources import sample_tables as src
from retailflow.sources.tables import describe_table, read_table_or_empty, register_federated

ORDERS_DDL = """order_id bigint, customer_id bigint, order_status string,
    order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
    order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
    order_estimated_delivery_date timestamp_ntz"""


# --- sources -----------------------------------------------------------------
@query("landing_csv_scan", f"WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o")
def landing_csv_scan(spark, d):
    path = scratch_path(spark, "orders_csv")
    orders = src.orders(spark, d)
    # Written in another column order: the scan binds columns by header.
    write_csv(orders.select(*reversed(orders.columns)), path)
    return files.read_csv_table(spark, path, ORDERS_DDL, multiline=False)


@query(
    "landing_mixed_headers",
    f"""WITH {sql.ORDERS} SELECT order_id, customer_id, CASE WHEN order_id % 3 <> 2 THEN order_status END AS order_status,
      order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
      order_estimated_delivery_date FROM o""",
)
def landing_mixed_headers(spark, d):
    """Files in two column orders, and files that lack a column, as one table."""
    path = scratch_path(spark, "orders_mixed")
    orders = src.orders(spark, d)
    part = F.pmod("order_id", F.lit(3))
    write_csv(orders.filter(part == 0), path)
    write_csv(orders.filter(part == 1).select(*reversed(orders.columns)), path, mode="append")
    write_csv(orders.filter(part == 2).drop("order_status"), path, mode="append")
    return files.read_csv_table(spark, path, ORDERS_DDL, multiline=False)


@query(
    "landing_rejects",
    f"""WITH {sql.PAYMENTS}, m AS (SELECT *, CAST(order_id AS VARCHAR) AS id,
      coalesce(payment_type, '') AS kind, coalesce(CAST(payment_installments AS VARCHAR), '') AS parts FROM p)
    SELECT CASE WHEN order_id % 7 NOT IN (1, 2, 3, 4) THEN order_id END AS order_id,
      CASE WHEN order_id % 7 NOT IN (1, 2, 3, 4) THEN payment_type END AS payment_type,
      CASE WHEN order_id % 7 NOT IN (1, 2, 3, 4) THEN payment_installments END AS payment_installments,
      CASE order_id % 7 WHEN 1 THEN 'type: payment_installments' WHEN 2 THEN 'fields' WHEN 3 THEN 'fields'
        WHEN 4 THEN 'type: order_id, payment_installments' END AS reason,
      CASE order_id % 7 WHEN 1 THEN id || ',' || kind || ',many' WHEN 2 THEN id || ',' || kind
        WHEN 3 THEN id || ',' || kind || ',' || parts || ',more' WHEN 4 THEN 'x' || id || ',' || kind || ',1.5' END AS record
    FROM m""",
)
def landing_rejects(spark, d):
    """Payments whose files hold short, long and mistyped records: rows and rejects, each with its reason."""
    path = scratch_path(spark, "broken_csv")
    pays = src.order_payments(spark, d)
    columns = ("order_id", "payment_type", "payment_installments")
    key, kind, parts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)
    rest = F.pmod("order_id", F.lit(7))
    line = (
        F.when(rest == 1, F.concat_ws(",", key, kind, F.lit("many")))
        .when(rest == 2, F.concat_ws(",", key, kind))
        .when(rest == 3, F.concat_ws(",", key, kind, parts, F.lit("more")))
        .when(rest == 4, F.concat_ws(",", F.concat(F.lit("x"), key), kind, F.lit("1.5")))
        .otherwise(F.concat_ws(",", key, kind, parts))
    )
    names = "order_id,payment_type,payment_installments"
    # The first row of every task carries the header of its file.
    starts = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    pays.select(F.when(starts, F.concat(F.lit(names + "\n"), line)).otherwise(line)).write.text(f"{path}/csv")
    head = spark.createDataFrame([(names,)], "value string")
    head.write.mode("append").text(f"{path}/csv")  # a file of nothing but its header
    ddl = "order_id bigint, payment_type string, payment_installments int"
    rows, rejects = files.read_csv_checked(spark, f"{path}/csv", ddl, multiline=False)
    nothing = [F.lit(None).cast("string").alias(c) for c in ("reason", "record")]
    blank = [F.lit(None).cast(k).alias(c) for c, k in rows.dtypes]
    return rows.select("*", *nothing).unionByName(rejects.select(*blank, "reason", "record"))


@query(
    "reviews_multiline_csv",
    f"""WITH {sql.REVIEWS} SELECT order_id, review_id, md5(review_comment_message) AS message_md5,
      review_score FROM r""",
)
def reviews_multiline_csv(spark, d):
    path = scratch_path(spark, "reviews_csv")
    write_csv(src.order_reviews(spark, d), path, line_breaks=True)
    ddl = """order_id bigint, review_id string, review_answer_timestamp timestamp_ntz,
        review_comment_message string, review_comment_title string,
        review_creation_date timestamp_ntz, review_score int"""
    read = files.read_csv_table(spark, path, ddl)
    return read.select("order_id", "review_id", F.md5("review_comment_message").alias("message_md5"), "review_score")


@query(
    "inferred_csv_scan",
    f"""WITH {sql.PAYMENTS} SELECT payment_type, count(*) AS n, {sql.money('payment_value')} AS value FROM p GROUP BY 1""",
)
def inferred_csv_scan(spark, d):
    path = scratch_path(spark, "payments_csv")
    write_csv(src.order_payments(spark, d), path)
    read = files.read_csv_table(spark, path, infer=True, multiline=False)
    return read.groupBy("payment_type").agg(F.count(F.lit(1)).alias("n"), money("payment_value").alias("value"))


@query(
    "headerless_csv_scan",
    "SELECT CAST(c_nationkey AS VARCHAR) AS _c2, count(*) AS n FROM customer GROUP BY 1",
)
def headerless_csv_scan(spark, d):
    path = scratch_path(spark, "customers_csv")
    write_csv(src.table(spark, d, "customer"), path, header=False)
    places = ", ".join(f"_c{n} string" for n in range(5))
    read = files.read_csv_table(spark, path, places, header=False, multiline=False)
    return read.groupBy("_c2").agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_stack_scan",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
      CAST(sum(o_custkey) AS BIGINT) AS customer_sum FROM orders GROUP BY 1""",
)
def text_stack_scan(spark, d):
    root = scratch_path(spark, "orders_by_year")
    yearly = src.orders(spark, d).withColumn("folder", F.year(PURCHASED))
    yearly.write.partitionBy("folder").option("header", True).csv(root)
    if yearly.isEmpty():  # no folder to read
        return spark.createDataFrame([], "year int, n bigint, customer_sum bigint")
    stack = files.read_text_stack(spark, f"{root}/folder=*")
    return stack.groupBy(F.year(F.try_to_timestamp(PURCHASED)).alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("customer_id").try_cast("bigint")).alias("customer_sum")
    )


@query(
    "document_scan",
    """SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1""",
)
def document_scan(spark, d):
    path = scratch_path(spark, "documents_json")
    docs = src.table(spark, d, "documents").select(F.md5("text").alias("_id"), "doc_id", "lang", "text")
    docs.write.json(path)
    read = files.read_documents(spark, "_id string, doc_id bigint, lang string, text string", path)
    return read.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query(
    "schema_crawl",
    """SELECT * FROM (VALUES (0, 'order_id', 'int'), (1, 'order_item_id', 'int'), (2, 'product_id', 'int'),
      (3, 'seller_id', 'int'), (4, 'shipping_limit_date', 'timestamp'), (5, 'price', 'double'),
      (6, 'freight_value', 'double')) t(position, column_name, data_type)""",
)
def schema_crawl(spark, d):
    path = scratch_path(spark, "items_csv")
    write_csv(src.order_items(spark, d), path)
    return files.crawl_schema(spark, path)


@query("crawled_table_scan", f"WITH {sql.ITEMS} SELECT * FROM i")
def crawled_table_scan(spark, d):
    """The files of a crawled table, read through the catalog."""
    path, name = scratch_path(spark, "items_csv"), scratch_name(spark, "items_crawled")
    items = src.order_items(spark, d)
    write_csv(items, path)
    spark.sql(files.crawl_ddl(spark, path, name))
    return spark.table(name).select(*[F.col(f.name).cast(f.dataType) for f in items.schema.fields])


@query(
    "federated_join",
    """SELECT c_mktsegment AS segment, count(*) AS n_orders, count(DISTINCT doc_id) AS n_documents
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN documents ON doc_id = o_orderkey GROUP BY 1""",
)
def federated_join(spark, d):
    customers, documents = scratch_path(spark, "fed_csv"), scratch_path(spark, "fed_json")
    write_csv(src.table(spark, d, "customer"), customers)
    src.table(spark, d, "documents").select("doc_id", "lang").write.json(documents)
    tag = uuid.uuid4().hex[:8]
    register_federated(
        spark,
        {
            f"db_orders_{tag}": lambda s: src.table(s, d, "orders"),
            f"file_customers_{tag}": lambda s: files.read_csv_table(
                s, customers, "c_custkey bigint, c_mktsegment string", multiline=False
            ),
            f"doc_reviews_{tag}": lambda s: files.read_documents(s, "doc_id bigint, lang string", documents),
        },
    )
    return spark.sql(f"""
        SELECT c_mktsegment AS segment, count(*) AS n_orders, count(DISTINCT doc_id) AS n_documents
        FROM db_orders_{tag} JOIN file_customers_{tag} ON o_custkey = c_custkey
        LEFT JOIN doc_reviews_{tag} ON doc_id = o_orderkey GROUP BY 1""")


@query(
    "table_or_empty",
    f"WITH {sql.ORDERS} SELECT order_status, count(*) AS n FROM o GROUP BY 1",
)
def table_or_empty(spark, d):
    name = scratch_name(spark, "orders_view")
    src.orders(spark, d).createOrReplaceTempView(name)
    present = read_table_or_empty(spark, name, ORDERS_DDL)
    missing = read_table_or_empty(spark, name + "_missing", ORDERS_DDL)
    return present.unionByName(missing).groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "describe_tables",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns, count(*) AS n_rows FROM {t}"
        for t in src.TABLES
    ),
)
def describe_tables(spark, d):
    rows = None
    for name in src.TABLES:
        df = src.table(spark, d, name)
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "n_rows"
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query(
    "column_catalogue",
    "\nUNION ALL ".join(
        f"""SELECT '{t}' AS table_name, column_name, n_present FROM (UNPIVOT (
          SELECT count(COLUMNS(*)) AS "\\0" FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE n_present)"""
        for t in src.TABLES
    ),
)
def column_catalogue(spark, d):
    """Described columns of every table with their number of values."""
    rows = None
    for name in src.TABLES:
        view = scratch_name(spark, name)
        df = src.table(spark, d, name)
        df.createOrReplaceTempView(view)
        columns = [r["column_name"] for r in describe_table(spark, view).collect()]
        counts = df.agg(*[F.count(c).alias(c) for c in columns])
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_present")) for c in columns]
        one = counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*pairs)))
        rows = one if rows is None else rows.unionByName(one)
    return rows


# --- tables and layout -------------------------------------------------------
@query(
    "partition_slice_orders",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS}, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
      CAST(month(order_purchase_timestamp) AS INTEGER) AS month, CAST(day(order_purchase_timestamp) AS INTEGER) AS day
    FROM o WHERE CAST(order_purchase_timestamp AS DATE) = DATE '{DAY}'""",
)
def partition_slice_orders(spark, d):
    name = scratch_name(spark, "orders_by_day")
    orders = add_date_parts(src.orders(spark, d), PURCHASED)
    path = scratch_path(spark, "orders_by_day")
    create_table(orders, name, DATE_PARTS, path=path)
    return partition_slice(spark.table(name), DAY)


@query(
    "replaced_table",
    f"WITH {sql.ORDERS} SELECT order_status, count(*) AS n FROM o GROUP BY 1",
)
def replaced_table(spark, d):
    name, path = scratch_name(spark, "orders_replaced"), scratch_path(spark, "orders_replaced")
    orders = src.orders(spark, d)
    create_table(orders.withColumn("order_status", F.lit("stale")), name, path=path)
    create_table(orders.select("order_id"), name, if_absent=True)
    create_table(orders, name, path=path, replace=True)
    return spark.table(name).groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cleared_table_reload",
    "SELECT c_mktsegment AS customer_city, count(*) AS n FROM customer GROUP BY 1",
)
def cleared_table_reload(spark, d):
    """A table is loaded, emptied and loaded again; a dropped one is gone."""
    name = scratch_name(spark, "customers")
    customers = src.customers(spark, d)
    create_table(customers, name, path=scratch_path(spark, name))
    create_table(customers, name + "_old", path=scratch_path(spark, name))
    clear_target(spark, name, "delete")
    customers.write.mode("append").insertInto(name)
    clear_target(spark, name + "_old", "drop")
    old = read_table_or_empty(spark, name + "_old", "customer_city string").select("customer_city")
    both = spark.table(name).select("customer_city").unionByName(old)
    return both.groupBy("customer_city").agg(F.count(F.lit(1)).alias("n"))


@query(
    "refreshed_dimension",
    """SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
      c_mktsegment AS customer_city, 'BR' AS customer_state FROM customer""",
)
def refreshed_dimension(spark, d):
    path = scratch_path(spark, "customers")
    customers = src.customers(spark, d)
    refresh_table(customers.withColumn("customer_city", F.lit("old")), path)
    refresh_table(customers, path)
    refresh_table(customers.filter("customer_id IS NULL"), path)
    return spark.read.parquet(path)


@query(
    "full_load_copy_counts",
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in src.TABLES),
)
def full_load_copy_counts(spark, d):
    root = scratch_path(spark, "copy")
    names = {f"public.{t}": t for t in src.TABLES}
    done = replicate(
        lambda t: src.table(spark, d, names[t]),
        [*names, "audit.log"],
        lambda df, t: write_table(df, f"{root}/{names[t]}"),
        include="public.%",
        stop_on_error=True,
    )
    rows = None
    for name in done:
        one = spark.read.parquet(f"{root}/{names[name]}").agg(F.count(F.lit(1)).alias("n_rows"))
        one = one.select(F.lit(names[name]).alias("table_name"), "n_rows")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query(
    "bucketed_join_counts",
    f"""WITH {sql.ORDERS}, {sql.ITEMS} SELECT order_status, count(*) AS n_items, {sql.money('price')} AS price
    FROM o JOIN i ON o.order_id = i.order_id GROUP BY 1""",
)
def bucketed_join_counts(spark, d):
    parts = []
    for df in (src.orders(spark, d), src.order_items(spark, d)):
        parts.append(bucketed(df, scratch_name(spark, "bucketed"), "order_id", 8, scratch_path(spark, "bucketed")))
    joined = parts[0].join(parts[1], "order_id")
    return joined.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_items"), money("price").alias("price"))


@query(
    "staged_merge_tables",
    f"WITH {ITEMS_BATCH} " + sql.merged("t", "s", ORDER_ITEMS.keys, ITEM_REST, ITEM_REST),
)
def staged_merge_tables(spark, d):
    target, source = items_batch(spark, d)
    staging = scratch_path(spark, "staging")
    write_table(source, staging)
    return merge(target, spark.read.parquet(staging), ORDER_ITEMS.keys)


# --- day loads ---------------------------------------------------------------
def _loaded(spark, d, name: str, runs: int = 1):
    """A lakehouse table after loads of all its days, from the first to the last, and of rows without a day."""
    lake = lakes.Lake(scratch_path(spark, "lake"), partition_by=("year", "month"))
    tables = src.retail_tables(spark, d)
    time = FACTS[name].slice_time
    days = tables[name if time else "orders"].agg(
        *[F.date_format(f(time or PURCHASED), "yyyy-MM-dd") for f in (F.min, F.max)]
    )
    first, last = days.first()
    for _ in range(runs):
        if first:
            lakes.backfill(tables, lake, name, first, next_day(last))
        lakes.load_undated(tables, lake, name)
    if path_exists(spark, lake.table(name)):
        return lake, spark.read.parquet(lake.table(name))
    return lake, lakes.extract_undated(tables, name)  # no rows at all


DAY_PARTS = """CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month, CAST(day({t}) AS INTEGER) AS day"""


@query(
    "lakehouse_orders",
    f"WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS}, {DAY_PARTS.format(t='order_purchase_timestamp')} FROM o",
)
def lakehouse_orders(spark, d):
    """Checked and merged twice over all days: the second load changes nothing."""
    _, table = _loaded(spark, d, "orders", runs=2)
    return table


@query(
    "lakehouse_payments",
    f"""WITH {sql.ORDERS}, {sql.PAYMENTS} SELECT p.*, {DAY_PARTS.format(t='order_purchase_timestamp')}
    FROM p JOIN o ON p.order_id = o.order_id""",
)
def lakehouse_payments(spark, d):
    return _loaded(spark, d, "order_payments")[1]


@query(
    "lakehouse_payments_by_month",
    f"""WITH {sql.ORDERS}, {sql.PAYMENTS} SELECT strftime(order_purchase_timestamp, '%Y-%m') AS yearmonth,
      count(*) AS n, {sql.money('payment_value')} AS value FROM p JOIN o ON p.order_id = o.order_id GROUP BY 1""",
)
def lakehouse_payments_by_month(spark, d):
    _, table = _loaded(spark, d, "order_payments")
    month = month_text(F.make_date("year", "month", F.lit(1)))
    return table.groupBy(month.alias("yearmonth")).agg(
        F.count(F.lit(1)).alias("n"), money("payment_value").alias("value")
    )


@query(
    "lakehouse_reviews",
    f"""WITH {sql.REVIEWS} SELECT order_id, review_id, review_answer_timestamp, md5(review_comment_message) AS message_md5,
      review_comment_title, review_creation_date, review_score, {DAY_PARTS.format(t='review_creation_date')} FROM r
    WHERE review_score IS NOT NULL AND length(review_id) = 32""",
)
def lakehouse_reviews(spark, d):
    _, table = _loaded(spark, d, "order_reviews")
    digest = F.md5("review_comment_message").alias("message_md5")
    return table.select(*[digest if c == "review_comment_message" else F.col(c) for c in table.columns])


@query(
    "warehouse_orders",
    f"""WITH {sql.ORDERS} SELECT {sql.ORDER_COLUMNS} FROM o
    WHERE order_purchase_timestamp >= '1996-01-01'""",
)
def warehouse_orders(spark, d):
    """The days from 1996 on, then one of them again."""
    lake, table = _loaded(spark, d, "orders")
    last = table.agg(F.date_format(F.max(PURCHASED), "yyyy-MM-dd")).first()[0]
    if last:
        lakes.warehouse_day(spark, lake, "orders", "1996-01-01", end=next_day(last))
    lakes.warehouse_day(spark, lake, "orders", DAY)
    if not path_exists(spark, lake.warehouse("orders")):
        return table.drop(*DATE_PARTS).limit(0)
    return spark.read.parquet(lake.warehouse("orders")).drop(*DATE_PARTS)


# --- BI and translation ------------------------------------------------------
BI_RANGE = ("1997-01-01", "1998-08-31")


@query(
    "bi_tables_counts",
    f"""WITH {sql.ORDERS}, {sql.ITEMS}, {sql.REVIEWS}
    SELECT 'orders' AS table_name, count(*) AS n_rows FROM o WHERE order_purchase_timestamp BETWEEN '{BI_RANGE[0]}' AND '{BI_RANGE[1]}'
    UNION ALL SELECT 'order_items', count(*) FROM i WHERE shipping_limit_date BETWEEN '{BI_RANGE[0]}' AND '{BI_RANGE[1]}'
    UNION ALL SELECT 'order_reviews', count(*) FROM r WHERE review_creation_date BETWEEN '{BI_RANGE[0]}' AND '{BI_RANGE[1]}'
    UNION ALL SELECT 'order_payments', count(*) FROM orders UNION ALL SELECT 'customers', count(*) FROM customer
    UNION ALL SELECT 'sellers', count(*) FROM supplier UNION ALL SELECT 'products', count(*) FROM part
    UNION ALL SELECT 'geolocation', count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def bi_tables_counts(spark, d):
    rows = None
    for name, df in build_bi_tables(src.retail_tables(spark, d), *BI_RANGE).items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def echo():
    """Stands in for the translation model: a function that returns the prompts.

    Built here, so that it travels to the executors by value.
    """
    return lambda prompts: list(prompts)


@query(
    "translate_reviews_stub",
    f"""SELECT doc_id, CASE WHEN text = '' THEN text ELSE '{PROMPT_PREFIX}' || text END AS text,
      CASE WHEN source = '' THEN source ELSE '{PROMPT_PREFIX}' || source END AS source FROM documents""",
)
def translate_reviews_stub(spark, d):
    docs = widen(src.table(spark, d, "documents").select("doc_id", "text", "source"))
    return translate_columns(docs, ["text", "source"], translate=echo())


@query(
    "translated_columns_added",
    f"""SELECT doc_id, source, '{PROMPT_PREFIX}' || source AS translated_source FROM documents""",
)
def translated_columns_added(spark, d):
    docs = src.table(spark, d, "documents").select("doc_id", "source")
    return translate_columns(docs, ["source"], translate=echo(), prefix="translated_")


@query(
    "translation_prompts",
    f"""SELECT conv_id, turn, CASE WHEN length(text) > 0 THEN '{PROMPT_PREFIX}' || text ELSE text END AS prompt FROM conversations""",
)
def translation_prompts(spark, d):
    return src.table(spark, d, "conversations").select("conv_id", "turn", prompt("text").alias("prompt"))


@query(
    "translate_month",
    f"""WITH {sql.REVIEWS} SELECT order_id, '{PROMPT_PREFIX}' || review_comment_title AS review_comment_title,
      md5('{PROMPT_PREFIX}' || review_comment_message) AS message_md5,
      (SELECT count(*) FROM r WHERE strftime(review_creation_date, '%Y-%m') = '2017-01') AS n_translated
    FROM r WHERE strftime(review_creation_date, '%Y-%m') = '2017-01'""",
)
def translate_month_query(spark, d):
    path = scratch_path(spark, "translated")
    n = translate_month(src.order_reviews(spark, d), "2017-01", path, translate=echo())
    ddl = "order_id bigint, review_comment_title string, review_comment_message string"
    read = files.read_csv_table(spark, path, ddl)
    return read.select(
        "order_id",
        "review_comment_title",
        F.md5("review_comment_message").alias("message_md5"),
        F.lit(n).cast("bigint").alias("n_translated"),
    )
