"""DuckDB SQL of the registered queries, on the raw tables."""

from __future__ import annotations

ORDERS = """o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'created'
      WHEN 'P' THEN 'processing' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
    CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
    CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date,
    o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
  FROM orders)"""

SHIPPED = """s AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'created'
      WHEN 'P' THEN 'processing' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
    first_ship AS order_delivered_carrier_date,
    last_ship AS order_delivered_customer_date,
    o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""

ITEMS = """i AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
    round(l_quantity * l_tax, 2) AS freight_value
  FROM lineitem)"""

PAYMENTS = """p AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential,
    CASE o_orderpriority[1] WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card'
      WHEN '3' THEN 'voucher' WHEN '4' THEN 'boleto' WHEN '5' THEN 'not_defined' END AS payment_type,
    CAST(o_orderpriority[1] AS INTEGER) AS payment_installments,
    o_totalprice AS payment_value
  FROM orders)"""

REVIEWS = """r AS (
  SELECT d.doc_id AS order_id,
    CASE WHEN toxic = 1 THEN left(md5(CAST(d.doc_id AS VARCHAR)), 8)
      ELSE md5(CAST(d.doc_id AS VARCHAR)) END AS review_id,
    TIMESTAMP '2017-01-01' + to_minutes(d.doc_id % 525600) + to_seconds(n_chars) AS review_answer_timestamp,
    text AS review_comment_message, source AS review_comment_title,
    TIMESTAMP '2017-01-01' + to_minutes(d.doc_id % 525600) AS review_creation_date,
    quality * 4 + 1 AS review_score
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

CITIES = """g AS (
  SELECT c_nationkey AS geolocation_zip_code_prefix,
    CASE n_regionkey WHEN 1 THEN 'são paulo' WHEN 2 THEN 'sao paulo'
      WHEN 3 THEN 'santa bárbara d''oeste' ELSE lower(n_name) END AS geolocation_city,
    c_mktsegment AS geolocation_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ORDER_COLUMNS = (
    "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date"
)
ITEM_COLUMNS = (
    "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value"
)

WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def money(expression: str) -> str:
    """Exact sum of cents, as a double."""
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


def merged(target: str, source: str, keys: list[str], rest: list[str], update: list[str], insert: bool = True) -> str:
    """The content of ``target`` after a merge, as a left join and an anti join."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    hit = f"s.{keys[0]} IS NOT NULL"
    columns = [f"t.{k} AS {k}" for k in keys]
    columns += [f"CASE WHEN {hit} THEN s.{c} ELSE t.{c} END AS {c}" if c in update else f"t.{c} AS {c}" for c in rest]
    text = f"SELECT {', '.join(columns)} FROM {target} t LEFT JOIN {source} s ON {on}"
    if insert:
        both = ", ".join(f"s.{c}" for c in keys + rest)
        text += f"\nUNION ALL SELECT {both} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"
    return text


def check_rows(source: str, name: str, constraints: list[tuple[str, str]], level: str = "Error") -> str:
    """Check result rows from (label, ratio SQL) pairs over one CTE."""
    union = "\nUNION ALL ".join(
        f"SELECT '{label}' AS constraint_name, CAST(({ratio}) AS DOUBLE) AS value FROM {source}"
        for label, ratio in constraints
    )
    return f"""SELECT '{name}' AS "check", '{level}' AS check_level,
      CASE WHEN bool_and(coalesce(value = 1, false)) OVER () THEN 'Success' ELSE '{level}' END AS check_status,
      constraint_name AS "constraint",
      CASE WHEN value = 1 THEN 'Success' ELSE 'Failure' END AS constraint_status,
      round(value, 9) AS value
    FROM ({union})"""


def complete(column: str) -> tuple[str, str]:
    return f"Completeness({column})", f"count({column}) / count(*)"


def unique(column: str, source: str) -> tuple[str, str]:
    ratio = (
        f"SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n) FROM "
        f"(SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"
    )
    return f"Uniqueness({column})", f"any_value(({ratio}))"


def contained(column: str, values: list[str]) -> tuple[str, str]:
    listed = ", ".join(f"'{v}'" for v in values)
    return (
        f"Containment({column},{','.join(values)})",
        f"avg(CASE WHEN {column} IS NULL OR {column} IN ({listed}) THEN 1 ELSE 0 END)",
    )


def positive(column: str) -> tuple[str, str]:
    return f"Positive({column})", f"avg(CASE WHEN coalesce({column}, 1) > 0 THEN 1 ELSE 0 END)"


def typed(column: str, kind: str, holds: bool = True) -> tuple[str, str]:
    # The column types of the tables decide: all non-null values have the class or none has.
    hit = 1 if holds else 0
    return f"DataType({column},{kind})", f"coalesce(avg(CASE WHEN {column} IS NOT NULL THEN {hit} END), 0)"


def profile_rows(source: str, columns: list[tuple[str, str, bool]]) -> str:
    """Exact profile measures from (column, class, numeric) triples."""
    parts = []
    for column, kind, numeric in columns:
        v = f"CAST({column} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        exact = f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{column}' AS \"column\", CASE WHEN count({column}) = 0 THEN 'Unknown' ELSE '{kind}' END AS data_type,"
            f" count(*) AS n_rows, count({column}) AS n_non_null,"
            f" round(count({column}) / nullif(count(*), 0), 9) AS completeness,"
            f" min({v}) AS min, max({v}) AS max, round(avg({v}), 4) AS mean,"
            f" round({exact}, 2) AS sum, round(stddev_pop({v}), 4) AS std_dev FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


def summary_rows(source: str, columns: list[tuple[str, str | None]]) -> str:
    """Frame summary from (column, numeric SQL or None) pairs."""
    parts = []
    for column, value in columns:
        v = value or "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{column}' AS \"column\", count({column}) AS count,"
            f" count(*) - count({column}) AS null_count, round(avg({v}), 2) AS mean,"
            f" round(stddev_samp({v}), 2) AS std, round(min({v}), 3) AS min, round(max({v}), 3) AS max FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


def state_at(orders: str, at: str) -> str:
    """Order state at a time from the wide rows, stage by stage."""
    stages = [
        ("order_approved_at", "'approved'"),
        ("order_delivered_carrier_date", "'shipped'"),
        ("order_delivered_customer_date", "'delivered'"),
        ("order_estimated_delivery_date", "order_status"),
    ]
    events = "\nUNION ALL ".join(
        f"SELECT order_id, {i + 1} AS ordinal, {c} AS happened, {status} AS status FROM {orders} "
        f"WHERE {c} <= TIMESTAMP '{at}' AND {c} >= order_purchase_timestamp"
        for i, (c, status) in enumerate(stages)
    )
    return f"""
    SELECT o2.order_id, o2.customer_id, coalesce(last.status, 'created') AS order_status,
      o2.order_purchase_timestamp,
      max(CASE WHEN e.ordinal = 1 THEN e.happened END) AS order_approved_at,
      max(CASE WHEN e.ordinal = 2 THEN e.happened END) AS order_delivered_carrier_date,
      max(CASE WHEN e.ordinal = 3 THEN e.happened END) AS order_delivered_customer_date,
      o2.order_estimated_delivery_date
    FROM {orders} o2
    LEFT JOIN (
      SELECT order_id, status FROM ({events})
      QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY happened DESC, ordinal DESC) = 1
    ) last ON o2.order_id = last.order_id
    LEFT JOIN ({events}) e ON o2.order_id = e.order_id
    WHERE o2.order_purchase_timestamp <= TIMESTAMP '{at}'
    GROUP BY ALL"""
