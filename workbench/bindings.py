"""Driver tables read as the raw sources.

Each binding is one SELECT, valid in Spark and in the oracle engine alike;
``@name`` stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cartwright.schema import struct

TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
    " l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}

_PERSON = """'c' || CAST(c_custkey AS STRING) || '@mail.test' AS email,
  CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE '08' || CAST(c_custkey AS STRING) END AS phone,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'prefer_not_to_say' END AS gender,
  CAST(DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INT) AS STRING) AS date_of_birth,"""

_REFERRAL = "CASE WHEN c_custkey % 5 < 3 THEN NULL ELSE 'REF-' || CAST(c_custkey AS STRING) END AS referral_code,"

_DISCOUNT = (
    "CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice * 1.1"
    " ELSE o_totalprice * (o_orderkey % 4) * 0.05 END"
)


def _customer_versions(key: int, email: str, city: str, segments: str, rest: str, where: str = "") -> str:
    person = _PERSON.replace("'c' || CAST(c_custkey AS STRING) || '@mail.test'", email)
    return f"""SELECT c_custkey * 2 + {key} AS customer_key, c_custkey AS customer_id, c_name AS full_name,
  {person} {city} AS city, {segments} AS segment, {_REFERRAL} TRUE AS is_active,
  {rest}, 'batch_001' AS batch_id
FROM @customer JOIN @nation ON c_nationkey = n_nationkey {where}"""


_EMAIL = (
    "CASE WHEN c_custkey % 40 = 0 THEN 'bad-address'"
    " ELSE 'c' || CAST(c_custkey AS STRING) || '@mail.test' END"
)


def _customers_current(city: str, segment: str, active: str, updated: str, where: str = "") -> str:
    return f"""SELECT c_custkey AS customer_id, c_name AS full_name, {_PERSON}
  {city} AS city, {segment} AS segment, {_REFERRAL} {active} AS is_active, {updated} AS updated_at
FROM @customer JOIN @nation ON c_nationkey = n_nationkey {where}"""


def _products_current(factor: str, updated: str) -> str:
    return f"""SELECT p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS STRING) AS sku,
  p_name AS product_name, p_type AS category, p_brand AS brand,
  p_retailprice * (p_partkey % 20 + 1) * 80 AS cost_price,
  p_retailprice * (p_partkey % 20 + 1) * {factor} AS selling_price,
  p_size * 100 AS weight_gram, TRUE AS is_active, {updated} AS updated_at
FROM @part"""


_MOVED = "CASE WHEN c_custkey % 6 = 0 THEN 'Moved-' || n_name ELSE n_name END"
_FIRST, _SECOND, _THIRD = "'2023-01-15 00:00:00'", "'2023-09-01 00:00:00'", "'2024-06-01 00:00:00'"
_UPGRADED = "c_custkey % 3 = 0 OR c_custkey % 20 = 19"

BINDINGS = {
    "raw_orders": f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 5 + 1 AS store_id,
  CAST(o_orderdate AS STRING) AS order_date,
  CASE WHEN o_orderstatus = 'F' THEN ' Completed'
       WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'COMPLETED '
       WHEN o_orderstatus = 'O' THEN 'returned'
       WHEN o_orderkey % 3 = 0 THEN 'Cancelled'
       WHEN o_orderkey % 3 = 1 THEN 'processing' ELSE 'SHIPPED' END AS status,
  o_totalprice AS gross_amount, {_DISCOUNT} AS discount_total, o_totalprice - {_DISCOUNT} AS net_amount,
  CASE o_orderkey % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app' WHEN 2 THEN 'marketplace_a'
       WHEN 3 THEN 'marketplace_b' ELSE 'store_offline' END AS channel,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE n_name END AS shipping_city,
  CAST(o_orderdate AS STRING) AS updated_at, CAST(o_orderdate AS STRING) AS ingested_at,
  'batch_001' AS batch_id, 'synthetic' AS source
FROM @orders JOIN @customer ON o_custkey = c_custkey JOIN @nation ON c_nationkey = n_nationkey""",
    "raw_order_items": """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS item_id,
  CASE WHEN l_orderkey % 50 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS order_id,
  l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
  CASE WHEN l_partkey % 101 = 0 THEN 0.0 ELSE l_extendedprice / l_quantity END AS unit_price,
  l_extendedprice / l_quantity * l_discount AS discount, l_extendedprice * (1 - l_discount) AS subtotal,
  CAST(l_shipdate AS STRING) AS ingested_at, 'batch_001' AS batch_id
FROM @lineitem""",
    "raw_payments": """SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS order_id,
  l_extendedprice * (1 - l_discount) AS amount,
  CASE l_partkey % 8 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'bank_transfer'
       WHEN 3 THEN 'e-wallet_a' WHEN 4 THEN 'e-wallet_b' WHEN 5 THEN 'cod' WHEN 6 THEN 'paylater'
       ELSE 'voucher' END AS payment_method,
  CAST(l_shipdate AS STRING) AS payment_date, CAST(l_shipdate AS STRING) AS ingested_at,
  'batch_001' AS batch_id
FROM @lineitem""",
    "raw_dim_customers": _customer_versions(
        1,
        _EMAIL,
        "n_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'occasional' END",
        "'1994-01-01 00:00:00' AS valid_from,"
        " CASE WHEN c_custkey % 50 = 0 THEN '1998-01-01 02:00:00'"
        " WHEN c_custkey % 10 < 3 THEN '1998-01-01 00:00:00' ELSE NULL END AS valid_to,"
        " c_custkey % 10 >= 3 AS is_current, '1994-01-01 00:00:00' AS updated_at,"
        " '1994-01-01 00:00:00' AS ingested_at",
    )
    + "\nUNION ALL\n"
    + _customer_versions(
        2,
        _EMAIL,
        "'Moved-' || n_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'loyal' ELSE 'vip' END",
        "'1998-01-01 00:00:00' AS valid_from, NULL AS valid_to, TRUE AS is_current,"
        " '1998-01-01 00:00:00' AS updated_at, '1998-01-01 00:00:00' AS ingested_at",
        "WHERE c_custkey % 10 < 3",
    ),
    "raw_dim_products": """SELECT p_partkey * 2 + 1 AS product_key, p_partkey AS product_id,
  ' SKU-' || CAST(p_partkey AS STRING) || ' ' AS sku,
  p_name AS product_name, p_type AS category, p_brand AS brand,
  p_retailprice * (p_partkey % 20 + 1) * 80 AS cost_price,
  p_retailprice * (p_partkey % 20 + 1) * 100 AS selling_price,
  p_size * 100 AS weight_gram, TRUE AS is_active, '1994-01-01 00:00:00' AS valid_from,
  CASE WHEN p_partkey % 3 = 0 THEN '1998-06-01 00:00:00' ELSE NULL END AS valid_to,
  p_partkey % 3 <> 0 AS is_current, '1994-01-01 00:00:00' AS updated_at
FROM @part
UNION ALL
SELECT p_partkey * 2 + 2, p_partkey, ' SKU-' || CAST(p_partkey AS STRING) || ' ', p_name, p_type, p_brand,
  p_retailprice * (p_partkey % 20 + 1) * 80,
  p_retailprice * (p_partkey % 20 + 1) * CASE WHEN p_partkey % 2 = 0 THEN 110 ELSE 85 END,
  p_size * 100, TRUE, '1998-06-01 00:00:01', NULL, TRUE, '1998-06-01 00:00:01'
FROM @part WHERE p_partkey % 3 = 0""",
    "raw_dim_stores": """SELECT s_suppkey AS store_id, s_name AS store_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'offline' ELSE 'online' END AS channel_type,
  CASE s_suppkey % 3 WHEN 0 THEN 'store' WHEN 1 THEN 'web' ELSE 'marketplace' END AS platform,
  n_name AS city, 'region ' || CAST(n_regionkey AS STRING) AS region,
  CAST(DATE '2015-01-01' + CAST(s_suppkey * 17 % 3000 AS INT) AS STRING) AS opened_date, TRUE AS is_active
FROM @supplier JOIN @nation ON s_nationkey = n_nationkey""",
    "raw_returns": """SELECT 'RET-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'
    || CAST(l_suppkey AS STRING) AS return_ref,
  l_orderkey AS order_id, CAST(CAST(l_shipdate AS DATE) AS STRING) AS return_date,
  CASE l_suppkey % 7 WHEN 0 THEN 'Produk rusak' WHEN 1 THEN 'PRODUK TIDAK SESUAI' WHEN 2 THEN 'salah kirim'
       WHEN 3 THEN ' barang CACAT ' WHEN 4 THEN 'Tidak suka' WHEN 5 THEN 'ukuran tidak pas'
       ELSE NULL END AS reason,
  CASE WHEN l_partkey % 10 < 3 THEN l_extendedprice / 15500 ELSE l_extendedprice END AS refund_amount,
  CASE l_partkey % 10 WHEN 0 THEN 'USD' WHEN 1 THEN 'usd' WHEN 2 THEN 'SGD' ELSE 'IDR' END AS currency,
  CASE l_suppkey % 3 WHEN 0 THEN 'original' WHEN 1 THEN 'store_credit' ELSE 'bank_transfer' END
    AS refund_method,
  CAST(l_shipdate AS STRING) AS ingested_at
FROM @lineitem WHERE l_returnflag = 'R'""",
    "raw_events": """SELECT 'e' || CAST(event_id AS STRING) AS event_id,
  CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS session_id,
  CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS customer_id,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2000 END AS product_id,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
       WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout_start'
       ELSE 'checkout_complete' END AS event_type,
  CAST(ts AS STRING) AS event_ts,
  CASE user_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app' ELSE 'marketplace_a' END AS channel,
  CASE WHEN user_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device,
  CAST(ts AS STRING) AS ingested_at, 'batch_001' AS batch_id
FROM (SELECT * FROM @events UNION ALL SELECT * FROM @events WHERE event_id % 100 = 0) e""",
    "raw_inventory_feed": """SELECT
  CAST(DATE '2024-01-07' + CAST(p_partkey % 4 * 7 AS INT) AS STRING) AS snapshot_date,
  CASE p_partkey % 4 WHEN 0 THEN 'WH-A' WHEN 1 THEN 'WH-B' WHEN 2 THEN 'WH-C' ELSE 'WH-D' END AS warehouse_id,
  p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS STRING) AS sku,
  p_partkey % 500 AS qty_on_hand, p_partkey % 50 AS qty_reserved,
  CASE p_partkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 20 ELSE 50 END AS reorder_point,
  '{"last_restock":"' || CAST(DATE '2023-10-01' + CAST(p_partkey % 90 AS INT) AS STRING)
    || '","storage_zone":"' || CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END
    || '","temp_sensitive":' || CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END || '}' AS metadata
FROM @part""",
    "raw_customers_1": _customers_current(
        "n_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'occasional' END",
        "TRUE",
        _FIRST,
        "WHERE c_custkey % 20 <> 19",
    ),
    "raw_customers_2": _customers_current(
        _MOVED,
        "CASE WHEN c_custkey % 3 = 0 THEN 'loyal' WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'occasional' END",
        "TRUE",
        f"CASE WHEN {_UPGRADED} THEN {_SECOND} ELSE {_FIRST} END",
        "WHERE c_custkey % 25 <> 0",
    ),
    "raw_customers_3": _customers_current(
        _MOVED,
        "CASE WHEN c_custkey % 10 = 1 THEN 'churned' WHEN c_custkey % 3 = 0 THEN 'loyal'"
        " WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'occasional' END",
        "c_custkey % 10 <> 1",
        f"CASE WHEN c_custkey % 10 = 1 OR c_custkey % 25 = 0 THEN {_THIRD}"
        f" WHEN {_UPGRADED} THEN {_SECOND} ELSE {_FIRST} END",
    ),
    "raw_products_1": _products_current("100", _FIRST),
    "raw_products_2": _products_current(
        "CASE WHEN p_partkey % 5 = 0 THEN 110 ELSE 100 END",
        f"CASE WHEN p_partkey % 5 = 0 THEN {_SECOND} ELSE {_FIRST} END",
    ),
    "raw_products_3": _products_current(
        "CASE WHEN p_partkey % 5 = 0 THEN 110 WHEN p_partkey % 5 = 1 THEN 90 ELSE 100 END",
        f"CASE WHEN p_partkey % 5 = 1 THEN {_THIRD} WHEN p_partkey % 5 = 0 THEN {_SECOND} ELSE {_FIRST} END",
    ),
}


def bound(name: str, prefix: str) -> str:
    """The binding's text with each driver table under ``prefix`` + its name."""
    return re.sub(rf"@({'|'.join(TABLES)})\b", lambda m: prefix + m[1], BINDINGS[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(struct(TABLES[name])).parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw source over the driver tables of ``sf_dir``."""
    for used in set(re.findall(rf"@({'|'.join(TABLES)})\b", BINDINGS[name])):
        table(spark, sf_dir, used).createOrReplaceTempView(f"workbench_{used}")
    return spark.sql(bound(name, "workbench_"))
