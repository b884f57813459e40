"""The raw sources: layout, schema, keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cartwright.schema import struct
from cartwright.sources.parquet import read_partitioned, read_table


@dataclass(frozen=True)
class SourceSpec:
    name: str
    description: str
    columns: str
    keys: tuple[str, ...]
    path: str
    partition_col: str | None = None
    batched: bool = False

    @property
    def schema(self) -> StructType:
        return struct(self.columns)

    @property
    def has_watermark(self) -> bool:
        return "ingested_at" in self.schema.fieldNames()

    def location(self, base: str, batch: int | None = None) -> str:
        return f"{base.rstrip('/')}/{self.path.format(batch=batch)}"

    def read(self, spark: SparkSession, base: str, batch: int | None = None) -> DataFrame:
        where = self.location(base, batch)
        if self.partition_col:
            return read_partitioned(spark, where, self.partition_col, self.schema)
        return read_table(spark, where, self.schema)


_LOAD_COLUMNS = "ingested_at string, batch_id string"
_PERSON = (
    "full_name string, email string, phone string, gender string, date_of_birth string,"
    " city string, segment string, referral_code string, is_active boolean"
)
_PRODUCT = (
    "sku string, product_name string, category string, brand string, cost_price double,"
    " selling_price double, weight_gram long, is_active boolean"
)
_VALIDITY = "valid_from string, valid_to string, is_current boolean, updated_at string"

_SPECS = (
    SourceSpec(
        "fact_orders",
        "Order headers",
        "order_id long, customer_id long, store_id long, order_date string, status string,"
        " gross_amount double, discount_total double, net_amount double, channel string,"
        f" shipping_city string, updated_at string, {_LOAD_COLUMNS}, source string",
        ("order_id",),
        "fact_orders",
        "order_date_partition",
    ),
    SourceSpec(
        "fact_order_items",
        "Order lines",
        "item_id string, order_id long, product_id long, quantity long, unit_price double,"
        f" discount double, subtotal double, {_LOAD_COLUMNS}",
        ("item_id",),
        "fact_order_items.parquet",
    ),
    SourceSpec(
        "fact_payments",
        "Payments; an order may have several",
        "payment_id long, order_id long, amount double, payment_method string,"
        f" payment_date string, {_LOAD_COLUMNS}",
        ("payment_id",),
        "fact_payments",
        "payment_date_partition",
    ),
    SourceSpec(
        "fact_events",
        "Clickstream; duplicates are removed at staging",
        "event_id string, session_id string, customer_id double, product_id double,"
        " event_type string, event_ts string, channel string, device string,"
        f" funnel_stage long, {_LOAD_COLUMNS}",
        (),
        "fact_events",
        "event_date_partition",
    ),
    SourceSpec(
        "dim_customers",
        "Customer versions with validity ranges",
        f"customer_key long, customer_id long, {_PERSON}, {_VALIDITY}, {_LOAD_COLUMNS}",
        ("customer_key",),
        "dim_customers.parquet",
    ),
    SourceSpec(
        "dim_products",
        "Product versions with validity ranges",
        f"product_key long, product_id long, {_PRODUCT}, {_VALIDITY}",
        ("product_key",),
        "dim_products.parquet",
    ),
    SourceSpec(
        "dim_stores",
        "Stores",
        "store_id long, store_name string, channel_type string, platform string, city string,"
        " region string, opened_date string, is_active boolean",
        ("store_id",),
        "dim_stores.parquet",
    ),
    SourceSpec(
        "raw_returns",
        "Return requests in mixed currencies",
        "return_ref string, order_id long, return_date string, reason string,"
        " refund_amount double, currency string, refund_method string, ingested_at string",
        (),
        "raw_returns.parquet",
    ),
    SourceSpec(
        "raw_inventory_feed",
        "Weekly stock levels with a JSON column",
        "snapshot_date string, warehouse_id string, product_id long, sku string,"
        " qty_on_hand long, qty_reserved long, reorder_point long, metadata string",
        (),
        "raw_inventory_feed.parquet",
    ),
    SourceSpec(
        "raw_customers_current",
        "Latest state of every customer, no history",
        f"customer_id long, {_PERSON}, updated_at string",
        ("customer_id",),
        "snapshots/batch_{batch}/raw_customers_current.parquet",
        batched=True,
    ),
    SourceSpec(
        "raw_products_current",
        "Latest state of every product, no history",
        f"product_id long, {_PRODUCT}, updated_at string",
        ("product_id",),
        "snapshots/batch_{batch}/raw_products_current.parquet",
        batched=True,
    ),
)

SOURCES: dict[str, SourceSpec] = {spec.name: spec for spec in _SPECS}
