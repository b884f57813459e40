"""Staging: typed, cleaned and flagged raw tables.

A finding becomes a boolean column; rows stay.  The one exception is the
removal of duplicate events.  Text that does not parse as a timestamp or date
becomes NULL here and can be listed with ``checks.check_parsable``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import (
    FX_RATES,
    cohort_by_age,
    flag,
    is_late_arriving,
    payment_method_group,
    price_tier,
    sentence_case,
    to_idr,
    years_between,
)
from cartwright.functions.bands import labelled
from cartwright.operators.dedup import dedup_first
from cartwright.operators.hot import HotKeys, find_hot
from cartwright.operators.jsonflat import flatten_json, flatten_open_json
from cartwright.operators.lookup import lookup_join
from cartwright.operators.neighbours import with_neighbour

# Funnel position of each event type; others are stage 0.
FUNNEL_STAGES = {
    "page_view": 1,
    "product_view": 2,
    "add_to_cart": 3,
    "checkout_start": 4,
    "checkout_complete": 5,
}

# Fixed value: fields of the inventory feed's JSON column.
INVENTORY_METADATA = "last_restock date, storage_zone string, temp_sensitive boolean"


def timestamp_of(column: str) -> Column:
    return F.col(column).try_cast("timestamp_ntz")


def date_of(column: str) -> Column:
    return timestamp_of(column).cast("date")


def funnel_stage(event_type: Column) -> Column:
    return labelled(event_type, FUNNEL_STAGES, 0)


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Typed orders; the raw ``updated_at`` is kept, where there is one, so
    that status changes stay visible to incremental runs."""
    changed = ["updated_at"] if "updated_at" in raw_orders.columns else []
    return raw_orders.select(
        "order_id",
        "customer_id",
        "store_id",
        timestamp_of("order_date").alias("order_ts"),
        date_of("order_date").alias("order_date"),
        F.lower(F.trim("status")).alias("order_status"),
        "channel",
        "shipping_city",
        "gross_amount",
        "discount_total",
        "net_amount",
        flag(F.col("net_amount") < 0).alias("is_negative_order"),
        "ingested_at",
        "batch_id",
        "source",
        *changed,
    )


def stg_order_items(
    raw_items: DataFrame, orders: DataFrame, limits: HotKeys = HotKeys()
) -> DataFrame:
    """Flags items without an order.

    Orders are reduced to distinct ids first, in the shuffle the join needs
    anyway: an order delivered twice must not double its items.
    """
    known = orders.select("order_id").distinct().withColumn("_known", F.lit(True))
    rate = F.when(F.col("unit_price") == 0, F.lit(0.0)).otherwise(F.try_divide("discount", "unit_price"))
    hot = find_hot(raw_items, "order_id", limits)
    return lookup_join(raw_items, known, "order_id", hot).select(
        *raw_items.columns,
        F.col("_known").isNull().alias("is_orphan_record"),
        rate.alias("discount_rate"),
    )


def typed_payments(raw_payments: DataFrame) -> DataFrame:
    return raw_payments.select(
        *raw_payments.columns,
        timestamp_of("payment_date").alias("payment_ts"),
        payment_method_group(F.col("payment_method")).alias("payment_method_group"),
    )


def stg_payments(
    raw_payments: DataFrame,
    orders: DataFrame,
    grace_minutes: int = 0,
    limits: HotKeys = HotKeys(),
) -> DataFrame:
    """Flags payments made before their order and orders paid several times.

    The number of payments per order comes from an aggregate with map-side
    combine instead of a window, so no task has to hold all payments of one
    order.  Payments without an order id count as one group of their own.
    """
    n_payments = raw_payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    ordered = orders.groupBy("order_id").agg(F.min("order_ts").alias("_order_ts"))
    per_order = n_payments.join(ordered, "order_id", "left")
    nameless = raw_payments.where(F.col("order_id").isNull()).agg(F.count(F.lit(1)).alias("n")).scalar()
    times_paid = F.when(F.col("order_id").isNull(), nameless).otherwise(F.col("_n"))
    late = is_late_arriving(F.col("payment_ts"), F.col("_order_ts"), grace_minutes)
    hot = find_hot(raw_payments, "order_id", limits)
    return lookup_join(typed_payments(raw_payments), per_order, "order_id", hot).select(
        *raw_payments.columns,
        "payment_ts",
        flag(late).alias("is_late_arriving"),
        "payment_method_group",
        (times_paid > 1).alias("is_split_payment"),
    )


def stg_events(raw_events: DataFrame) -> DataFrame:
    """One row per event id: its first occurrence."""
    return dedup_first(raw_events, ["event_id"], ["event_ts"]).select(
        "event_id",
        "session_id",
        "customer_id",
        "product_id",
        "event_type",
        timestamp_of("event_ts").alias("event_ts"),
        funnel_stage(F.col("event_type")).alias("funnel_stage"),
        "channel",
        "device",
        "ingested_at",
        "batch_id",
    )


def scd_overlap_flag(
    df: DataFrame,
    key: str,
    from_col: str,
    to_col: str,
    tie_break: tuple[str, ...] = (),
    limits: HotKeys = HotKeys(),
) -> DataFrame:
    """Adds the next version's start and whether it lies before this one's end."""
    hot = find_hot(df, key, limits)
    following = with_neighbour(df, key, from_col, {f"next_{from_col}": from_col}, "next", tie_break, hot)
    overlaps = flag(F.col(f"next_{from_col}") < F.col(to_col))
    return following.withColumn("has_scd_overlap", overlaps)


def stg_customers(raw_customers: DataFrame, limits: HotKeys = HotKeys()) -> DataFrame:
    return scd_overlap_flag(
        raw_customers, "customer_id", "valid_from", "valid_to", ("customer_key",), limits
    )


def stg_products(raw_products: DataFrame, limits: HotKeys = HotKeys()) -> DataFrame:
    """Typed product versions with margin, price tier and price change."""
    typed = raw_products.select(
        F.col("product_key").cast("int").alias("product_key"),
        F.col("product_id").cast("int").alias("product_id"),
        *(F.trim(c).alias(c) for c in ("sku", "product_name", "category", "brand")),
        F.col("cost_price").cast("double").alias("cost_price"),
        F.col("selling_price").cast("double").alias("selling_price"),
        F.col("weight_gram").cast("int").alias("weight_gram"),
        F.col("is_active").cast("boolean").alias("is_active"),
        timestamp_of("valid_from").alias("valid_from"),
        timestamp_of("valid_to").alias("valid_to"),
        F.col("is_current").cast("boolean").alias("is_current"),
        timestamp_of("updated_at").alias("updated_at"),
    )
    price, margin = F.col("selling_price"), F.col("selling_price") - F.col("cost_price")
    priced = typed.select(
        "*",
        F.round(margin, 2).alias("gross_margin_idr"),
        F.round(F.try_divide(margin, price), 4).alias("gross_margin_pct"),
        price_tier(price).alias("price_tier"),
    )
    earlier = with_neighbour(
        priced,
        "product_id",
        "valid_from",
        {"previous_selling_price": "selling_price"},
        "previous",
        ("product_key",),
        find_hot(raw_products, "product_id", limits),
    )
    before = F.col("previous_selling_price")
    change = F.round(F.try_divide(F.col("selling_price") - before, before), 4)
    return earlier.withColumn("price_change_pct", change)


def stg_returns(raw_returns: DataFrame, rates: Mapping[str, float] = FX_RATES) -> DataFrame:
    """Returns in rupiah.  A currency without a rate keeps its amount but is
    still marked converted; a NULL currency leaves the mark NULL."""
    return raw_returns.select(
        "return_ref",
        "order_id",
        date_of("return_date").alias("return_date"),
        sentence_case(F.col("reason")).alias("reason_clean"),
        to_idr(F.col("refund_amount"), F.col("currency"), rates).alias("refund_amount_idr"),
        "currency",
        (F.upper("currency") != "IDR").alias("was_currency_converted"),
        "ingested_at",
    )


def customer_history_features(
    history: DataFrame, as_of: dt.date, limits: HotKeys = HotKeys()
) -> DataFrame:
    """Customer versions from the snapshot table with what changed between them."""
    versions = history.select(
        F.col("dbt_scd_id").alias("customer_version_key"),
        "customer_id",
        "full_name",
        "email",
        "phone",
        "gender",
        date_of("date_of_birth").alias("date_of_birth"),
        "city",
        "segment",
        "referral_code",
        "is_active",
        F.col("dbt_valid_from").alias("valid_from"),
        F.col("dbt_valid_to").alias("valid_to"),
        "dbt_updated_at",
    )
    per_customer = versions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.bool_or(F.col("segment") == "churned").alias("ever_churned"),
    )
    hot = find_hot(history, "customer_id", limits)
    before = with_neighbour(
        versions,
        "customer_id",
        "valid_from",
        {"previous_segment": "segment", "previous_city": "city"},
        "previous",
        ("customer_version_key",),
        hot,
    )
    age = years_between(F.col("date_of_birth"), F.lit(as_of))
    return lookup_join(before, per_customer, "customer_id", hot).select(
        *versions.columns[:13],
        F.col("valid_to").isNull().alias("is_current"),
        age.alias("age_years"),
        cohort_by_age(age).alias("generation_cohort"),
        "n_versions",
        "ever_churned",
        "previous_segment",
        "previous_city",
        "dbt_updated_at",
        flag(F.col("previous_segment") != F.col("segment")).alias("segment_changed"),
        flag(F.col("previous_city") != F.col("city")).alias("city_changed"),
    )


def inventory_flatten(raw_inventory: DataFrame) -> DataFrame:
    return flatten_json(raw_inventory, "metadata", INVENTORY_METADATA).withColumn(
        "snapshot_date", date_of("snapshot_date")
    )


def inventory_open(raw_inventory: DataFrame) -> DataFrame:
    """``inventory_flatten`` with the feed's unknown fields and its broken texts kept."""
    return flatten_open_json(raw_inventory, "metadata", INVENTORY_METADATA).withColumn(
        "snapshot_date", date_of("snapshot_date")
    )
