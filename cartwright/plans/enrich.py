"""Orders joined to what was known about customer and payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import flag, minutes_between
from cartwright.functions.bands import labelled
from cartwright.functions.text import METHOD_GROUPS
from cartwright.operators.hot import HotKeys, find_hot
from cartwright.operators.lookup import lookup_join
from cartwright.operators.pit import pit_join, supersede
from cartwright.plans.staging import timestamp_of


def _groups_used(group: Column) -> Column:
    """The distinct payment groups as sorted text.

    The groups are few and known, so a set of them is a bit mask: the
    aggregate stays a generated hash aggregate with one integer per order.
    """
    mask = F.bit_or(labelled(group, {name: 1 << n for n, name in enumerate(METHOD_GROUPS)}))
    names = (F.when(F.getbit(mask, F.lit(n)) == 1, name) for n, name in enumerate(METHOD_GROUPS))
    return F.when(mask > 0, F.concat_ws(", ", *names))


def payments_rollup(payments: DataFrame) -> DataFrame:
    """One row per order from typed payments, lateness aside."""
    first_paid = F.min("payment_ts")
    return payments.groupBy("order_id").agg(
        F.sum("amount").alias("total_paid"),
        F.count(F.lit(1)).alias("n_payment_rows"),
        (F.count(F.lit(1)) > 1).alias("is_split_payment"),
        first_paid.alias("first_payment_ts"),
        first_paid.cast("date").alias("first_payment_date"),
        _groups_used(F.col("payment_method_group")).alias("payment_methods_used"),
    )


def payments_summary(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order from typed payments.

    An order was paid late-arriving when its first payment precedes it, so the
    order time is joined after the aggregation, to one row per order.
    """
    ordered = orders.groupBy("order_id").agg(F.min("order_ts").alias("_order_ts"))
    summary = payments_rollup(payments).join(ordered, "order_id", "left")
    return summary.select(
        "order_id",
        "total_paid",
        "n_payment_rows",
        "is_split_payment",
        flag(F.col("first_payment_ts") < F.col("_order_ts")).alias("has_late_payment"),
        "first_payment_ts",
        "first_payment_date",
        "payment_methods_used",
    )


def orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    *,
    channel_col: str = "channel",
    city_col: str | None = "shipping_city",
    updated_col: str = "updated_at",
    closed: str = "left",
    one_version: bool = False,
    limits: HotKeys = HotKeys(),
) -> DataFrame:
    """Staged orders with the customer version of their time and their payments.

    ``payments`` are typed payments.  ``closed="both"`` lets an order on a
    version boundary meet both versions; ``one_version`` ends a version where
    the next one starts, so no order can meet two.  ``channel_col="source"``,
    ``city_col=None`` and ``updated_col="ingested_at"`` select the columns of
    the older table layout.
    """
    until = timestamp_of("valid_to")
    if one_version:
        until = supersede(until, timestamp_of("next_valid_from"))
    versions = customers.select(
        "customer_id",
        timestamp_of("valid_from").alias("_from"),
        until.alias("_until"),
        "customer_key",
        F.col("full_name").alias("customer_name"),
        F.col("segment").alias("customer_segment"),
        F.col("city").alias("customer_city"),
        F.col("gender").alias("customer_gender"),
        "referral_code",
    )
    paid = lookup_join(orders, payments_rollup(payments), "order_id")
    many_versions = find_hot(customers, "customer_id", limits)
    joined = pit_join(
        paid, versions, "customer_id", "order_ts", "_from", "_until", closed, hot=many_versions
    )
    city = F.lit(None).cast("string") if city_col is None else F.col(city_col)
    paid_at = F.col("first_payment_ts")
    return joined.select(
        "order_id",
        "customer_id",
        "store_id",
        "order_ts",
        "order_date",
        F.col("order_date").alias("order_date_day"),
        F.trunc("order_date", "week").alias("order_week"),
        F.trunc("order_date", "month").alias("order_month"),
        "order_status",
        "gross_amount",
        "discount_total",
        "net_amount",
        F.col("is_negative_order").alias("is_bad_order"),
        F.col(updated_col).alias("updated_at"),
        F.col(channel_col).alias("channel"),
        city.alias("shipping_city"),
        "customer_key",
        "customer_name",
        "customer_segment",
        "customer_city",
        "customer_gender",
        "referral_code",
        F.col("customer_gender").alias("gender"),
        flag(F.col("order_status") == "completed").alias("is_completed"),
        F.coalesce("total_paid", F.lit(0.0)).alias("total_paid"),
        F.coalesce("n_payment_rows", F.lit(0).cast("long")).alias("n_payment_rows"),
        flag(F.col("is_split_payment")).alias("is_split_payment"),
        flag(paid_at < F.col("order_ts")).alias("has_late_payment"),
        "first_payment_ts",
        "first_payment_date",
        "payment_methods_used",
        minutes_between(F.col("order_ts"), paid_at).alias("minutes_to_payment"),
    )


def customer_orders_summary(
    enriched: DataFrame, items: DataFrame, orders: DataFrame | None = None
) -> DataFrame:
    """Order behaviour per customer; recency counts from the newest order of all.

    Staged ``orders`` hold the same dates as ``enriched``; passing them finds
    the newest date in one column of one scan.

    Items are counted per order before the join (items without an order match
    nothing there), and orders are reduced to one row per customer and order,
    so neither a large order nor a repeated one gathers rows in one task.
    """
    items_per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    completed = F.when(F.col("is_completed"), F.col("net_amount")).otherwise(0.0)
    per_order = enriched.groupBy("customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("order_date").alias("last_date"),
        F.min("order_date").alias("first_date"),
        F.sum(completed).alias("completed_net"),
        F.sum("net_amount").alias("net"),
        F.count("net_amount").alias("n_net"),
    )
    counted = per_order.join(items_per_order, "order_id", "left")
    item_rows = F.when(F.col("n_items").isNotNull(), F.col("n_rows"))
    per_customer = counted.groupBy("customer_id").agg(
        F.max("last_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("completed_net").alias("monetary_value"),
        F.try_divide(F.sum("net"), F.sum("n_net")).alias("avg_order_value"),
        F.try_divide(F.sum(F.col("n_items") * F.col("n_rows")), F.sum(item_rows)).alias(
            "avg_items_per_order"
        ),
        F.min("first_date").alias("first_order_date"),
    )
    newest = (enriched if orders is None else orders).agg(F.max("order_date").alias("newest")).scalar()
    return per_customer.withColumn(
        "recency_days", F.datediff(newest, F.col("last_order_date")).cast("long")
    )
