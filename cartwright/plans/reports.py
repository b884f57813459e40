"""Audits and business reports over the staged tables and marts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.operators.hot import HotKeys, find_hot
from cartwright.operators.lookup import lookup_join
from cartwright.operators.pit import pit_join

# Names and descriptions of the audit rows.
AUDIT_ROWS = {
    "orphan_items": "Items tanpa order header — simulasi partial load",
    "late_arriving_payments": "Payments dengan payment_date < order_date",
    "scd_customer_overlap": "Customer SCD records dengan overlapping valid_from ranges",
    "returns_currency_converted": "Return records yang di-convert dari USD ke IDR",
    "events_after_dedup": "Events setelah dedup — bandingkan dengan source untuk lihat jumlah duplikat",
    "split_payment_orders": "Orders yang dibayar dengan lebih dari 1 metode",
    "negative_net_amount_orders": "Orders dengan net_amount negatif (discount > gross)",
}
SIZE_ROW = "events_after_dedup"

# Labels of customers with several versions and with one.
CHANGED, UNCHANGED = "Pernah berubah", "Tidak berubah"


def _count() -> Column:
    return F.count(F.lit(1))


# --- audits ---------------------------------------------------------------


def dq_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Findings per check; ``tables`` are staged frames by name.

    One conditional aggregate per table.  For ``events`` the raw frame serves
    as well and is cheaper: only distinct ids are counted.
    """
    measured = {
        "order_items": {"orphan_items": F.count_if("is_orphan_record")},
        "payments": {
            "late_arriving_payments": F.count_if("is_late_arriving"),
            "split_payment_orders": F.count_distinct(F.when(F.col("is_split_payment"), F.col("order_id"))),
        },
        "customers": {"scd_customer_overlap": F.count_if("has_scd_overlap")},
        "returns": {"returns_currency_converted": F.count_if("was_currency_converted")},
        "orders": {"negative_net_amount_orders": F.count_if("is_negative_order")},
    }
    parts = []
    for table, checks in measured.items():
        counted = tables[table].agg(*(value.alias(name) for name, value in checks.items()))
        rows = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n_rows")) for n in checks]
        parts.append(counted.select(F.inline(F.array(*rows))))
    ids = tables["events"].select("event_id").distinct().agg(_count().alias("n_rows"))
    parts.append(ids.select(F.lit(SIZE_ROW).alias("check_name"), "n_rows"))
    union = reduce(DataFrame.unionByName, parts)
    described = F.create_map(*(F.lit(text) for pair in AUDIT_ROWS.items() for text in pair))
    return union.withColumn("description", described[F.col("check_name")]).orderBy("check_name")


def dq_total(audit: DataFrame) -> DataFrame:
    """Flagged rows over all checks; the size row is not a finding."""
    findings = audit.where(F.col("check_name") != SIZE_ROW)
    return findings.agg(F.sum("n_rows").alias("total_flagged"))


def versions_histogram(history: DataFrame) -> DataFrame:
    """Customers per number of versions, with their share of all customers.

    The share's window spans the histogram, which has one row per number."""
    counted = history.groupBy("n_versions").agg(F.count_distinct("customer_id").alias("n_customers"))
    everyone = F.sum("n_customers").over(Window.partitionBy())
    return counted.withColumn("pct", F.round(F.col("n_customers") * 100.0 / everyone, 2)).orderBy("n_versions")


def segment_changes(history: DataFrame, limit: int = 30) -> DataFrame:
    columns = ["customer_id", "full_name", "segment", "previous_segment", "valid_from", "valid_to", "is_current"]
    return history.where("segment_changed").select(*columns).orderBy("customer_id", "valid_from").limit(limit)


def churned_customers(history: DataFrame, limit: int = 20) -> DataFrame:
    return (
        history.where("ever_churned")
        .groupBy("customer_id", "full_name")
        .agg(
            _count().alias("n_versions"),
            F.min("valid_from").alias("first_seen"),
            F.max("valid_from").alias("last_changed"),
        )
        .orderBy(F.desc("last_changed"), "customer_id", "full_name")
        .limit(limit)
    )


def rows_per_load(facts: DataFrame) -> DataFrame:
    day = F.col("dbt_loaded_at").cast("date").cast("timestamp_ntz")
    return facts.groupBy(day.alias("load_date")).agg(_count().alias("rows_loaded")).orderBy("load_date")


def duplicate_keys(facts: DataFrame, key: str = "order_id", limit: int = 10) -> DataFrame:
    counted = facts.groupBy(key).agg(_count().alias("n_rows")).where("n_rows > 1")
    return counted.orderBy(F.desc("n_rows"), key).limit(limit)


def events_per_day(facts: DataFrame, limit: int = 14) -> DataFrame:
    return (
        facts.groupBy("event_date")
        .agg(_count().alias("n_events"), F.count_distinct("session_id").alias("n_sessions"))
        .orderBy(F.desc("event_date"))
        .limit(limit)
    )


# --- business questions ---------------------------------------------------


def churn_rate_by_segment(rfm: DataFrame, history: DataFrame) -> DataFrame:
    """Share of each RFM segment's customers whose current version is churned."""
    churned = (
        history.where("is_current")
        .groupBy("customer_id")
        .agg(F.bool_or(F.col("segment") == "churned").alias("churned"))
    )
    joined = rfm.select("customer_id", "rfm_segment").join(churned, "customer_id", "left")
    lost = F.coalesce("churned", F.lit(False))
    return joined.groupBy("rfm_segment").agg(
        _count().alias("n_customers"),
        F.count_if(lost).alias("n_churned"),
        F.avg(lost.cast("int")).alias("churn_rate"),
    )


def revenue_by_channel(orders: DataFrame) -> DataFrame:
    return (
        orders.where("is_completed")
        .groupBy("channel")
        .agg(
            F.sum("net_amount").alias("revenue"),
            _count().alias("n_orders"),
        )
    )


def split_payment_rate(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count_if("is_split_payment").alias("n_split_orders"),
        _count().alias("n_orders"),
        F.avg(F.coalesce("is_split_payment", F.lit(False)).cast("int")).alias("split_rate"),
    )


def late_payment_rate(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count_if("has_late_payment").alias("n_late_orders"),
        _count().alias("n_orders"),
        F.avg(F.coalesce("has_late_payment", F.lit(False)).cast("int")).alias("late_rate"),
    )


def orphan_item_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count_if("is_orphan_record").alias("n_orphan_items"), _count().alias("n_items"))


def overlap_customers(customers: DataFrame) -> DataFrame:
    return customers.where("has_scd_overlap").select("customer_id").distinct()


def return_rate(
    items: DataFrame, returns: DataFrame, products: DataFrame, limits: HotKeys = HotKeys()
) -> DataFrame:
    """Orders with a product category, and how many were returned for which reason.

    A return names its order only.  Items are reduced to the categories of an
    order and returns to its reasons before the two meet, so a large order
    does not pair every item with every return.
    """
    categories = products.groupBy("product_id").agg(F.max("category").alias("category"))
    hot = find_hot(items, "product_id", limits)
    sold = (
        lookup_join(items.select("order_id", "product_id"), categories, "product_id", hot)
        .select("order_id", "category")
        .where(F.col("category").isNotNull())
        .distinct()
    )
    reasons = returns.select("order_id", F.coalesce("reason_clean", F.lit("(none)")).alias("reason")).distinct()
    n_orders = sold.groupBy("category").agg(_count().alias("n_orders"))
    returned = sold.join(reasons, "order_id").groupBy("category", "reason").agg(_count().alias("n_returned"))
    return returned.join(n_orders, "category").select(
        "category",
        "reason",
        "n_returned",
        "n_orders",
        F.round(F.col("n_returned") / F.col("n_orders"), 4).alias("return_rate"),
    )


def product_return_rate(items: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Each sold product: its orders, how many came back, why, and what was refunded; one row per reason.

    A return names its order only, so every product of the order counts as returned, and the order's
    refund is shared equally between its products. Products without returns have one row with a NULL
    reason; a return without a reason has ``(none)``. Items and returns are reduced to an order's products
    and reasons before they meet.
    """
    sold = items.where(F.col("product_id").isNotNull()).select("order_id", F.col("product_id").cast("long").alias("product_id")).distinct()
    sizes = sold.groupBy("order_id").agg(_count().alias("n_products"))
    reasons = returns.groupBy("order_id", F.coalesce("reason_clean", F.lit("(none)")).alias("reason")).agg(
        F.sum("refund_amount_idr").alias("refund")
    )
    shares = reasons.join(sizes, "order_id").select("order_id", "reason", (F.col("refund") / F.col("n_products")).alias("share"))
    back = sold.join(shares, "order_id").groupBy("product_id", "reason").agg(
        _count().alias("n_returned"), F.sum("share").alias("refund")
    )
    came_back = returns.select("order_id").distinct().withColumn("back", F.lit(True))
    totals = sold.join(came_back, "order_id", "left").groupBy("product_id").agg(
        _count().alias("n_orders"), F.count("back").alias("n_returned_orders")
    )
    names = products.groupBy(F.col("product_id").cast("long").alias("product_id")).agg(F.max("category").alias("category"))
    return (
        totals.join(names, "product_id", "left")
        .join(back, "product_id", "left")
        .select(
            "product_id",
            "category",
            "n_orders",
            "n_returned_orders",
            F.round(F.col("n_returned_orders") / F.col("n_orders"), 4).alias("return_rate"),
            "reason",
            F.coalesce("n_returned", F.lit(0).cast("long")).alias("n_returned"),
            F.round(F.coalesce("refund", F.lit(0.0)), 2).alias("refund_share_idr"),
        )
    )


def gmv_by_period(orders: DataFrame, periods: tuple[str, ...] = ("day", "week", "month")) -> DataFrame:
    """Gross amounts per period, channel and city; all periods in one pass."""
    starts = {
        "day": F.col("order_date"),
        "week": F.trunc("order_date", "week"),
        "month": F.trunc("order_date", "month"),
    }
    listed = F.array(
        *(F.struct(F.lit(p).alias("period"), starts[p].alias("period_start")) for p in periods)
    )
    return (
        orders.select("channel", "shipping_city", "gross_amount", F.inline(listed))
        .groupBy("period", "period_start", "channel", "shipping_city")
        .agg(F.sum("gross_amount").alias("gmv"), _count().alias("n_orders"))
    )


def price_at_order(
    items: DataFrame, orders: DataFrame, products: DataFrame, limits: HotKeys = HotKeys()
) -> DataFrame:
    """The price version valid when each item was ordered (half-open ranges)."""
    ordered = orders.groupBy("order_id").agg(F.min("order_ts").alias("order_ts"))
    sold = lookup_join(items.select("item_id", "order_id", "product_id"), ordered, "order_id")
    versions = products.select(
        F.col("product_id").cast("long").alias("product_id"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        "valid_from",
        "valid_to",
        F.col("selling_price").alias("price_at_time_of_order"),
    )
    hot = find_hot(products, "product_id", limits)
    return pit_join(sold, versions, "product_id", "order_ts", "_from", "_to", "left", "inner", hot)


def ever_changed_customers(history: DataFrame) -> DataFrame:
    """How many customers have more than one version, and how many have one."""
    status = F.when(_count() > 1, CHANGED).otherwise(UNCHANGED)
    versions = history.groupBy("customer_id").agg(status.alias("status"))
    return versions.groupBy("status").agg(_count().alias("n_customers"))


def customer_versions(history: DataFrame, customer_id: int) -> DataFrame:
    return history.where(F.col("customer_id") == customer_id).orderBy("valid_from")
