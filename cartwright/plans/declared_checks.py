"""The declared column checks of sources and staged tables.

Fixed values: which column of which table must satisfy what.
"""

from __future__ import annotations

import datetime as dt

from cartwright.operators.checks import Check, accepted, between, matches, not_null, unique


def _key(column: str) -> list[Check]:
    return [not_null(column), unique(column)]


SOURCE_CHECKS: dict[str, list[Check]] = {
    "fact_orders": [
        *_key("order_id"),
        not_null("customer_id"),
        not_null("order_date"),
        accepted("status", "completed", "cancelled", "returned", "processing", "shipped"),
    ],
    "fact_order_items": [*_key("item_id"), not_null("order_id"), between("quantity", 1, 10)],
    "dim_customers": [*_key("customer_key"), not_null("customer_id"), not_null("email")],
    "dim_products": [*_key("product_key"), not_null("product_id")],
    "dim_stores": _key("store_id"),
    "fact_payments": [*_key("payment_id"), not_null("order_id"), between("amount", low=0, strict=True)],
    "fact_events": [not_null("event_id")],
    "raw_returns": [not_null("return_ref")],
    "raw_customers_current": [*_key("customer_id"), not_null("updated_at")],
    "raw_products_current": [*_key("product_id"), not_null("updated_at")],
}

STAGING_CHECKS: dict[str, list[Check]] = {
    "stg_orders": [
        *_key("order_id"),
        not_null("customer_id"),
        accepted("order_status", "completed", "cancelled", "returned", "processing", "shipped"),
        between("gross_amount", low=0),
        between("net_amount", -10_000_000, 100_000_000),
        between("order_date", dt.date(2022, 1, 1), dt.date(2025, 12, 31)),
    ],
    "stg_order_items": [*_key("item_id"), between("quantity", low=1), between("discount_rate", 0, 1)],
    "stg_customers": [
        *_key("customer_key"),
        not_null("customer_id"),
        matches("email", r"^[^@]+@[^@]+\.[^@]+$"),
    ],
    "stg_products": [
        *_key("product_key"),
        between("gross_margin_pct", -0.5, 1.0),
        accepted("price_tier", "budget", "mid_range", "premium", "luxury"),
    ],
    "stg_payments": [
        *_key("payment_id"),
        accepted("payment_method_group", "card", "bank_transfer", "e_wallet", "cod", "bnpl", "other"),
        accepted("is_late_arriving", True, False),
    ],
    "stg_events": [
        *_key("event_id"),
        accepted(
            "event_type", "page_view", "product_view", "add_to_cart", "checkout_start", "checkout_complete"
        ),
        between("funnel_stage", 0, 5),
        accepted("device", "mobile", "desktop"),
    ],
    "stg_returns": [
        *_key("return_ref"),
        between("refund_amount_idr", low=0),
        accepted("currency", "IDR", "USD"),
    ],
    "stg_customers_snapshot": [
        *_key("customer_version_key"),
        not_null("customer_id"),
        accepted("segment", "new", "occasional", "loyal", "vip", "churned"),
        accepted("is_current", True, False),
        accepted("generation_cohort", "gen_z", "millennial", "gen_x", "boomer"),
    ],
}
