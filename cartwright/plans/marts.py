"""Fact tables, the customer dimension, revenue, RFM and the funnel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import (
    RfmConfig,
    generation_cohort,
    rfm_frequency_score,
    rfm_monetary_score,
    rfm_recency_score,
    rfm_segment_label,
    safe_divide,
    surrogate_key,
    years_between,
)
from cartwright.functions.bands import labelled
from cartwright.operators.contracts import enforce_contract
from cartwright.plans.contracts import DIM_CUSTOMERS_SCD, FCT_EVENTS, FCT_ORDERS
from cartwright.plans.staging import FUNNEL_STAGES, date_of

# Fixed value: end date given to versions that are still open.
FAR_FUTURE = dt.date(9999, 12, 31)

REVENUE_KEYS = ["date_day", "channel", "shipping_city", "customer_segment"]


def _loaded_at(run_ts: dt.datetime) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz").alias("dbt_loaded_at")


def fct_orders(enriched: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The order-grain fact table under its contract."""
    facts = enriched.select(
        surrogate_key("order_id").alias("order_sk"),
        *(f for f in FCT_ORDERS.names if f not in ("order_sk", "updated_at", "dbt_loaded_at")),
        F.col("updated_at").cast("string").alias("updated_at"),
        _loaded_at(run_ts),
    )
    return enforce_contract(facts, FCT_ORDERS)


def fct_events(events: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The event-grain fact table under its contract (ids as DOUBLE)."""
    facts = events.select(
        "event_id",
        "session_id",
        F.col("customer_id").cast("double").alias("customer_id"),
        F.col("product_id").cast("double").alias("product_id"),
        "event_type",
        "event_ts",
        F.col("event_ts").cast("date").alias("event_date"),
        F.hour("event_ts").alias("event_hour"),
        "channel",
        "device",
        "funnel_stage",
        "ingested_at",
        "batch_id",
        _loaded_at(run_ts),
    )
    return enforce_contract(facts, FCT_EVENTS)


def dim_customers_scd(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Customer versions with age and cohort as of a given day."""
    born = date_of("date_of_birth")
    derived = {
        "age_years": years_between(born, F.lit(as_of)),
        "generation_cohort": generation_cohort(F.year(born)),
        "valid_to_date_safe": F.coalesce(date_of("valid_to"), F.lit(FAR_FUTURE)),
    }
    return enforce_contract(customers.withColumns(derived).select(*DIM_CUSTOMERS_SCD.names), DIM_CUSTOMERS_SCD)


def _daily_sales(rows: DataFrame, kept: Column, extra: dict[str, str] | None = None) -> DataFrame:
    """Revenue measures per REVENUE_KEYS over the rows where ``kept`` holds, and sums of ``extra`` columns over all rows.

    Two distinct counts make Spark list each row under its order, its customer and its group, and combine each of the three before the
    shuffle. Grouping by order, by customer and by group in turn sends as many rows and was measured 1.5 times slower.
    """

    def only(column: str) -> Column:
        return F.when(kept, F.col(column))

    return rows.groupBy(*REVENUE_KEYS).agg(
        F.count_distinct(only("order_id")).alias("n_orders"),
        F.count_distinct(only("customer_id")).alias("n_unique_customers"),
        F.sum(only("gross_amount")).alias("gross_revenue"),
        F.sum(only("discount_total")).alias("total_discounts"),
        F.sum(only("net_amount")).alias("net_revenue"),
        F.avg(only("net_amount")).alias("avg_order_value"),
        F.count_if(kept & F.col("is_split_payment")).alias("n_split_payment_orders"),
        F.count_if(kept).alias("_n_completed"),
        *(F.sum(column).alias(name) for name, column in (extra or {}).items()),
    )


def customer_sketches(orders: DataFrame, day: str = "order_date_day", precision: int = 12) -> DataFrame:
    """One HyperLogLog sketch of the customers with completed orders per day and channel.

    Sketches of days add up to those of weeks and months, which exact counts do not; a sketch has 2 ** precision registers
    at most and an error of about 1.04 / 2 ** (precision / 2), 1.6 % by default.
    """
    completed = orders.where("is_completed").where(F.col("customer_id").isNotNull())
    return completed.groupBy(F.col(day).alias("date_day"), "channel").agg(
        F.hll_sketch_agg("customer_id", precision).alias("customers")
    )


def customers_by_period(sketches: DataFrame, periods: tuple[str, ...] = ("week", "month")) -> DataFrame:
    """About how many customers ordered in each period and channel, from the days' sketches; orders are not read."""
    listed = F.array(
        *(F.struct(F.lit(p).alias("period"), F.trunc("date_day", p).alias("period_start")) for p in periods)
    )
    return (
        sketches.select("channel", "customers", F.inline(listed))
        .groupBy("period", "period_start", "channel")
        .agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("n_customers"))
    )


def _revenue_columns(run_ts: dt.datetime) -> list[Column | str]:
    refunds = F.coalesce("total_refunds_idr", F.lit(0.0))
    return [
        *REVENUE_KEYS,
        "n_orders",
        "n_unique_customers",
        "gross_revenue",
        "total_discounts",
        "net_revenue",
        "avg_order_value",
        "n_split_payment_orders",
        refunds.alias("total_refunds_idr"),
        F.coalesce("n_returns", F.lit(0).cast("long")).alias("n_returns"),
        (F.col("net_revenue") - refunds).alias("net_revenue_after_returns"),
        _loaded_at(run_ts),
    ]


def revenue_daily(
    orders: DataFrame, returns: DataFrame, run_ts: dt.datetime, *, null_safe: bool = True
) -> DataFrame:
    """Completed orders per day, channel, city and segment, less the refunds of
    all orders of that group.

    Returns are summed per order before they meet the orders, and one grouping
    yields both sales and refunds: the fact table is read and shuffled once,
    and groups with a NULL key keep their refunds.  ``null_safe=False`` gives
    such groups no refunds, as a join on the four keys would.
    """
    per_order = returns.groupBy("order_id").agg(
        F.sum("refund_amount_idr").alias("_refunds"), F.count(F.lit(1)).alias("_returns")
    )
    joined = orders.withColumnRenamed("order_date_day", "date_day").join(per_order, "order_id", "left")
    completed = F.coalesce("is_completed", F.lit(False))
    grouped = _daily_sales(joined, completed, {"total_refunds_idr": "_refunds", "n_returns": "_returns"})
    sold = grouped.where("_n_completed > 0")
    if not null_safe:
        named = F.lit(True)
        for key in REVENUE_KEYS:
            named = named & F.col(key).isNotNull()
        sold = sold.withColumns(
            {c: F.when(named, F.col(c)) for c in ("total_refunds_idr", "n_returns")}
        )
    return sold.select(*_revenue_columns(run_ts))


def revenue_daily_by_return_date(orders: DataFrame, returns: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The variant that books refunds on the day of the return.

    Every group of a day shows the whole day's refunds: do not add them up
    over channels, cities or segments.
    """
    per_day = returns.groupBy(F.col("return_date").alias("date_day")).agg(
        F.sum("refund_amount_idr").alias("total_refunds_idr"), F.count(F.lit(1)).alias("n_returns")
    )
    completed = orders.where("is_completed").withColumnRenamed("order_date_day", "date_day")
    daily = _daily_sales(completed, F.lit(True))
    return daily.join(per_day, "date_day", "left").select(*_revenue_columns(run_ts))


def customer_months(orders: DataFrame, month: str) -> DataFrame:
    """What each customer ordered in each month: the mergeable state behind ``rfm_of_months``.

    Cancelled orders and those without a status do not count, as in ``customer_rfm``.
    """
    counted = orders.where(F.col("order_status") != "cancelled")
    return counted.groupBy("customer_id", month).agg(
        F.count_distinct("order_id").alias("n_orders"),
        F.sum("net_amount").alias("spent"),
        F.max("order_date").alias("last_order_date"),
    )


def rfm_of_months(months: DataFrame, as_of: dt.date, thresholds: RfmConfig = RfmConfig()) -> DataFrame:
    """``customer_rfm`` from the months' state; the orders themselves are not read.

    An order belongs to one month, as the order fact's key says.
    """
    per_customer = months.groupBy("customer_id").agg(
        F.sum("n_orders").alias("total_orders"),
        F.sum("spent").alias("total_spent"),
        _days_since(F.max("last_order_date"), as_of),
    )
    return _rfm_scored(per_customer, thresholds)


def customer_rfm(orders: DataFrame, as_of: dt.date, thresholds: RfmConfig = RfmConfig()) -> DataFrame:
    """Scores and segment per customer; cancelled orders and those without a
    status do not count."""
    per_customer = (
        orders.where(F.col("order_status") != "cancelled")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("net_amount").alias("total_spent"),
            _days_since(F.max("order_date"), as_of),
        )
    )
    return _rfm_scored(per_customer, thresholds)


def _days_since(last: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), last).cast("long").alias("days_since_last_order")


def _rfm_scored(per_customer: DataFrame, thresholds: RfmConfig) -> DataFrame:
    scored = per_customer.select(
        "*",
        rfm_recency_score(F.col("days_since_last_order"), thresholds).alias("recency_score"),
        rfm_frequency_score(F.col("total_orders"), thresholds).alias("frequency_score"),
        rfm_monetary_score(F.col("total_spent"), thresholds).alias("monetary_score"),
    )
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumn("rfm_score", total).withColumn(
        "rfm_segment", rfm_segment_label(F.col("rfm_score"), thresholds)
    )


def funnel_conversion(events: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Sessions and users reaching each step per day, channel and device.

    Distinct counting takes two aggregations and no row expansion per step:
    each event is listed under its session and under its customer, the first
    aggregation keeps one bit mask of reached steps per session or customer,
    the second counts the masks.  A hot day or channel is spread over its
    sessions before it is gathered.
    """
    steps = list(FUNNEL_STAGES)
    group = ["event_date", "channel", "device"]
    bit = labelled(F.col("event_type"), {step: 1 << n for n, step in enumerate(steps)}, 0)
    listed = events.select(
        F.col("event_ts").cast("date").alias("event_date"),
        "channel",
        "device",
        bit.alias("step"),
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("is_session"), F.col("session_id").cast("string").alias("who")),
                F.struct(F.lit(False).alias("is_session"), F.col("customer_id").cast("string").alias("who")),
            )
        ),
    )
    reached = listed.groupBy(*group, "is_session", "who").agg(
        F.bit_or("step").alias("steps"), F.count(F.lit(1)).alias("n_events")
    )
    session = F.col("is_session") & F.col("who").isNotNull()
    user = ~F.col("is_session") & F.col("who").isNotNull()

    def reached_step(step: str) -> Column:
        return F.getbit("steps", F.lit(steps.index(step))) == 1

    counted = reached.groupBy(*group).agg(
        F.count_if(session).alias("total_sessions"),
        *(F.count_if(session & reached_step(s)).alias(f"sessions_{s}") for s in steps),
        F.count_if(user & reached_step(steps[0])).alias("users_page_view"),
        F.count_if(user & reached_step(steps[-1])).alias("users_converted"),
        F.sum(F.when(F.col("is_session"), F.col("n_events"))).alias("total_events"),
    )
    # Name of the rate between each step and the one before it.
    rates = {
        "page_to_pdp_rate": ("sessions_product_view", "sessions_page_view"),
        "pdp_to_cart_rate": ("sessions_add_to_cart", "sessions_product_view"),
        "cart_to_checkout_rate": ("sessions_checkout_start", "sessions_add_to_cart"),
        "checkout_completion_rate": ("sessions_checkout_complete", "sessions_checkout_start"),
        "overall_conversion_rate": ("sessions_checkout_complete", "total_sessions"),
    }
    return counted.select(
        "*",
        *(safe_divide(F.col(a), F.col(b)).alias(name) for name, (a, b) in rates.items()),
        _loaded_at(run_ts),
    )
