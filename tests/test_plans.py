"""The plans are those a large cluster needs."""

import datetime as dt

import pytest
from conftest import SMALL, plan
from pyspark.sql import functions as F

from cartwright.operators.lookback import lookback_filter
from cartwright.operators.upsert import upsert
from cartwright.plans import marts, staging
from cartwright.sources.publish import in_partitions, read_target
from workbench.queries import QUERIES, Inputs

LAZY = [
    "stg_order_items",
    "stg_payments",
    "stg_products",
    "stg_events_dedup",
    "orders_enriched",
    "customer_orders_summary",
    "price_at_order",
    "fct_revenue_daily",
    "fct_revenue_daily_by_return_date",
    "customer_rfm",
    "funnel_conversion",
    "return_rate_by_product",
    "stg_customers_snapshot",
    "churn_rate_by_segment",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert slow not in text


def test_partition_literals_prune_folders(spark, folder):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    facts = spark.createDataFrame([(n, day) for n, day in enumerate(days)], "id long, day date")
    upsert(spark, folder("t"), facts, ["id"], "day")
    some = read_target(spark, folder("t")).where(in_partitions("day", days[:2]))
    assert some.count() == 2
    assert "PartitionFilters: [day" in plan(some) or "PartitionFilters: [isnotnull(day" in plan(some)


def test_lookback_bound_is_pushed_into_the_scan(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    recent = lookback_filter(events, "ts", dt.datetime(2024, 1, 20), 3)
    assert "GreaterThanOrEqual(ts,2024-01-17" in plan(recent)


def test_scans_read_only_what_is_used(spark):
    channel = Inputs(spark, SMALL).orders().groupBy("channel").agg(F.sum("net_amount"))
    scan = next(line for line in plan(channel).splitlines() if "orders.parquet" in line)
    assert "o_orderpriority" not in scan and "o_orderdate" not in scan


def test_window_for_first_rows_is_limited_below_the_shuffle(spark):
    text = plan(staging.stg_events(Inputs(spark, SMALL).raw("raw_events")))
    below = text[text.index("Exchange hashpartitioning(event_id") :]
    assert "WindowGroupLimit" in below


def test_payments_meet_no_window(spark):
    text = plan(Inputs(spark, SMALL).staged_payments())
    assert "Window" not in text


def test_the_funnel_reads_events_once_and_expands_nothing(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").select(
        F.col("ts").alias("event_ts"),
        "event_type",
        F.col("props").alias("channel"),
        F.col("props").alias("device"),
        F.col("props").alias("session_id"),
        F.col("user_id").alias("customer_id"),
    )
    text = plan(marts.funnel_conversion(events, dt.datetime(2024, 2, 1)))
    assert text.count("FileScan") == 1 and "Expand" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_revenue_joins_returns_once_and_not_on_four_keys(spark):
    facts = spark.createDataFrame([], "order_id long, customer_id long, order_date_day date, channel string, shipping_city string, customer_segment string, is_completed boolean, is_split_payment boolean, gross_amount double, discount_total double, net_amount double")
    returns = spark.createDataFrame([], "order_id long, refund_amount_idr double")
    text = marts.revenue_daily(facts, returns, dt.datetime(2024, 2, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftOuter") == 1

