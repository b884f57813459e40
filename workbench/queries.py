"""Every registered query: Spark callable and, where SQL can say it, its twin."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions import (
    RfmConfig,
    cents_to_idr,
    cohort_by_age,
    date_spine,
    generation_cohort,
    is_late_arriving,
    rfm_frequency_score,
    rfm_monetary_score,
    rfm_recency_score,
    safe_divide,
    surrogate_key,
    to_idr,
    years_between,
)
from cartwright.operators import checks
from cartwright.operators.contracts import enforce_contract
from cartwright.operators.dedup import dedup_first
from cartwright.operators.hot import HotKeys
from cartwright.operators.lookback import incremental_filter
from cartwright.operators.pit import pit_join
from cartwright.operators.snapshot import VALID_TO, read_history, scd2_merge, scd2_snapshot
from cartwright.operators.upsert import upsert
from cartwright.plans import contracts, enrich, job, marts, reports, staging
from cartwright.plans.declared_checks import SOURCE_CHECKS, STAGING_CHECKS
from cartwright.plans.staging import timestamp_of
from cartwright.session import shared_dir, tune
from cartwright.sources import SOURCES, load, parquet, storage
from cartwright.sources.publish import distinct_values, read_target, replace_partitions
from cartwright.streaming import stream_dedup_events, stream_dedup_with_late, stream_ingest, stream_upsert
from workbench import bindings, oracle
from workbench.oracle import EVENTS_AS_OF, ORDERS_AS_OF, RUN_TS, compose

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_DAY = dt.date(2001, 8, 2)
EVENTS_DAY = dt.date(2024, 2, 1)
RUN_AT = dt.datetime(2024, 2, 1)
SNAPSHOT_RUNS = [dt.datetime.fromisoformat(text) for text in oracle.SNAPSHOT_RUNS]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None) -> Callable[[Callable], Callable]:
    """Add a query; ``sql`` is its twin over the oracle layers."""

    def add(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(tune(spark), sf_dir))
        if sql is not None:
            ORACLE[name] = compose(sql)
        return build

    return add


class Inputs:
    """Raw, staged and mart frames over one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return bindings.raw(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        """A fresh folder in shared storage."""
        return f"{shared_dir(self.spark)}/cartwright-queries/{name}-{uuid.uuid4().hex[:12]}"

    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw("raw_orders"))

    def items(self) -> DataFrame:
        return staging.stg_order_items(self.raw("raw_order_items"), self.orders())

    def payments(self) -> DataFrame:
        return staging.typed_payments(self.raw("raw_payments"))

    def staged_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw("raw_payments"), self.orders())

    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw("raw_dim_customers"))

    def products(self) -> DataFrame:
        return staging.stg_products(self.raw("raw_dim_products"))

    def events(self) -> DataFrame:
        return staging.stg_events(self.raw("raw_events"))

    def returns(self) -> DataFrame:
        return staging.stg_returns(self.raw("raw_returns"))

    def enriched(self, **options) -> DataFrame:
        options = {"one_version": True, **options}
        return enrich.orders_enriched(self.orders(), self.customers(), self.payments(), **options)

    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.enriched(), RUN_AT)

    def fct_events(self) -> DataFrame:
        return marts.fct_events(self.events(), RUN_AT)

    def rfm(self) -> DataFrame:
        return marts.customer_rfm(self.fct_orders(), ORDERS_DAY)

    def history(self, prefix: str = "raw_customers", key: str = "customer_id") -> DataFrame:
        """The history three snapshot runs leave, as one lazy plan."""
        closed, current = [], None
        for batch, now in enumerate(SNAPSHOT_RUNS, start=1):
            merged = scd2_merge(current, self.raw(f"{prefix}_{batch}"), key, now=now)
            if current is not None:
                closed.append(merged.where(F.col(VALID_TO).isNotNull()))
            current = merged.where(F.col(VALID_TO).isNull())
        return reduce(DataFrame.unionByName, closed, current)

    def history_features(self) -> DataFrame:
        return staging.customer_history_features(self.history(), EVENTS_DAY)


# Sums of doubles depend on their order in the last bits.  Amounts here have four
# decimals, so sums are compared rounded to four, and averages as such a sum
# divided by its count.


def rounded(df: DataFrame, *columns: str, average: str | None = None, count: str = "") -> DataFrame:
    fixed = {c: F.round(c, 4) for c in columns}
    if average:
        fixed[average] = F.round(F.col(average) * F.col(count), 4) / F.col(count)
    return df.withColumns(fixed)


def round_sql(source: str, *columns: str, average: str | None = None, count: str = "") -> str:
    fixed = [f"round({c}, 4) AS {c}" for c in columns]
    if average:
        fixed.append(f"round({average} * {count}, 4) / {count} AS {average}")
    return f"SELECT * REPLACE ({', '.join(fixed)}) FROM {source}"


# --- staging --------------------------------------------------------------

register("stg_orders", "SELECT * FROM stg_orders")(lambda i: i.orders())
register("stg_order_items", "SELECT * FROM stg_order_items")(lambda i: i.items())
register("stg_payments", "SELECT * FROM stg_payments")(lambda i: i.staged_payments())
register("stg_events_dedup", "SELECT * FROM stg_events")(lambda i: i.events())
register("stg_customers_scd_overlap", "SELECT * FROM stg_customers")(lambda i: i.customers())
register("stg_products", "SELECT * FROM stg_products")(lambda i: i.products())
register("stg_returns", "SELECT * FROM stg_returns")(lambda i: i.returns())
register("stg_customers_snapshot", "SELECT * FROM history_features")(lambda i: i.history_features())
register(
    "inventory_flatten",
    """SELECT cast(snapshot_date AS DATE) AS snapshot_date, warehouse_id, product_id, sku, qty_on_hand,
  qty_reserved, reorder_point, cast(json_extract_string(metadata, '$.last_restock') AS DATE) AS last_restock,
  json_extract_string(metadata, '$.storage_zone') AS storage_zone,
  cast(json_extract_string(metadata, '$.temp_sensitive') AS BOOLEAN) AS temp_sensitive
FROM raw_inventory_feed""",
)(lambda i: staging.inventory_flatten(i.raw("raw_inventory_feed")))
_NEW_FEED = """CASE WHEN product_id % 13 = 0 THEN '{"last_restock": ' WHEN product_id % 17 = 0 THEN '[1]'
  WHEN product_id % 7 = 0 THEN replace(metadata, '}', ',"grade":"' || cast(product_id % 5 AS STRING) || '"}')
  ELSE metadata END"""


@register(
    "inventory_open",
    f"""SELECT cast(snapshot_date AS DATE) AS snapshot_date, warehouse_id, product_id, sku, qty_on_hand, qty_reserved,
  reorder_point, cast(json_extract_string(m, '$.last_restock') AS DATE) AS last_restock,
  json_extract_string(m, '$.storage_zone') AS storage_zone,
  cast(json_extract_string(m, '$.temp_sensitive') AS BOOLEAN) AS temp_sensitive,
  json_extract_string(m, '$.grade') AS grade, CASE WHEN m IS NULL THEN text END AS rejected_text
FROM (SELECT *, {_NEW_FEED} AS text, CASE WHEN product_id % 13 > 0 AND product_id % 17 > 0 THEN {_NEW_FEED} END AS m
  FROM raw_inventory_feed)""",
)
def _inventory_open(i: Inputs) -> DataFrame:
    """A feed that has grown a field and sends broken texts."""
    feed = i.raw("raw_inventory_feed").withColumn("metadata", F.expr(_NEW_FEED))
    flat = staging.inventory_open(feed)
    return flat.withColumn("grade", F.col("other_fields")["grade"]).drop("other_fields")


register(
    "dedup_first",
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus) = 1""",
)(lambda i: dedup_first(i.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


# --- enrichment -----------------------------------------------------------

register("payments_summary", round_sql("payments_summary", "total_paid"))(
    lambda i: rounded(enrich.payments_summary(i.payments(), i.orders()), "total_paid")
)
register("orders_enriched", round_sql("enriched_half_open", "total_paid"))(
    lambda i: rounded(i.enriched(one_version=False), "total_paid")
)
register("orders_enriched_literal", round_sql("enriched_literal", "total_paid"))(
    lambda i: rounded(
        i.enriched(
            one_version=False,
            channel_col="source",
            city_col=None,
            updated_col="ingested_at",
            closed="both",
        ),
        "total_paid",
    )
)


@register(
    "customer_orders_summary",
    """SELECT customer_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS frequency,
  round(sum(CASE WHEN is_completed THEN net_amount ELSE 0 END), 4) AS monetary_value,
  round(sum(net_amount), 4) / count(net_amount) AS avg_order_value, avg(n_items) AS avg_items_per_order,
  min(order_date) AS first_order_date,
  date_diff('day', max(order_date), (SELECT max(order_date) FROM enriched)) AS recency_days
FROM enriched LEFT JOIN (SELECT order_id, count(*) AS n_items FROM stg_order_items
  WHERE NOT is_orphan_record GROUP BY order_id) USING (order_id)
GROUP BY customer_id""",
)
def _customer_orders_summary(i: Inputs) -> DataFrame:
    summary = enrich.customer_orders_summary(i.enriched(), i.raw("raw_order_items"), i.orders())
    return rounded(summary, "monetary_value", average="avg_order_value", count="frequency")


def _versions(i: Inputs) -> DataFrame:
    return i.customers().select(
        "customer_id",
        timestamp_of("valid_from").alias("_from"),
        timestamp_of("valid_to").alias("_to"),
        "customer_key",
        F.col("segment").alias("customer_segment"),
    )


def _pit(i: Inputs, closed: str) -> DataFrame:
    facts = i.orders().select("order_id", "customer_id", "order_ts")
    return pit_join(facts, _versions(i), "customer_id", "order_ts", "_from", "_to", closed)


_PIT_SQL = """SELECT o.order_id, o.customer_id, o.order_ts, c.customer_key, c.segment AS customer_segment
FROM stg_orders o LEFT JOIN raw_dim_customers c ON c.customer_id = o.customer_id
  AND cast(c.valid_from AS TIMESTAMP) <= o.order_ts
  AND o.order_ts {op} coalesce(cast(c.valid_to AS TIMESTAMP), TIMESTAMP '2999-12-31 00:00:00')"""
register("pit_join_closed", _PIT_SQL.format(op="<="))(lambda i: _pit(i, "both"))
register("pit_join_half_open", _PIT_SQL.format(op="<"))(lambda i: _pit(i, "left"))
register(
    "price_at_order",
    """SELECT i.item_id, i.order_id, i.product_id, o.order_ts, p.valid_from, p.valid_to,
  p.selling_price AS price_at_time_of_order
FROM raw_order_items i JOIN stg_orders o ON o.order_id = i.order_id
JOIN stg_products p ON p.product_id = i.product_id AND p.valid_from <= o.order_ts
  AND (p.valid_to IS NULL OR o.order_ts < p.valid_to)""",
)(lambda i: reports.price_at_order(i.raw("raw_order_items"), i.orders(), i.products()))


# --- marts ----------------------------------------------------------------

REVENUE_MONEY = (
    "gross_revenue",
    "total_discounts",
    "net_revenue",
    "total_refunds_idr",
    "net_revenue_after_returns",
)
PER_ORDER = {"average": "avg_order_value", "count": "n_orders"}

register("fct_orders", round_sql("fct_orders", "total_paid"))(lambda i: rounded(i.fct_orders(), "total_paid"))
register("fct_events", "SELECT * FROM fct_events")(lambda i: i.fct_events())
register("dim_customers_scd", "SELECT * FROM dim_customers_scd")(
    lambda i: marts.dim_customers_scd(i.customers(), EVENTS_DAY)
)
register("fct_revenue_daily", round_sql("fct_revenue_daily", *REVENUE_MONEY, **PER_ORDER))(
    lambda i: rounded(
        marts.revenue_daily(i.fct_orders(), i.returns(), RUN_AT), *REVENUE_MONEY, **PER_ORDER
    )
)
register(
    "fct_revenue_daily_literal",
    round_sql(f"({oracle._revenue('fct_orders', '=')})", *REVENUE_MONEY, **PER_ORDER),
)(
    lambda i: rounded(
        marts.revenue_daily(i.fct_orders(), i.returns(), RUN_AT, null_safe=False),
        *REVENUE_MONEY,
        **PER_ORDER,
    )
)
register(
    "fct_revenue_daily_by_return_date",
    round_sql(
        f"""(SELECT d.*, coalesce(r.refunds, 0) AS total_refunds_idr, coalesce(r.n, 0) AS n_returns,
  d.net_revenue - coalesce(r.refunds, 0) AS net_revenue_after_returns, {RUN_TS} AS dbt_loaded_at
FROM (SELECT * EXCLUDE (total_refunds_idr, n_returns, net_revenue_after_returns, dbt_loaded_at)
      FROM fct_revenue_daily) d
LEFT JOIN (SELECT return_date, sum(refund_amount_idr) AS refunds, count(*) AS n
           FROM stg_returns GROUP BY return_date) r ON r.return_date = d.date_day)""",
        *REVENUE_MONEY,
        **PER_ORDER,
    ),
)(
    lambda i: rounded(
        marts.revenue_daily_by_return_date(i.fct_orders(), i.returns(), RUN_AT),
        *REVENUE_MONEY,
        **PER_ORDER,
    )
)
register("customer_rfm", round_sql("customer_rfm", "total_spent"))(lambda i: rounded(i.rfm(), "total_spent"))


def _distinct_if(step: str, who: str) -> str:
    return f"count(DISTINCT {who}) FILTER (WHERE event_type = '{step}')"


_FUNNEL = f"""SELECT *, round(sessions_product_view / nullif(sessions_page_view, 0), 4) AS page_to_pdp_rate,
  round(sessions_add_to_cart / nullif(sessions_product_view, 0), 4) AS pdp_to_cart_rate,
  round(sessions_checkout_start / nullif(sessions_add_to_cart, 0), 4) AS cart_to_checkout_rate,
  round(sessions_checkout_complete / nullif(sessions_checkout_start, 0), 4) AS checkout_completion_rate,
  round(sessions_checkout_complete / nullif(total_sessions, 0), 4) AS overall_conversion_rate,
  {RUN_TS} AS dbt_loaded_at
FROM (SELECT cast(event_ts AS DATE) AS event_date, channel, device,
  count(DISTINCT session_id) AS total_sessions,
  {_distinct_if("page_view", "session_id")} AS sessions_page_view,
  {_distinct_if("product_view", "session_id")} AS sessions_product_view,
  {_distinct_if("add_to_cart", "session_id")} AS sessions_add_to_cart,
  {_distinct_if("checkout_start", "session_id")} AS sessions_checkout_start,
  {_distinct_if("checkout_complete", "session_id")} AS sessions_checkout_complete,
  {_distinct_if("page_view", "customer_id")} AS users_page_view,
  {_distinct_if("checkout_complete", "customer_id")} AS users_converted, count(*) AS total_events
FROM stg_events GROUP BY ALL)"""

register("funnel_conversion", _FUNNEL)(lambda i: marts.funnel_conversion(i.events(), RUN_AT))


# --- audits and reports ---------------------------------------------------


def _audit(i: Inputs) -> DataFrame:
    return reports.dq_audit(
        {
            "orders": i.orders(),
            "order_items": i.items(),
            "payments": i.staged_payments(),
            "customers": i.customers(),
            "returns": i.returns(),
            "events": i.raw("raw_events"),
        }
    )


register("data_quality_audit", "SELECT * FROM data_quality_audit ORDER BY check_name")(_audit)
register(
    "audit_total",
    "SELECT cast(sum(n_rows) AS BIGINT) AS total_flagged FROM data_quality_audit"
    " WHERE check_name <> 'events_after_dedup'",
)(lambda i: reports.dq_total(_audit(i)))
register(
    "versions_histogram",
    """SELECT n_versions, count(DISTINCT customer_id) AS n_customers,
  round(count(DISTINCT customer_id) * 100.0 / (SELECT count(DISTINCT customer_id) FROM history_features), 2)
    AS pct
FROM history_features GROUP BY n_versions""",
)(lambda i: reports.versions_histogram(i.history_features()))
register(
    "segment_changes",
    """SELECT customer_id, full_name, segment, previous_segment, valid_from, valid_to, is_current
FROM history_features WHERE segment_changed ORDER BY customer_id, valid_from LIMIT 30""",
)(lambda i: reports.segment_changes(i.history_features()))
register(
    "churned_customers",
    """SELECT customer_id, full_name, count(*) AS n_versions, min(valid_from) AS first_seen,
  max(valid_from) AS last_changed
FROM history_features WHERE ever_churned GROUP BY customer_id, full_name
ORDER BY last_changed DESC, customer_id, full_name LIMIT 20""",
)(lambda i: reports.churned_customers(i.history_features()))
register(
    "rows_per_load",
    "SELECT date_trunc('day', dbt_loaded_at) AS load_date, count(*) AS rows_loaded FROM fct_orders GROUP BY 1",
)(lambda i: reports.rows_per_load(i.fct_orders()))
register(
    "duplicate_keys",
    """SELECT item_id, count(*) AS n_rows FROM raw_order_items GROUP BY item_id HAVING count(*) > 1
ORDER BY n_rows DESC, item_id LIMIT 10""",
)(lambda i: reports.duplicate_keys(i.raw("raw_order_items"), "item_id"))
register(
    "events_per_day",
    """SELECT event_date, count(*) AS n_events, count(DISTINCT session_id) AS n_sessions
FROM fct_events GROUP BY event_date ORDER BY event_date DESC LIMIT 14""",
)(lambda i: reports.events_per_day(i.fct_events()))
register(
    "churn_rate_by_segment",
    """SELECT r.rfm_segment, count(*) AS n_customers, count(*) FILTER (WHERE h.segment = 'churned') AS n_churned,
  avg(CASE WHEN h.segment = 'churned' THEN 1 ELSE 0 END) AS churn_rate
FROM customer_rfm r LEFT JOIN history_features h ON h.customer_id = r.customer_id AND h.is_current
GROUP BY r.rfm_segment""",
)(lambda i: reports.churn_rate_by_segment(i.rfm(), i.history_features()))
register(
    "revenue_by_channel",
    """SELECT channel, round(sum(net_amount), 4) AS revenue, count(*) AS n_orders
FROM fct_orders WHERE is_completed GROUP BY channel""",
)(lambda i: rounded(reports.revenue_by_channel(i.fct_orders()), "revenue"))
register(
    "split_payment_rate",
    """SELECT count(*) FILTER (WHERE is_split_payment) AS n_split_orders, count(*) AS n_orders,
  avg(CASE WHEN is_split_payment THEN 1 ELSE 0 END) AS split_rate FROM fct_orders""",
)(lambda i: reports.split_payment_rate(i.fct_orders()))
register(
    "late_payment_rate",
    """SELECT count(*) FILTER (WHERE has_late_payment) AS n_late_orders, count(*) AS n_orders,
  avg(CASE WHEN has_late_payment THEN 1 ELSE 0 END) AS late_rate FROM fct_orders""",
)(lambda i: reports.late_payment_rate(i.fct_orders()))
register(
    "orphan_item_count",
    "SELECT count(*) FILTER (WHERE is_orphan_record) AS n_orphan_items, count(*) AS n_items FROM stg_order_items",
)(lambda i: reports.orphan_item_count(i.items()))
register("overlap_customers", "SELECT DISTINCT customer_id FROM stg_customers WHERE has_scd_overlap")(
    lambda i: reports.overlap_customers(i.customers())
)
register(
    "return_rate_by_product",
    """SELECT category, reason, n_returned, n_orders, round(n_returned / n_orders, 4) AS return_rate
FROM (SELECT category, reason, count(*) AS n_returned
  FROM sold_categories JOIN (SELECT DISTINCT order_id, coalesce(reason_clean, '(none)') AS reason
    FROM stg_returns) USING (order_id) GROUP BY ALL)
JOIN (SELECT category, count(*) AS n_orders FROM sold_categories GROUP BY category) USING (category)""",
)(lambda i: reports.return_rate(i.raw("raw_order_items"), i.returns(), i.products()))
register(
    "product_return_rate",
    """SELECT t.product_id, c.category, t.n_orders, t.n_returned_orders,
  round(t.n_returned_orders / t.n_orders, 4) AS return_rate, r.reason,
  coalesce(r.n_returned, 0) AS n_returned, round(coalesce(r.refund, 0), 2) AS refund_share_idr
FROM (SELECT product_id, count(*) AS n_orders, count(b.order_id) AS n_returned_orders
      FROM (SELECT DISTINCT order_id, product_id FROM raw_order_items) s
      LEFT JOIN (SELECT DISTINCT order_id FROM stg_returns) b USING (order_id) GROUP BY product_id) t
LEFT JOIN (SELECT product_id, max(category) AS category FROM stg_products GROUP BY product_id) c USING (product_id)
LEFT JOIN (SELECT product_id, reason, count(*) AS n_returned, sum(refund / n_products) AS refund
      FROM (SELECT DISTINCT order_id, product_id FROM raw_order_items)
      JOIN (SELECT order_id, count(DISTINCT product_id) AS n_products FROM raw_order_items GROUP BY order_id) USING (order_id)
      JOIN (SELECT order_id, coalesce(reason_clean, '(none)') AS reason, sum(refund_amount_idr) AS refund
            FROM stg_returns GROUP BY ALL) USING (order_id) GROUP BY ALL) r USING (product_id)""",
)(lambda i: reports.product_return_rate(i.raw("raw_order_items"), i.returns(), i.products()))
register(
    "gmv_by_period",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS period, cast(date_trunc('{p}', order_date) AS DATE) AS period_start, channel,
  shipping_city, round(sum(gross_amount), 4) AS gmv, count(*) AS n_orders FROM stg_orders GROUP BY ALL"""
        for p in ("day", "week", "month")
    ),
)(lambda i: rounded(reports.gmv_by_period(i.orders()), "gmv"))
register(
    "ever_changed_customers",
    """SELECT status, count(*) AS n_customers FROM (SELECT customer_id,
  CASE WHEN count(*) > 1 THEN 'Pernah berubah' ELSE 'Tidak berubah' END AS status
  FROM customer_history GROUP BY customer_id) GROUP BY status""",
)(lambda i: reports.ever_changed_customers(i.history()))
# The report shows one customer; which one is its parameter.
register("customer_versions", "SELECT * FROM history_features WHERE customer_id = 1 ORDER BY valid_from")(
    lambda i: reports.customer_versions(i.history_features(), 1)
)


# --- loading and stateful operators ---------------------------------------


def _slice(df: DataFrame, column: str, before: str | None = None, since: str | None = None) -> DataFrame:
    if before is not None:
        df = df.where(F.col(column) < before)
    return df if since is None else df.where(F.col(column) >= since)


@register("full_refresh", "SELECT * FROM raw_orders")
def _full_refresh(i: Inputs) -> DataFrame:
    src, dst = i.scratch("landing"), i.scratch("table")
    parquet.write_flat(i.raw("raw_orders"), src)
    load.full_refresh(i.spark, src, dst)
    load.full_refresh(i.spark, src, dst)
    return parquet.read_table(i.spark, dst)


@register("incremental_load", "SELECT * FROM raw_orders")
def _incremental_load(i: Inputs) -> DataFrame:
    src, dst = i.scratch("landing"), i.scratch("table")
    orders = i.raw("raw_orders")
    parquet.write_flat(_slice(orders, "ingested_at", before="1998-01-01"), src)
    load.incremental_load(i.spark, src, dst)
    parquet.write_flat(_slice(orders, "ingested_at", since="1998-01-01"), src, mode="append")
    load.incremental_load(i.spark, src, dst)
    load.incremental_load(i.spark, src, dst)
    return parquet.read_table(i.spark, dst)


@register("replace_table", "SELECT * FROM raw_customers_2")
def _replace_table(i: Inputs) -> DataFrame:
    dst = i.scratch("table")
    for batch in (1, 2):
        src = i.scratch(f"batch-{batch}")
        parquet.write_flat(i.raw(f"raw_customers_{batch}"), src)
        load.replace_table(i.spark, src, dst)
    return parquet.read_table(i.spark, dst)


@register("write_partitioned", "SELECT *, cast(event_ts AS DATE) AS event_date_partition FROM raw_events")
def _write_partitioned(i: Inputs) -> DataFrame:
    base, events = i.scratch("events"), i.raw("raw_events")
    parquet.write_partitioned(events, base, "event_ts", "event_date_partition")
    return parquet.read_partitioned(i.spark, base, "event_date_partition", events.schema)


_CHANGED = """SELECT order_id, customer_id, order_status, net_amount, order_month FROM stg_monthly
  WHERE order_month < DATE '1999-01-01'
UNION ALL
SELECT order_id, customer_id, 'completed', net_amount, cast(order_month + INTERVAL 1 MONTH AS DATE)
FROM stg_monthly WHERE order_month >= DATE '1999-01-01'"""


def _monthly(i: Inputs) -> DataFrame:
    month = F.trunc("order_date", "month").alias("order_month")
    return i.orders().select("order_id", "customer_id", "order_status", "net_amount", month)


def _moved(i: Inputs) -> DataFrame:
    """Orders from 1999 on, all completed and one month later than before."""
    later = F.add_months("order_month", 1)
    recent = _monthly(i).where(F.col("order_month") >= "1999-01-01")
    return recent.withColumns({"order_status": F.lit("completed"), "order_month": later})


@register("upsert_delete_insert", _CHANGED)
def _upsert(i: Inputs) -> DataFrame:
    target = i.scratch("facts")
    upsert(i.spark, target, _monthly(i), ["order_id"], "order_month")
    upsert(i.spark, target, _moved(i), ["order_id"], "order_month")
    return read_target(i.spark, target)


@register(
    "evolve_append_new_columns",
    _CHANGED.replace("order_month FROM", "order_month, cast(NULL AS VARCHAR) AS reviewed_by FROM", 1)
    .replace("AS DATE)\nFROM", "AS DATE), 'finance'\nFROM"),
)
def _evolve(i: Inputs) -> DataFrame:
    target = i.scratch("facts")
    upsert(i.spark, target, _monthly(i), ["order_id"], "order_month")
    wider = _moved(i).withColumn("reviewed_by", F.lit("finance"))
    upsert(i.spark, target, wider, ["order_id"], "order_month")
    return read_target(i.spark, target)


@register(
    "lookback_filter",
    """SELECT * FROM stg_events WHERE cast(event_ts AS DATE) >=
  (SELECT max(cast(event_ts AS DATE)) - INTERVAL 3 DAY FROM stg_events
   WHERE event_ts < TIMESTAMP '2024-01-20 00:00:00')""",
)
def _lookback(i: Inputs) -> DataFrame:
    seen = i.raw("raw_events").select(staging.date_of("event_ts").alias("day"))
    loaded = seen.where(F.col("day") < "2024-01-20")
    dated = i.events().withColumn("day", F.col("event_ts").cast("date"))
    return incremental_filter(dated, loaded, "day", 3).drop("day")


def _two_order_runs(i: Inputs, lookback_days: int) -> DataFrame:
    """A first run on the orders up to 2000, a second on all of them."""
    target, orders = i.scratch("fct_orders"), i.orders()
    rest = (i.raw("raw_dim_customers"), i.payments(), RUN_AT)
    for seen in (_slice(orders, "updated_at", before="2000-01-01"), orders):
        job.refresh_orders(
            i.spark, target, seen, *rest, lookback_days=lookback_days, partition_col="order_month"
        )
    return rounded(read_target(i.spark, target), "total_paid")


register("fct_orders_upsert", round_sql("fct_orders", "total_paid"))(lambda i: _two_order_runs(i, 2))
register("fct_orders_incremental", round_sql("fct_orders", "total_paid"))(lambda i: _two_order_runs(i, 3))


@register("fct_orders_late_payments", round_sql("fct_orders", "total_paid"))
def _late_payments(i: Inputs) -> DataFrame:
    """Payments from 1999 on come in a second run, for orders of any age."""
    target, orders, payments = i.scratch("fct_orders"), i.orders(), i.payments()
    customers = i.raw("raw_dim_customers")
    early = _slice(payments, "ingested_at", before="1999-01-01")
    late = _slice(payments, "ingested_at", since="1999-01-01")
    for paid, new in ((early, None), (payments, late)):
        job.refresh_orders(
            i.spark, target, orders, customers, paid, RUN_AT, partition_col="order_month", new_payments=new
        )
    return rounded(read_target(i.spark, target), "total_paid")


@register("fct_orders_late_orders", round_sql("fct_orders", "total_paid"))
def _late_orders(i: Inputs) -> DataFrame:
    """A tenth of the orders of every age comes in a second run; their own change times are old."""
    target, orders = i.scratch("fct_orders"), i.orders()
    rest = (i.raw("raw_dim_customers"), i.payments(), RUN_AT)
    late = F.col("order_id") % 10 == 3
    job.refresh_orders(i.spark, target, orders.where(~late), *rest, partition_col="order_month")
    job.refresh_orders(i.spark, target, orders, *rest, partition_col="order_month", new_orders=orders.where(late))
    return rounded(read_target(i.spark, target), "total_paid")


@register("fct_orders_late_versions", round_sql("fct_orders", "total_paid"))
def _late_versions(i: Inputs) -> DataFrame:
    """The customers' versions of 1998 come in a second run, when orders up to 2001 are stored."""
    target, customers = i.scratch("fct_orders"), i.raw("raw_dim_customers")
    orders, payments = i.orders(), i.payments()
    early, late = _slice(customers, "ingested_at", before="1998"), _slice(customers, "ingested_at", since="1998")
    for known, new in ((early, None), (customers, late)):
        job.refresh_orders(
            i.spark, target, orders, known, payments, RUN_AT, partition_col="order_month", new_versions=new
        )
    return rounded(read_target(i.spark, target), "total_paid")


@register("fct_orders_full_refresh", round_sql("fct_orders", "total_paid"))
def _orders_full_refresh(i: Inputs) -> DataFrame:
    """Wrong amounts of old orders, which no lookback would reach, are put right by the full-refresh switch."""
    target, orders = i.scratch("fct_orders"), i.orders()
    rest = (i.raw("raw_dim_customers"), i.payments(), RUN_AT)
    wrong = orders.where(F.col("order_id") % 4 > 0).withColumn("net_amount", F.col("net_amount") * 2)
    job.refresh_orders(i.spark, target, wrong, *rest, partition_col="order_month")
    job.refresh_orders(i.spark, target, orders, *rest, partition_col="order_month", full=True)
    return rounded(read_target(i.spark, target), "total_paid")


@register("fct_events_upsert", "SELECT * FROM fct_events")
def _events_upsert(i: Inputs) -> DataFrame:
    target, events = i.scratch("fct_events"), i.raw("raw_events")
    for seen in (_slice(events, "event_ts", before="2024-01-20"), events):
        job.refresh_events(i.spark, target, seen, RUN_AT)
    return read_target(i.spark, target)


@register("fct_revenue_daily_incremental", round_sql("fct_revenue_daily", *REVENUE_MONEY, **PER_ORDER))
def _revenue_incremental(i: Inputs) -> DataFrame:
    """Returns of 2000 and later come in a second run and reach older days."""
    facts, target = i.scratch("facts"), i.scratch("revenue")
    parquet.write_flat(i.fct_orders(), facts)
    orders = parquet.read_table(i.spark, facts)
    returns = i.returns()
    early = returns.where(F.col("return_date") < "2000-01-01")
    late = returns.where(F.col("return_date") >= "2000-01-01")
    job.refresh_revenue(i.spark, target, orders, early, RUN_AT)
    days = job.days_of_returns(orders, late)
    job.refresh_revenue(i.spark, target, orders, returns, RUN_AT, days)
    return rounded(job.read_revenue(i.spark, target), *REVENUE_MONEY, **PER_ORDER)


@register("scd2_snapshot", "SELECT * FROM customer_history")
def _scd2_snapshot(i: Inputs) -> DataFrame:
    target = i.scratch("history")
    for batch, now in enumerate(SNAPSHOT_RUNS, start=1):
        scd2_snapshot(i.spark, target, i.raw(f"raw_customers_{batch}"), "customer_id", now=now)
    return read_history(i.spark, target)


@register("scd2_snapshot_products_written", "SELECT * FROM product_history")
def _scd2_products(i: Inputs) -> DataFrame:
    """The product history as three runs write it, closed versions by month."""
    target = i.scratch("products")
    for batch, now in enumerate(SNAPSHOT_RUNS, start=1):
        scd2_snapshot(i.spark, target, i.raw(f"raw_products_{batch}"), "product_id", now=now)
    return read_history(i.spark, target)


register("scd2_snapshot_products", "SELECT * FROM product_history")(
    lambda i: i.history("raw_products", "product_id")
)


@register("customer_rfm_incremental", round_sql("customer_rfm", "total_spent"))
def _rfm_incremental(i: Inputs) -> DataFrame:
    """The state of 2000 and later comes in a second run, which reads those months of the orders only."""
    facts, months = i.scratch("facts"), i.scratch("months")
    replace_partitions(i.spark, i.fct_orders(), facts, "order_month")
    orders = read_target(i.spark, facts)
    late = F.col(job.DAY) >= "2000-01-01"
    job.refresh_customer_months(i.spark, months, orders.where(~late))
    days = distinct_values(orders.where(late), job.DAY)
    job.refresh_customer_months(i.spark, months, orders, days)
    return rounded(marts.rfm_of_months(read_target(i.spark, months), ORDERS_DAY), "total_spent")


@register("funnel_conversion_incremental", _FUNNEL)
def _funnel_incremental(i: Inputs) -> DataFrame:
    """Events from 20 January on come in a second run, and so do some of 5 January."""
    target, facts = i.scratch("funnel"), i.scratch("events")
    replace_partitions(i.spark, i.fct_events(), facts, "event_date")
    events = read_target(i.spark, facts)
    early = (F.col("event_date") < "2024-01-20") & ~((F.col("event_date") == "2024-01-05") & (F.col("event_hour") > 12))
    job.refresh_funnel(i.spark, target, events.where(early), RUN_AT)
    job.refresh_funnel(i.spark, target, events, RUN_AT, distinct_values(events.where(~early), "event_date"))
    return job.read_daily(i.spark, target)


@register(
    "customers_by_period",
    """SELECT period, period_start, channel, count(DISTINCT customer_id) AS n_customers, TRUE AS within_bound
FROM (SELECT 'week' AS period, cast(date_trunc('week', order_date) AS DATE) AS period_start, * FROM fct_orders
  UNION ALL SELECT 'month', cast(date_trunc('month', order_date) AS DATE), * FROM fct_orders)
WHERE is_completed GROUP BY ALL""",
)
def _customers_by_period(i: Inputs) -> DataFrame:
    """Exact counts, and whether the estimate from the days' stored sketches is within five times its error of them."""
    stored, orders = i.scratch("sketches"), i.fct_orders()
    parquet.write_flat(marts.customer_sketches(orders), stored)
    keys = ["period", "period_start", "channel"]
    about = marts.customers_by_period(parquet.read_table(i.spark, stored)).withColumnRenamed("n_customers", "about")
    listed = F.array(*(F.struct(F.lit(p).alias("period"), F.trunc("order_date", p).alias("period_start")) for p in ("week", "month")))
    exact = orders.where("is_completed").select("channel", "customer_id", F.inline(listed))
    exact = exact.groupBy(*keys).agg(F.count_distinct("customer_id").alias("n_customers"))
    bound = 5 * 1.04 / 2**6
    near = F.abs(F.col("about") / F.col("n_customers") - 1) <= bound
    return exact.join(about, keys, "left").select(*keys, "n_customers", F.coalesce(near, F.lit(False)).alias("within_bound"))


# --- guards, registry, materialization ------------------------------------

_LANDED = {"fact_orders": ("raw_orders", "order_date"), "fact_payments": ("raw_payments", "payment_date"), "raw_returns": ("raw_returns", None)}


def _land(i: Inputs, base: str) -> None:
    """Some sources in the layout their specifications name; dated ones by month, to keep the folders few."""
    for name, (binding, at) in _LANDED.items():
        spec = SOURCES[name]
        df = i.raw(binding)
        df = df.select(*(F.col(f.name).cast(f.dataType) for f in spec.schema if f.name in df.columns))
        if at is None:
            parquet.write_flat(df, spec.location(base))
        else:
            month = F.trunc(F.col(at).cast("timestamp_ntz"), "month").cast("string")
            parquet.write_partitioned(df.withColumn("_at", month), spec.location(base), "_at", spec.partition_col)


@register(
    "source_registry",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS source, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys FROM {binding}"
        for name, binding, key in (
            ("fact_orders", "raw_orders", "order_id"),
            ("fact_payments", "raw_payments", "payment_id"),
            ("raw_returns", "raw_returns", "return_ref"),
        )
    ),
)
def _source_registry(i: Inputs) -> DataFrame:
    """Sources read back by name through their specifications: path, partition column, schema, keys."""
    base = i.scratch("landing")
    _land(i, base)
    keys = {name: (SOURCES[name].keys or ("return_ref",))[0] for name in _LANDED}
    counted = [
        SOURCES[name].read(i.spark, base).agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys")
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@register(
    "existence_guards",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS source, FALSE AS stood_before, 'full_refresh' AS first_load, 'appended' AS second_load,"
        f" TRUE AS stands_after, count(*) AS n_rows FROM {binding}"
        for name, (binding, _) in _LANDED.items()
    )
    + "\nUNION ALL SELECT 'fact_events', FALSE, 'skipped', 'skipped', FALSE, 0",
)
def _existence_guards(i: Inputs) -> DataFrame:
    """Loads that ask first whether source and target are there; the events' source is not."""
    base, out = i.scratch("landing"), []
    _land(i, base)
    for name in (*_LANDED, "fact_events"):
        src, dst = SOURCES[name].location(base), i.scratch(name)
        stood = storage.table_exists(i.spark, dst)
        loads = [load.incremental_load(i.spark, src, dst) for _ in range(2)]
        stands = storage.table_exists(i.spark, dst)
        rows = parquet.read_table(i.spark, dst) if stands else i.spark.range(0)
        told = [F.lit(name).alias("source"), F.lit(stood).alias("stood_before"), F.lit(loads[0]).alias("first_load")]
        told += [F.lit(loads[1]).alias("second_load"), F.lit(stands).alias("stands_after")]
        out.append(rows.agg(F.count(F.lit(1)).alias("n_rows")).select(*told, "n_rows"))
    return reduce(DataFrame.unionByName, out)


@register(
    "materialize",
    """SELECT kind, order_status, count(*) AS n_orders FROM stg_orders, (VALUES ('inline'), ('table'), ('view')) t(kind)
GROUP BY ALL""",
)
def _materialize(i: Inputs) -> DataFrame:
    """One model in the three ways to expose it."""
    out = []
    for kind in ("inline", "table", "view"):
        name = f"stg_orders_{kind}_{uuid.uuid4().hex[:8]}"
        model = load.materialize(i.orders(), name, kind, folder=i.scratch("tables"))
        out.append(model.groupBy("order_status").agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n_orders")))
    return reduce(DataFrame.unionByName, out)


# --- hot paths: limits so low that most keys with several rows count as hot ---

_EAGER = HotKeys(share=0.02)

register("pit_join_hot", round_sql("enriched_half_open", "total_paid"))(
    lambda i: rounded(i.enriched(one_version=False, limits=_EAGER), "total_paid")
)
register("lookup_join_hot", "SELECT * FROM stg_order_items")(
    lambda i: staging.stg_order_items(i.raw("raw_order_items"), i.orders(), _EAGER)
)
register("neighbour_hot", "SELECT * FROM stg_customers")(
    lambda i: staging.stg_customers(i.raw("raw_dim_customers"), _EAGER)
)


# --- checks ---------------------------------------------------------------


@register(
    "fail_fast_checks",
    """SELECT 'raw_orders' AS table_name, 'raw_orders.shipping_city not_null: ' || n AS finding
FROM (SELECT count(*) AS n FROM raw_orders WHERE shipping_city IS NULL) WHERE n > 0
UNION ALL SELECT 'raw_returns', 'raw_returns.currency accepted_values: ' || n
FROM (SELECT count(*) AS n FROM raw_returns WHERE currency NOT IN ('IDR', 'USD')) WHERE n > 0
UNION ALL SELECT 'raw_payments', NULL""",
)
def _fail_fast(i: Inputs) -> DataFrame:
    """What a fail-fast run raises for each table, and that it passes a table without findings."""
    declared = {
        "raw_orders": [checks.not_null("shipping_city"), checks.not_null("order_id")],
        "raw_returns": [checks.accepted("currency", "IDR", "USD")],
        "raw_payments": [checks.not_null("payment_id"), checks.not_null("order_id")],
    }
    found = []
    for name, rules in declared.items():
        try:
            checks.run_checks(i.raw(name), name, rules, fail_fast=True)
            found.append((name, None))
        except checks.CheckFailed as failed:
            found.append((name, str(failed)))
    return i.spark.createDataFrame(found, "table_name string, finding string")



register("check_not_null", "SELECT * FROM raw_orders WHERE shipping_city IS NULL")(
    lambda i: checks.check_not_null(i.raw("raw_orders"), "shipping_city")
)
register(
    "check_unique",
    "SELECT item_id, count(*) AS n_rows FROM raw_order_items GROUP BY item_id HAVING count(*) > 1",
)(lambda i: checks.check_unique(i.raw("raw_order_items"), ["item_id"]))
register("check_accepted", "SELECT * FROM raw_returns WHERE currency NOT IN ('IDR', 'USD')")(
    lambda i: checks.check_accepted(i.raw("raw_returns"), "currency", ["IDR", "USD"])
)
register("check_between", "SELECT * FROM raw_order_items WHERE quantity < 1 OR quantity > 10")(
    lambda i: checks.check_between(i.raw("raw_order_items"), "quantity", 1, 10)
)
register(
    "check_regex",
    r"SELECT * FROM raw_dim_customers WHERE NOT regexp_matches(email, '^[^@]+@[^@]+\.[^@]+$')",
)(lambda i: checks.check_regex(i.raw("raw_dim_customers"), "email", r"^[^@]+@[^@]+\.[^@]+$"))
register(
    "assert_row_count",
    """SELECT 'stg_orders' AS model_name, count(*) AS actual_rows, cast(4000 AS BIGINT) AS expected_min_rows,
  if(count(*) >= 4000, 'PASS', 'FAIL') AS result FROM stg_orders""",
)(lambda i: checks.assert_row_count(i.orders(), "stg_orders", 4000))
register("enforce_contract", "SELECT * FROM dim_customers_scd")(
    lambda i: enforce_contract(
        marts.dim_customers_scd(i.customers(), EVENTS_DAY), contracts.DIM_CUSTOMERS_SCD
    )
)

_CHECKED = {
    "fact_orders": ("raw_orders", lambda i: i.raw("raw_orders")),
    "fact_order_items": ("raw_order_items", lambda i: i.raw("raw_order_items")),
    "dim_customers": ("raw_dim_customers", lambda i: i.raw("raw_dim_customers")),
    "dim_products": ("raw_dim_products", lambda i: i.raw("raw_dim_products")),
    "dim_stores": ("raw_dim_stores", lambda i: i.raw("raw_dim_stores")),
    "fact_payments": ("raw_payments", lambda i: i.raw("raw_payments")),
    "fact_events": ("raw_events", lambda i: i.raw("raw_events")),
    "raw_returns": ("raw_returns", lambda i: i.raw("raw_returns")),
    "raw_customers_current": ("raw_customers_3", lambda i: i.raw("raw_customers_3")),
    "raw_products_current": ("raw_products_3", lambda i: i.raw("raw_products_3")),
    "stg_orders": ("stg_orders", lambda i: i.orders()),
    "stg_order_items": ("stg_order_items", lambda i: i.items()),
    "stg_customers": ("stg_customers", lambda i: i.customers()),
    "stg_products": ("stg_products", lambda i: i.products()),
    "stg_payments": ("stg_payments", lambda i: i.staged_payments()),
    "stg_events": ("stg_events", lambda i: i.events()),
    "stg_returns": ("stg_returns", lambda i: i.returns()),
    "stg_customers_snapshot": ("history_features", lambda i: i.history_features()),
}


def _sql_literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _check_sql(table: str, source: str, check: checks.Check) -> str:
    column = check.column
    if check.kind == "unique":
        failing = (
            f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
        )
        condition = "TRUE"
    else:
        failing = source
        condition = {
            "not_null": f"{column} IS NULL",
            "accepted_values": f"{column} NOT IN ({', '.join(map(_sql_literal, check.values))})",
            "regex": f"NOT regexp_matches({column}, '{check.pattern}')",
            "between": " OR ".join(
                f"{column} {op}{'=' if check.strict else ''} {_sql_literal(bound)}"
                for op, bound in (("<", check.low), (">", check.high))
                if bound is not None
            ),
        }[check.kind]
    return (
        f"SELECT '{table}' AS table_name, '{check.kind}' AS check_name, '{column}' AS column_name,"
        f" count(*) AS n_failed FROM {failing} WHERE {condition}"
    )


def _register_checks(name: str, declared: dict[str, list[checks.Check]]) -> None:
    sql = "\nUNION ALL ".join(_check_sql(t, _CHECKED[t][0], c) for t, cs in declared.items() for c in cs)

    def build(i: Inputs) -> DataFrame:
        summaries = [checks.run_checks(_CHECKED[t][1](i), t, cs) for t, cs in declared.items()]
        return reduce(DataFrame.unionByName, summaries)

    register(name, sql)(build)


def _register_observed(name: str, declared: dict[str, list[checks.Check]]) -> None:
    by_row = {t: [c for c in cs if c.kind != "unique"] for t, cs in declared.items()}
    sql = "\nUNION ALL ".join(_check_sql(t, _CHECKED[t][0], c) for t, cs in by_row.items() for c in cs)

    def build(i: Inputs) -> DataFrame:
        """The row conditions, counted while each table is written; no table is read for them."""
        summaries = []
        for t, cs in by_row.items():
            if cs:
                counted, summary = checks.observed(_CHECKED[t][1](i), t, cs)
                parquet.write_flat(counted, i.scratch(t))
                summaries.append(summary())
        return reduce(DataFrame.unionByName, summaries)

    register(name, sql)(build)


_register_observed("staging_checks_observed", STAGING_CHECKS)
_register_checks("source_checks", SOURCE_CHECKS)
_register_checks("staging_checks", STAGING_CHECKS)


# --- column functions -----------------------------------------------------

_LOOSE = RfmConfig(recency_days=(90, 180, 365, 730), frequency_orders=(15, 12, 8, 4))


@register(
    "rfm_scores",
    f"""SELECT customer_id,
  CASE WHEN days <= 90 THEN 5 WHEN days <= 180 THEN 4 WHEN days <= 365 THEN 3 WHEN days <= 730 THEN 2
    ELSE 1 END AS recency_score,
  CASE WHEN n >= 15 THEN 5 WHEN n >= 12 THEN 4 WHEN n >= 8 THEN 3 WHEN n >= 4 THEN 2 ELSE 1 END
    AS frequency_score,
  CASE WHEN gross >= 5000000 THEN 5 WHEN gross >= 2000000 THEN 4 WHEN gross >= 1000000 THEN 3
    WHEN gross >= 500000 THEN 2 ELSE 1 END AS monetary_score
FROM (SELECT customer_id, date_diff('day', max(order_date), {ORDERS_AS_OF}) AS days, count(*) AS n,
  sum(gross_amount) AS gross FROM stg_orders GROUP BY customer_id)""",
)
def _rfm_scores(i: Inputs) -> DataFrame:
    per_customer = (
        i.orders()
        .groupBy("customer_id")
        .agg(
            F.datediff(F.lit(ORDERS_DAY), F.max("order_date")).alias("days"),
            F.count(F.lit(1)).alias("n"),
            F.sum("gross_amount").alias("gross"),
        )
    )
    return per_customer.select(
        "customer_id",
        rfm_recency_score(F.col("days"), _LOOSE).alias("recency_score"),
        rfm_frequency_score(F.col("n"), _LOOSE).alias("frequency_score"),
        rfm_monetary_score(F.col("gross"), _LOOSE).alias("monetary_score"),
    )


register(
    "to_idr",
    """SELECT return_ref, refund_amount * CASE upper(currency) WHEN 'USD' THEN 16200 ELSE 1 END AS refund_idr
FROM raw_returns""",
)(
    lambda i: i.raw("raw_returns").select(
        "return_ref", to_idr(F.col("refund_amount"), F.col("currency"), {"USD": 16200}).alias("refund_idr")
    )
)
register(
    "generation_cohort",
    f"""SELECT customer_key, {oracle._COHORT.format(dob="date_of_birth")} AS generation_cohort
FROM raw_dim_customers""",
)(
    lambda i: i.raw("raw_dim_customers").select(
        "customer_key",
        generation_cohort(F.year(staging.date_of("date_of_birth"))).alias("generation_cohort"),
    )
)
register(
    "cohort_by_age",
    f"""SELECT customer_key, {oracle._AGE_COHORT.format(dob="date_of_birth")} AS generation_cohort
FROM raw_dim_customers""",
)(
    lambda i: i.raw("raw_dim_customers").select(
        "customer_key",
        cohort_by_age(years_between(staging.date_of("date_of_birth"), F.lit(EVENTS_DAY))).alias(
            "generation_cohort"
        ),
    )
)
register(
    "safe_divide",
    """SELECT item_id, product_id, CASE WHEN unit_price = 0 THEN NULL ELSE round(discount / unit_price, 4) END
  AS ratio FROM raw_order_items""",
)(
    lambda i: i.raw("raw_order_items").select(
        "item_id", "product_id", safe_divide(F.col("discount"), F.col("unit_price")).alias("ratio")
    )
)
register("cents_to_idr", "SELECT c_custkey, round(c_acctbal / 100.0, 2) AS idr FROM customer")(
    lambda i: i.table("customer").select("c_custkey", cents_to_idr(F.col("c_acctbal")).alias("idr"))
)
register(
    "is_late_arriving_grace",
    """SELECT p.payment_id, p.order_id, p.payment_ts < o.order_ts - INTERVAL 1440 MINUTE AS is_late
FROM typed_payments p JOIN stg_orders o ON o.order_id = p.order_id""",
)(
    lambda i: i.payments()
    .join(i.orders().select("order_id", "order_ts"), "order_id")
    .select(
        "payment_id",
        "order_id",
        is_late_arriving(F.col("payment_ts"), F.col("order_ts"), 1440).alias("is_late"),
    )
)


@register(
    "date_spine",
    """SELECT cast(d.day AS DATE) AS date_day, coalesce(r.n_orders, 0) AS n_orders,
  coalesce(round(r.net, 4), 0) AS net_revenue
FROM (SELECT unnest(generate_series((SELECT min(order_date) FROM stg_orders),
        (SELECT max(order_date) FROM stg_orders), INTERVAL 1 DAY)) AS day) d
LEFT JOIN (SELECT order_date, count(*) AS n_orders, sum(net_amount) AS net FROM stg_orders
           WHERE order_status = 'completed' GROUP BY order_date) r ON r.order_date = cast(d.day AS DATE)""",
)
def _date_spine(i: Inputs) -> DataFrame:
    orders = i.orders()
    first, last = orders.agg(F.min("order_date"), F.max("order_date")).first()
    daily = (
        orders.where(F.col("order_status") == "completed")
        .groupBy(F.col("order_date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("net_amount"), 4).alias("net_revenue"))
    )
    spine = date_spine(i.spark, first, last)
    return spine.join(daily, "date_day", "left").fillna(0, ["n_orders", "net_revenue"])


register(
    "surrogate_key",
    """SELECT order_id, md5(cast(order_id AS VARCHAR) || '-' ||
  coalesce(shipping_city, '_dbt_utils_surrogate_key_null_')) AS sk FROM raw_orders""",
)(lambda i: i.raw("raw_orders").select("order_id", surrogate_key("order_id", "shipping_city").alias("sk")))


# --- streaming ------------------------------------------------------------


def _event_files(i: Inputs) -> tuple[str, DataFrame, DataFrame]:
    """Landing folder, and the events before and after mid January."""
    events = i.raw("raw_events")
    cut = "2024-01-15"
    return i.scratch("landing"), _slice(events, "event_ts", before=cut), _slice(events, "event_ts", since=cut)


@register("stream_ingest", "SELECT * FROM raw_events")
def _stream_ingest(i: Inputs) -> DataFrame:
    src, first, second = _event_files(i)
    dst, progress = i.scratch("table"), i.scratch("progress")
    for arrived in (first, second):
        parquet.write_flat(arrived, src, mode="append")
        stream_ingest(i.spark, src, dst, first.schema, progress).awaitTermination()
    return parquet.read_table(i.spark, dst, first.schema)


@register("stream_dedup_events", "SELECT * FROM stg_events")
def _stream_dedup(i: Inputs) -> DataFrame:
    src, first, second = _event_files(i)
    dst, progress = i.scratch("table"), i.scratch("progress")
    for arrived in (first, second):
        parquet.write_flat(arrived, src, mode="append")
        source = i.spark.readStream.schema(first.schema).parquet(src)
        query = (
            stream_dedup_events(source)
            .writeStream.format("parquet")
            .option("path", dst)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return parquet.read_table(i.spark, dst)


@register(
    "stream_late_events",
    """SELECT event_id, CASE WHEN odd OR cast(event_ts AS TIMESTAMP) >= newest - INTERVAL 3 DAY THEN 'target' ELSE 'late' END AS place,
  count(DISTINCT event_id) AS n
FROM (SELECT *, cast(substr(event_id, 2) AS BIGINT) % 2 = 1 AS odd FROM raw_events),
  (SELECT max(cast(event_ts AS TIMESTAMP)) AS newest FROM raw_events WHERE cast(substr(event_id, 2) AS BIGINT) % 2 = 1)
GROUP BY ALL""",
)
def _stream_late(i: Inputs) -> DataFrame:
    """Events with odd ids come first, those with even ids after them: most are late, and every id is in one place."""
    events, src = i.raw("raw_events"), i.scratch("landing")
    target, late, progress = i.scratch("target"), i.scratch("late"), i.scratch("progress")
    odd = F.substring("event_id", 2, 20).cast("long") % 2 == 1
    day = F.to_date(F.col("event_ts").cast("timestamp_ntz"))
    for arrived in (events.where(odd), events.where(~odd)):
        parquet.write_flat(arrived, src, mode="append")
        source = i.spark.readStream.schema(events.schema).parquet(src).withColumn("day", day)
        stream_dedup_with_late(source, target, late, ["event_id"], "event_ts", "day", progress).awaitTermination()
    places = [
        table.groupBy("event_id").agg(F.lit(name).alias("place"), F.count_distinct("event_id").alias("n"))
        for name, table in (("target", read_target(i.spark, target)), ("late", i.spark.read.schema(events.schema).parquet(late)))
    ]
    return places[0].unionByName(places[1])


@register("stream_upsert", "SELECT * FROM fct_events")
def _stream_upsert(i: Inputs) -> DataFrame:
    """The second arrival repeats known ids with a later time and another session."""
    src, first, second = _event_files(i)
    target, progress = i.scratch("fct_events"), i.scratch("progress")
    later = (F.col("event_ts").cast("timestamp_ntz") + F.expr("INTERVAL 20 DAYS")).cast("string")
    again = first.where(F.col("event_id").endswith("7"))
    second = second.unionByName(again.withColumns({"event_ts": later, "session_id": F.lit("late copy")}))
    for arrived in (first, second):
        parquet.write_flat(arrived, src, mode="append")
        source = i.spark.readStream.schema(first.schema).parquet(src)
        stream_upsert(
            source,
            target,
            ["event_id"],
            "event_date",
            progress,
            lambda rows: marts.fct_events(staging.stg_events(rows), RUN_AT),
        ).awaitTermination()
    return read_target(i.spark, target)


assert EVENTS_AS_OF == f"DATE '{EVENTS_DAY}'" and ORDERS_AS_OF == f"DATE '{ORDERS_DAY}'"
