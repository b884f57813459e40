"""The end-to-end run: load, snapshot, build, audit.

Everything else in the package maps DataFrames to DataFrames; the functions
here and the writers are what starts Spark jobs.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions import RfmConfig
from cartwright.operators.lookback import (
    EPOCH,
    lookback_filter,
    lower_bound,
    max_timestamp,
)
from cartwright.operators.propagate import facts_in_changed_ranges
from cartwright.operators.snapshot import read_history, scd2_snapshot
from cartwright.operators.upsert import upsert
from cartwright.plans import enrich, marts, reports, staging
from cartwright.sources import ledger, storage
from cartwright.sources.parquet import balanced
from cartwright.sources.load import (
    full_refresh,
    incremental_load,
    rebuild,
    replace_table,
)
from cartwright.sources.publish import (
    distinct_values,
    finish_pending,
    in_partitions,
    read_target,
    replace_partitions,
    written_copy,
)
from cartwright.sources.registry import SOURCES

DAY = "order_date_day"
MONTH = "date_month"


@dataclass(frozen=True)
class JobConfig:
    landing: str
    warehouse: str
    run_ts: dt.datetime
    as_of: dt.date
    full_refresh: bool = False
    events_lookback_days: int = 3
    load_lookback_days: int = 3
    rfm: RfmConfig = field(default_factory=RfmConfig)

    def raw(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/raw/{name}"

    def mart(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/marts/{name}"

    def history(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/snapshots/{name}"


def load_main_tables(spark: SparkSession, config: JobConfig) -> dict[str, str]:
    """Load every dated source; what was done, per source."""
    done = {}
    for name, spec in SOURCES.items():
        if spec.batched:
            continue
        src, dst = spec.location(config.landing), config.raw(name)
        if config.full_refresh:
            done[name] = full_refresh(spark, src, dst, spec.partition_col)
        else:
            lookback = f"{config.load_lookback_days} days"
            done[name] = incremental_load(spark, src, dst, lookback=lookback, partition_col=spec.partition_col)
    return done


def take_snapshots(spark: SparkSession, config: JobConfig, batch: int) -> None:
    """Replace the current-state tables by a batch and update their histories."""
    for name, key, history in (
        ("raw_customers_current", "customer_id", "snp_customers"),
        ("raw_products_current", "product_id", "snp_products"),
    ):
        replace_table(spark, SOURCES[name].location(config.landing, batch), config.raw(name))
        source = spark.read.schema(SOURCES[name].schema).parquet(config.raw(name))
        scd2_snapshot(spark, config.history(history), source, key, now=config.run_ts)


def raw_table(spark: SparkSession, config: JobConfig, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name].schema).parquet(config.raw(name))


def _of(facts: DataFrame, orders: DataFrame, key: str = "order_id") -> DataFrame:
    """The rows that belong to some orders.  When those are few, Spark sends
    their keys to the rows, before these are shuffled."""
    return facts.join(orders.select(key), key, "left_semi")


def refresh_orders(
    spark: SparkSession,
    target: str,
    orders: DataFrame,
    raw_customers: DataFrame,
    payments: DataFrame,
    run_ts: dt.datetime,
    *,
    lookback_days: int = 2,
    full: bool = False,
    partition_col: str = DAY,
    new_payments: DataFrame | None = None,
    new_versions: DataFrame | None = None,
    new_orders: DataFrame | None = None,
) -> list:
    """Upsert recently changed orders into the fact table; the touched partitions.

    The lower bound is applied to the orders before anything is joined, and
    only their customers' versions and their payments are looked at.

    ``new_orders`` are the orders loaded since the last build, whenever they say they changed; without
    them those count that changed since the table's newest change, less the lookback.
    ``new_payments`` and ``new_versions`` (raw customers) are those loaded since the last
    build: the orders paid by them, and the orders of the time they cover, are computed again, however old.
    """
    finish_pending(spark, target)
    stored = None if full else read_target(spark, target)

    def apply(some: DataFrame, their_customers: DataFrame, their_payments: DataFrame) -> list:
        customers = staging.stg_customers(their_customers)
        # Brought together before the fact's hashed key is added, which would be most of what is shuffled.
        enriched = balanced(enrich.orders_enriched(some, customers, their_payments, one_version=True), partition_col)
        return upsert(spark, target, marts.fct_orders(enriched, run_ts), ["order_id"], partition_col, arranged=True)

    if stored is None:
        return apply(orders, raw_customers, payments)
    recent, again = new_orders, []
    if recent is None:
        newest = max_timestamp(stored, "updated_at")
        if newest == EPOCH:
            return apply(orders, raw_customers, payments)
        recent = lookback_filter(orders, "updated_at", newest, lookback_days)
    if new_payments is not None:
        again.append(_of(orders, new_payments))
    if new_versions is not None:
        dated, late = (df.withColumn("_from", staging.timestamp_of("valid_from")) for df in (raw_customers, new_versions))
        again.append(facts_in_changed_ranges(orders, dated, late, "customer_id", "order_ts", "_from", day="order_date"))
    # An order with several reasons is taken once, by the first.
    taken = recent.select("order_id")
    for some in again:
        recent = recent.unionByName(some.join(taken, "order_id", "left_anti").select(*recent.columns))
        taken = taken.unionByName(some.select("order_id"))
    with written_copy(spark, recent) as some:
        return apply(some, _of(raw_customers, some, "customer_id"), _of(payments, some))


def refresh_events(
    spark: SparkSession,
    target: str,
    raw_events: DataFrame,
    run_ts: dt.datetime,
    *,
    lookback_days: int = 3,
    full: bool = False,
) -> list:
    """Upsert the events of the last days; the touched days.

    Raw events are cut before they are deduplicated, by their date folder
    where they have one.  An event first seen before the cut is in the table
    already and is not replaced by its later duplicate.
    """
    finish_pending(spark, target)
    stored = read_target(spark, target)
    newest = EPOCH if full else max_timestamp(stored, "event_date")
    if newest == EPOCH:
        return upsert(spark, target, marts.fct_events(staging.stg_events(raw_events), run_ts), ["event_id"], "event_date")
    recent = lookback_filter(raw_events, "event_ts", newest, lookback_days)
    since = lower_bound(newest, lookback_days).date()
    folder = SOURCES["fact_events"].partition_col
    if folder in raw_events.columns:
        recent = recent.where(F.col(folder) >= F.lit(since))
    seen = stored.where(F.col("event_date") < F.lit(since)).select("event_id")
    events = staging.stg_events(recent).join(seen, "event_id", "left_anti")
    return upsert(spark, target, marts.fct_events(events, run_ts), ["event_id"], "event_date")


def days_of_returns(orders: DataFrame, new_returns: DataFrame) -> list:
    """Order days that new returns refer to."""
    returned = new_returns.select("order_id").distinct()
    return distinct_values(orders.select("order_id", DAY).join(returned, "order_id", "left_semi"), DAY)


def refresh_revenue(
    spark: SparkSession,
    target: str,
    orders: DataFrame,
    returns: DataFrame,
    run_ts: dt.datetime,
    affected_days: Iterable | None = None,
) -> None:
    """Recompute the revenue of whole order days.

    ``affected_days`` are the days whose orders changed and the order days of
    new returns, however old; with None every day is computed.  Recomputing a
    day from all its orders and returns makes an incremental run equal to a
    full one.  The table is small next to the facts and stored by month: the
    other days of a touched month are copied, not recomputed.
    """

    def of_days(days: set | None) -> DataFrame:
        if days is None:
            return marts.revenue_daily(orders, returns, run_ts)
        affected = orders.where(in_partitions(DAY, days))
        return marts.revenue_daily(affected, _of(returns, affected), run_ts)

    _replace_days(spark, target, of_days, "date_day", affected_days)


def refresh_funnel(
    spark: SparkSession, target: str, events: DataFrame, run_ts: dt.datetime, affected_days: Iterable | None = None
) -> None:
    """Recompute the funnel of whole event days, like ``refresh_revenue``; sessions and users are distinct within a day,
    so no other day is read."""

    def of_days(days: set | None) -> DataFrame:
        some = events if days is None else events.where(in_partitions("event_date", days))
        return marts.funnel_conversion(some, run_ts)

    _replace_days(spark, target, of_days, "event_date", affected_days)


def _replace_days(
    spark: SparkSession, target: str, of_days: Callable[[set | None], DataFrame], day: str, affected_days: Iterable | None
) -> None:
    """Put ``of_days`` of the affected days in their place in a table by month; None means all days."""
    finish_pending(spark, target)
    stored = read_target(spark, target)
    if affected_days is None or stored is None or MONTH not in stored.columns:
        fresh = _by_month(of_days(None), day)
        months = set() if stored is None or MONTH not in stored.columns else set(distinct_values(stored, MONTH))
        if stored is not None and MONTH not in stored.columns:
            storage.delete(spark, target)  # A table from before it was kept by month.
    else:
        days = set(affected_days)
        if not days:
            return
        months = {None if one is None else one.replace(day=1) for one in days}
        recomputed = F.coalesce(in_partitions(day, days), F.lit(False))
        copied = stored.where(in_partitions(MONTH, months)).where(~recomputed)
        fresh = copied.unionByName(_by_month(of_days(days), day))
    replace_partitions(spark, fresh, target, MONTH, months)


def refresh_customer_months(spark: SparkSession, target: str, orders: DataFrame, affected_days: Iterable | None = None) -> None:
    """Recompute what customers did in whole months; only those months' orders are read."""
    finish_pending(spark, target)
    stored = read_target(spark, target)
    if affected_days is None or stored is None:
        months = set() if stored is None else set(distinct_values(stored, MONTH))
    else:
        months = {None if one is None else one.replace(day=1) for one in affected_days}
        if not months:
            return
        orders = orders.where(in_partitions(f"trunc({DAY}, 'month')", months))
    dated = orders.withColumn(MONTH, F.trunc(DAY, "month"))
    replace_partitions(spark, marts.customer_months(dated, MONTH), target, MONTH, months)


def _by_month(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(MONTH, F.trunc(day, "month"))


def read_daily(spark: SparkSession, target: str) -> DataFrame:
    """A mart of days that is stored by month."""
    return read_target(spark, target).drop(MONTH)


read_revenue = read_daily


def _build_mark(config: JobConfig) -> str:
    return config.mart("_built.json")


#: Raw tables whose late rows change facts of any age.
MARKED = ("fact_orders", "fact_payments", "raw_returns", "dim_customers")


def build(spark: SparkSession, config: JobConfig) -> None:
    """Facts, dimension, revenue, RFM and funnel from the loaded raw tables.

    Which load of each raw table a finished build has seen is noted beside the marts at its end.  The
    next one takes what was loaded after that, by the tables' ledgers, so a run that dies
    anywhere in between is made up for by the next.  Without a note all is new.
    """
    orders = staging.stg_orders(raw_table(spark, config, "fact_orders"))
    raw_customers = raw_table(spark, config, "dim_customers")
    payments = staging.typed_payments(raw_table(spark, config, "fact_payments"))
    events = raw_table(spark, config, "fact_events")
    returns = staging.stg_returns(raw_table(spark, config, "raw_returns"))

    text = None if config.full_refresh else storage.read_text(spark, _build_mark(config))
    built = {} if text is None else json.loads(text).get("built", {})
    first = not built
    seen = {name: (ledger.commits(spark, config.raw(name)) or [None])[-1] for name in MARKED}
    new = {}
    if not first:
        new = {
            name: ledger.loaded_after(spark, config.raw(name), built.get(name), raw_table(spark, config, name).schema)
            for name in MARKED
        }

    touched = refresh_orders(
        spark,
        config.mart("fct_orders"),
        orders,
        raw_customers,
        payments,
        config.run_ts,
        full=first,
        new_orders=None if first else staging.stg_orders(new["fact_orders"]),
        new_payments=new.get("fact_payments"),
        new_versions=new.get("dim_customers"),
    )
    touched_events = refresh_events(
        spark,
        config.mart("fct_events"),
        events,
        config.run_ts,
        lookback_days=config.events_lookback_days,
        full=config.full_refresh,
    )
    facts = read_target(spark, config.mart("fct_orders"))
    stored_events = read_target(spark, config.mart("fct_events"))
    days = None
    if not first:
        days = set(touched) | set(days_of_returns(facts, new["raw_returns"]))

    order_days = None if first else touched
    refresh_customer_months(spark, config.mart("customer_months"), facts, order_days)
    customers = read_target(spark, config.mart("customer_months"))
    dimension = marts.dim_customers_scd(staging.stg_customers(raw_customers), config.as_of)
    scores = marts.rfm_of_months(customers, config.as_of, config.rfm)
    funnel_days = None if first else touched_events
    steps = [
        lambda: rebuild(dimension, config.mart("dim_customers_scd")),
        lambda: rebuild(scores, config.mart("fct_customer_rfm")),
        lambda: refresh_funnel(spark, config.mart("fct_funnel_conversion"), stored_events, config.run_ts, funnel_days),
        lambda: refresh_revenue(spark, config.mart("fct_revenue_daily"), facts, returns, config.run_ts, days),
    ]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for running in [pool.submit(step) for step in steps]:
            running.result()
    storage.write_text(spark, _build_mark(config), json.dumps({"built": seen}))


def audit(spark: SparkSession, config: JobConfig) -> DataFrame:
    """The data-quality audit over the loaded raw tables."""
    raw = {name: raw_table(spark, config, name) for name in SOURCES if not SOURCES[name].batched}
    orders = staging.stg_orders(raw["fact_orders"])
    return reports.dq_audit(
        {
            "orders": orders,
            "order_items": staging.stg_order_items(raw["fact_order_items"], orders),
            "payments": staging.stg_payments(raw["fact_payments"], orders),
            "customers": staging.stg_customers(raw["dim_customers"]),
            "returns": staging.stg_returns(raw["raw_returns"]),
            "events": raw["fact_events"],
        }
    )


def run(spark: SparkSession, config: JobConfig, batch: int | None = None) -> DataFrame:
    """Load, snapshot (when a batch is named), build; returns the audit."""
    load_main_tables(spark, config)
    if batch is not None:
        take_snapshots(spark, config, batch)
    build(spark, config)
    return audit(spark, config)


def customer_history(spark: SparkSession, config: JobConfig) -> DataFrame:
    history = read_history(spark, config.history("snp_customers"))
    return staging.customer_history_features(history, config.as_of)
