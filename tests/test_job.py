"""The whole job over files in landing layout: first run, incremental run."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import SMALL, rows, ts
from pyspark.sql import functions as F

from cartwright.plans import enrich, job, marts, reports, staging
from cartwright.plans.contracts import FCT_EVENTS, FCT_ORDERS
from cartwright.plans.declared_checks import SOURCE_CHECKS, STAGING_CHECKS
from cartwright.sources import SOURCES, parquet
from cartwright.sources.publish import read_target, replace_partitions
from workbench.bindings import raw

DATED = {
    "fact_orders": ("raw_orders", "order_date"),
    "fact_payments": ("raw_payments", "payment_date"),
    "fact_events": ("raw_events", "event_ts"),
}
FLAT = {
    "fact_order_items": "raw_order_items",
    "dim_customers": "raw_dim_customers",
    "dim_products": "raw_dim_products",
    "raw_returns": "raw_returns",
    "raw_inventory_feed": "raw_inventory_feed",
}


def orders_of_2001(spark):
    """Few enough order days for a quick run."""
    return raw(spark, SMALL, "raw_orders").where(F.col("order_date") >= "2001-01-01")


def shaped(df, spec):
    missing = {c: F.lit(None) for c in spec.schema.names if c not in df.columns}
    return df.withColumns(missing).select(*(F.col(f.name).cast(f.dataType) for f in spec.schema))


def land(spark, base, until=None):
    """Write the sources in landing layout, orders and payments by month to keep files few."""
    for name, (binding, at) in DATED.items():
        df = orders_of_2001(spark) if name == "fact_orders" else raw(spark, SMALL, binding)
        df = shaped(df, SOURCES[name])
        if until and name in ("fact_orders", "fact_payments"):
            df = df.where(F.col("ingested_at") < until)
        if until and name == "fact_events":
            df = df.where(F.col("ingested_at") < "2024-01-20")
        if name != "fact_events":
            month = F.trunc(F.col(at).cast("timestamp_ntz"), "month").cast("string")
            df, at = df.withColumn("_month", month), "_month"
        parquet.write_partitioned(df, SOURCES[name].location(base), at, SOURCES[name].partition_col)
    for name, binding in FLAT.items():
        df = shaped(raw(spark, SMALL, binding), SOURCES[name])
        if until and name == "raw_returns":
            df = df.where(F.col("ingested_at") < until)
        parquet.write_flat(df, SOURCES[name].location(base))
    stores = [(n, f"store {n}", "online", "p", None, "r", "2020-01-01", True) for n in range(1, 6)]
    parquet.write_flat(spark.createDataFrame(stores, SOURCES["dim_stores"].schema), SOURCES["dim_stores"].location(base))


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    first, second = str(base / "first"), str(base / "second")
    land(spark, first, until="2001-06-01")
    land(spark, second)
    for batch in (1, 2, 3):
        for name, binding in (("raw_customers_current", "raw_customers"), ("raw_products_current", "raw_products")):
            df = shaped(raw(spark, SMALL, f"{binding}_{batch}"), SOURCES[name])
            for landing in (first, second):
                parquet.write_flat(df, SOURCES[name].location(landing, batch))
    common = {"warehouse": str(base / "warehouse"), "as_of": dt.date(2024, 2, 1)}
    config = job.JobConfig(landing=first, run_ts=ts("2023-02-01"), **common)
    job.run(spark, config, batch=1)
    config = job.JobConfig(landing=second, run_ts=ts("2023-10-01"), **common)
    job.load_main_tables(spark, config)  # a run that died after loading
    audit = job.run(spark, config, batch=2).collect()
    return config, audit


def test_sources_read_by_their_specification(spark, finished):
    config, _ = finished
    for name, spec in SOURCES.items():
        df = spec.read(spark, config.landing, batch=1)
        assert df.limit(1).count() == 1
        assert set(spec.schema.names) <= set(df.columns)


def test_loaded_rows_equal_landed_rows(spark, finished):
    config, _ = finished
    for name in ("fact_orders", "raw_returns", "fact_events", "fact_payments", "dim_products"):
        landed = SOURCES[name].read(spark, config.landing).select(*SOURCES[name].schema.names)
        loaded = job.raw_table(spark, config, name).select(*SOURCES[name].schema.names)
        assert loaded.exceptAll(landed).isEmpty() and landed.exceptAll(loaded).isEmpty()


def test_marts_equal_a_full_computation(spark, finished):
    config, _ = finished
    orders = staging.stg_orders(orders_of_2001(spark))
    customers = staging.stg_customers(raw(spark, SMALL, "raw_dim_customers"))
    payments = staging.typed_payments(raw(spark, SMALL, "raw_payments"))
    enriched = enrich.orders_enriched(orders, customers, payments, one_version=True)
    kept = [c for c in FCT_ORDERS.names if c not in ("dbt_loaded_at", "total_paid")]
    kept.append(F.round("total_paid", 2))
    facts = marts.fct_orders(enriched, config.run_ts)
    stored = read_target(spark, config.mart("fct_orders"))
    assert rows(stored.select(*kept)) == rows(facts.select(*kept))

    money = ["gross_revenue", "net_revenue", "total_refunds_idr", "net_revenue_after_returns"]
    columns = [*marts.REVENUE_KEYS, "n_orders", "n_returns", *(F.round(c, 2).alias(c) for c in money)]
    returns = staging.stg_returns(raw(spark, SMALL, "raw_returns"))
    full = marts.revenue_daily(facts, returns, config.run_ts)
    assert rows(job.read_revenue(spark, config.mart("fct_revenue_daily")).select(*columns)) == rows(full.select(*columns))

    scores = read_target(spark, config.mart("fct_customer_rfm")).withColumn("total_spent", F.round("total_spent", 2))
    assert rows(scores) == rows(marts.customer_rfm(facts, config.as_of).withColumn("total_spent", F.round("total_spent", 2)))

    events = read_target(spark, config.mart("fct_events"))
    funnel = marts.funnel_conversion(events, config.run_ts)
    kept = [c for c in funnel.columns if c != "dbt_loaded_at"]
    assert rows(job.read_daily(spark, config.mart("fct_funnel_conversion")).select(*kept)) == rows(funnel.select(*kept))
    assert events.columns == FCT_EVENTS.names
    assert rows(reports.duplicate_keys(events, "event_id")) == []
    assert events.count() == raw(spark, SMALL, "raw_events").select("event_id").distinct().count()


def test_only_orders_with_news_were_loaded_again(spark, finished):
    """Orders loaded or paid after the first build, and no others."""
    config, _ = finished

    def since_first(df):
        return df.where(F.col("ingested_at") >= "2001-06-01").select("order_id")

    orders = orders_of_2001(spark)
    paid = since_first(raw(spark, SMALL, "raw_payments"))
    news = since_first(orders).union(paid.join(orders, "order_id", "left_semi")).distinct()
    stored = read_target(spark, config.mart("fct_orders"))
    again = stored.where(F.col("dbt_loaded_at") == F.lit(ts("2023-10-01"))).select("order_id")
    assert rows(again) == rows(news) and 0 < again.count() < stored.count()


ORDER = {"status": "completed", "gross_amount": 10.0, "discount_total": 0.0, "net_amount": 10.0, "channel": "web", "store_id": 1}


def order(order_id, day, loaded, changed=None):
    return ORDER | {"order_id": order_id, "customer_id": 1, "order_date": day, "updated_at": changed or day, "ingested_at": loaded}


def version(key, segment, since, until, loaded):
    person = {"full_name": "A", "email": "a@b.c", "city": "X", "is_active": True, "is_current": until is None, "updated_at": since}
    return person | {"customer_key": key, "customer_id": 1, "segment": segment, "valid_from": since, "valid_to": until, "ingested_at": loaded}


def landed(spark, base, name, data, at=None):
    spec = SOURCES[name]
    df = spark.createDataFrame([tuple(row.get(c) for c in spec.schema.names) for row in data], spec.schema)
    if at is None:
        parquet.write_flat(df, spec.location(base), mode="append")
    else:
        parquet.write_partitioned(df, spec.location(base), at, spec.partition_col, mode="append")


def built(spark, base, warehouse, day, full=False):
    config = job.JobConfig(landing=base, warehouse=warehouse, run_ts=ts(day), as_of=dt.date(2024, 6, 1), full_refresh=full)
    job.load_main_tables(spark, config)
    job.build(spark, config)
    facts = read_target(spark, config.mart("fct_orders")).select("order_id", "customer_key", "customer_segment", "net_amount")
    revenue = job.read_revenue(spark, config.mart("fct_revenue_daily")).select("date_day", "customer_segment", "n_orders", "net_revenue")
    return rows(facts), rows(revenue)


def test_late_orders_and_late_versions_equal_a_full_run(spark, folder):
    """Both arrive when much later rows are stored, and both say they are old."""
    base, warehouse = folder("landing"), folder("warehouse")
    payment = {"payment_id": 1, "order_id": 1, "amount": 10.0, "payment_method": "cod", "payment_date": "2024-01-05 10:00:00", "ingested_at": "2024-01-05 10:00:00"}
    event = {"event_id": "e", "session_id": "s", "event_type": "page_view", "event_ts": "2024-01-05 10:00:00", "ingested_at": "2024-01-05 10:00:00"}
    landed(spark, base, "fact_payments", [payment], "payment_date")
    landed(spark, base, "fact_events", [event], "event_ts")
    landed(spark, base, "raw_returns", [{"return_ref": "r", "order_id": 1, "return_date": "2024-01-09", "refund_amount": 1.0, "currency": "IDR", "ingested_at": "2024-01-09"}])
    landed(spark, base, "dim_customers", [version(1, "old", "2023-01-01 00:00:00", None, "2023-01-01 00:00:00")])
    first = [order(1, "2024-01-05 09:00:00", "2024-01-05 09:00:00"), order(2, "2024-01-20 09:00:00", "2024-01-20 09:00:00"), order(3, "2024-01-31 09:00:00", "2024-01-31 09:00:00")]
    landed(spark, base, "fact_orders", first, "order_date")
    built(spark, base, warehouse, "2024-02-01")
    # Loaded in February: an order of 21 January, and a version that holds from 15 to 25 January.
    landed(spark, base, "fact_orders", [order(4, "2024-01-21 09:00:00", "2024-02-02 00:00:00")], "order_date")
    landed(spark, base, "dim_customers", [version(2, "new", "2024-01-15 00:00:00", "2024-01-25 00:00:00", "2024-02-02 00:00:00")])
    facts, revenue = built(spark, base, warehouse, "2024-02-03")
    assert [(r[0], r[2]) for r in facts] == [(1, "old"), (2, "new"), (3, None), (4, "new")]
    assert (facts, revenue) == built(spark, base, folder("other"), "2024-02-03", full=True)
    # Orders before the version were left alone.
    stored = read_target(spark, f"{warehouse}/marts/fct_orders").where(F.col("dbt_loaded_at") == F.lit(ts("2024-02-03")))
    assert rows(stored.select("order_id")) == [(2,), (3,), (4,)]
    # Nothing new: nothing is computed again.
    assert built(spark, base, warehouse, "2024-02-04") == (facts, revenue)
    stored = read_target(spark, f"{warehouse}/marts/fct_orders").where(F.col("dbt_loaded_at") == F.lit(ts("2024-02-04")))
    assert stored.isEmpty()


def test_histories(spark, finished):
    config, _ = finished
    history = job.customer_history(spark, config)
    assert history.where("is_current").groupBy("customer_id").count().where("count > 1").isEmpty()
    assert dict(rows(reports.versions_histogram(history).select("n_versions", "n_customers"))).keys() == {1, 2}
    assert spark.read.parquet(config.history("snp_products")).count() > 0


def test_audit(finished):
    _, audit = finished
    assert [r.check_name for r in audit] == sorted(reports.AUDIT_ROWS)
    assert all(r.n_rows > 0 for r in audit)


def test_declared_checks_are_complete():
    kinds = [c.kind for table in (SOURCE_CHECKS, STAGING_CHECKS) for cs in table.values() for c in cs]
    assert len(kinds) == 68
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 30, "unique": 16, "accepted_values": 11, "between": 10, "regex": 1,
    }


def spoil(target, keep):
    """Make the files of all partitions but some unreadable."""
    for file in Path(target).glob("*/part-*"):
        if not any(k in str(file) for k in keep):
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_incremental_scores_and_funnel_read_only_what_was_touched(spark, folder):
    facts, months, funnel, events = folder("facts"), folder("months"), folder("funnel"), folder("events")
    days = [dt.date(2024, m, d) for m in (1, 2, 3) for d in (1, 2)]
    sold = [(k, k % 3, "completed" if k % 5 else "cancelled", float(k), day, day) for k, day in enumerate(days * 4)]
    schema = "order_id long, customer_id long, order_status string, net_amount double, order_date date, order_date_day date"
    seen = [(f"e{k}", f"s{k % 4}", float(k % 2), "page_view", ts(f"{day} 10:00:00"), day, "web", "mobile") for k, day in enumerate(days * 4)]
    kind = "event_id string, session_id string, customer_id double, event_type string, event_ts timestamp_ntz, event_date date, channel string, device string"
    first, late = spark.createDataFrame(sold[:20], schema), spark.createDataFrame(sold, schema)
    for data in (first, late):
        replace_partitions(spark, data, facts, "order_date_day")
        replace_partitions(spark, spark.createDataFrame(seen[: data.count()], kind), events, "event_date")
        if data is first:
            job.refresh_customer_months(spark, months, read_target(spark, facts))
            job.refresh_funnel(spark, funnel, read_target(spark, events), ts("2024-05-01"))
    changed = {row[4] for row in sold[20:]}
    assert changed == {days[2], days[3], days[4], days[5]}
    spoil(facts, keep=("2024-02", "2024-03"))
    spoil(events, keep=("2024-02", "2024-03"))
    job.refresh_customer_months(spark, months, read_target(spark, facts), changed)
    job.refresh_funnel(spark, funnel, read_target(spark, events), ts("2024-05-01"), changed)
    as_of = dt.date(2024, 6, 1)
    assert rows(marts.rfm_of_months(read_target(spark, months), as_of)) == rows(marts.customer_rfm(late, as_of))
    whole = marts.funnel_conversion(spark.createDataFrame(seen, kind), ts("2024-05-01"))
    assert rows(job.read_daily(spark, funnel)) == rows(whole)


EVENTS = (
    "event_id string, session_id string, customer_id double, product_id double, event_type string,"
    " event_ts string, channel string, device string, ingested_at string, batch_id string"
)


def event(event_id, day, session="s"):
    return (event_id, session, 1.0, None, "page_view", f"2024-01-{day:02d} 10:00:00", "web", "mobile", "i", "b")


def test_a_later_duplicate_does_not_replace_an_old_event(spark, folder):
    first = [event("a", 1), event("b", 10)]
    again = [*first, event("a", 11, "late copy"), event("c", 12), event("d", 2), event("b", 10)]
    target = folder("fct_events")
    for data in (first, again):
        job.refresh_events(spark, target, spark.createDataFrame(data, EVENTS), ts("2024-02-01"))
    stored = read_target(spark, target).select("event_id", "event_date", "session_id")
    day = lambda d: dt.date(2024, 1, d)
    # Event d came after the lookback of three days had passed it.
    assert rows(stored) == [("a", day(1), "s"), ("b", day(10), "s"), ("c", day(12), "s")]
    job.refresh_events(spark, target, spark.createDataFrame(again, EVENTS), ts("2024-02-01"), full=True)
    assert rows(read_target(spark, target).select("event_id")) == [("a",), ("b",), ("c",), ("d",)]
