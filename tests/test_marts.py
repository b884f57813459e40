import datetime as dt
import random

import pytest
from conftest import EAGER, NEVER, plan, rows, ts
from pyspark.sql import functions as F
from test_staging import PAYMENTS, order, raw_orders

from cartwright.operators import checks
from cartwright.operators.checks import CheckFailed, accepted, between, matches, not_null, run_checks, unique
from cartwright.operators.contracts import ContractBreach, enforce_contract
from cartwright.plans import enrich, job, marts, reports, staging
from cartwright.plans.contracts import FCT_ORDERS
from cartwright.schema import struct
from cartwright.sources.publish import read_target

RUN_AT = ts("2024-02-01")
CUSTOMERS = (
    "customer_key long, customer_id long, full_name string, email string, gender string, city string,"
    " segment string, referral_code string, valid_from string, valid_to string"
)


def raw_customers(spark, *ranges):
    """Customer 1 with one version per (from, to)."""
    data = [(k, 1, "n", "e", "F", f"city{k}", f"segment{k}", None, a, b) for k, (a, b) in enumerate(ranges)]
    return spark.createDataFrame(data, CUSTOMERS)


def customers(spark, *ranges):
    return staging.stg_customers(raw_customers(spark, *ranges))


def payments(spark, *data):
    return staging.typed_payments(spark.createDataFrame(list(data), PAYMENTS))


def enriched(spark, orders, versions=(("2020-01-01", None),), paid=(), **options):
    staged = staging.stg_orders(raw_orders(spark, *orders))
    return enrich.orders_enriched(staged, customers(spark, *versions), payments(spark, *paid), **options)


BOUNDARY = (("2023-01-01 00:00:00", "2024-01-02 10:00:00"), ("2024-01-02 10:00:00", None))


def test_order_on_a_version_boundary(spark):
    keys = lambda **options: sorted(r.customer_key for r in enriched(spark, [order(1)], BOUNDARY, **options).collect())
    assert keys(closed="both") == [0, 1]
    assert keys() == [1]


def test_overlapping_versions_can_be_resolved(spark):
    overlap = (("2023-01-01", "2024-01-03"), ("2024-01-02", None))
    keys = lambda **options: sorted(r.customer_key for r in enriched(spark, [order(1)], overlap, **options).collect())
    assert keys() == [0, 1]
    assert keys(one_version=True) == [1]


def test_payment_measures(spark):
    paid = [
        (1, 1, 5.0, "cod", "2024-01-02 10:01:01"),
        (2, 1, 7.0, "credit_card", "2024-01-02 09:00:00"),
        (3, 1, 7.0, "debit_card", None),
    ]
    got = {r.order_id: r for r in enriched(spark, [order(1, "2024-01-02 10:00:59"), order(2)], paid=paid).collect()}
    one, two = got[1], got[2]
    assert (one.total_paid, one.n_payment_rows, one.is_split_payment, one.has_late_payment) == (19.0, 3, True, True)
    assert one.payment_methods_used == "card, cod" and one.minutes_to_payment == -60
    assert one.first_payment_date == dt.date(2024, 1, 2)
    assert (two.total_paid, two.n_payment_rows, two.is_split_payment, two.has_late_payment) == (0.0, 0, False, False)
    assert two.payment_methods_used is None and two.minutes_to_payment is None


def test_column_choices(spark):
    got = enriched(spark, [order(1, ingested_at="2030-01-01")], channel_col="source", city_col=None, updated_col="ingested_at").first()
    assert (got.channel, got.shipping_city, got.updated_at) == ("synthetic", None, "2030-01-01")
    got = enriched(spark, [order(1)]).first()
    assert (got.channel, got.shipping_city) == ("web", "Bandung")
    assert (got.order_week, got.order_month) == (dt.date(2024, 1, 1), dt.date(2024, 1, 1))


def test_enriched_with_hot_keys(spark):
    rng = random.Random(5)
    orders = [order(7 if rng.random() < 0.3 else i, "2024-01-02 10:00:00") for i in range(120)]
    paid = [(i, rng.randrange(120), 1.0, "cod", "2024-01-02 11:00:00") for i in range(200)]
    versions = [(f"2023-0{m}-01", f"2023-0{m + 1}-01") for m in range(1, 9)] + [("2023-09-01", None)]
    plain = rows(enriched(spark, orders, versions, paid))
    assert rows(enriched(spark, orders, versions, paid, limits=EAGER)) == plain and len(plain) == 120


RETURNS = "return_ref string, order_id long, return_date date, refund_amount_idr double"


def returns(spark, *data):
    return spark.createDataFrame([(f"r{n}", *d) for n, d in enumerate(data)], RETURNS)


def test_refunds_of_groups_with_null_keys(spark):
    facts = marts.fct_orders(enriched(spark, [order(1, shipping_city=None)]), RUN_AT)
    back = returns(spark, (1, dt.date(2024, 1, 5), 30.0))
    kept = marts.revenue_daily(facts, back, RUN_AT).first()
    assert (kept.total_refunds_idr, kept.n_returns, kept.net_revenue_after_returns) == (30.0, 1, 70.0)
    lost = marts.revenue_daily(facts, back, RUN_AT, null_safe=False).first()
    assert (lost.total_refunds_idr, lost.n_returns, lost.net_revenue_after_returns) == (0.0, 0, 100.0)


def test_refunds_count_for_all_orders_of_a_sold_group(spark):
    facts = marts.fct_orders(enriched(spark, [order(1), order(2, status="returned"), order(3, "2024-01-03", "returned")]), RUN_AT)
    back = returns(spark, (1, dt.date(2024, 1, 5), 1.0), (2, dt.date(2024, 1, 5), 2.0), (2, dt.date(2024, 1, 6), 4.0), (3, dt.date(2024, 1, 6), 8.0))
    got = marts.revenue_daily(facts, back, RUN_AT).collect()
    assert [(r.n_orders, r.net_revenue, r.total_refunds_idr, r.n_returns) for r in got] == [(1, 100.0, 7.0, 3)]


def test_revenue_by_return_date(spark):
    facts = marts.fct_orders(enriched(spark, [order(1), order(2, channel="app")]), RUN_AT)
    back = returns(spark, (1, dt.date(2024, 1, 2), 5.0), (9, dt.date(2024, 1, 3), 8.0))
    got = rows(marts.revenue_daily_by_return_date(facts, back, RUN_AT).select("channel", "total_refunds_idr", "n_returns"))
    assert got == [("app", 5.0, 1), ("web", 5.0, 1)]


def test_late_returns_reach_their_old_days(spark, folder):
    orders = [order(1, "2023-01-05"), order(2, "2023-01-06"), order(3, "2024-01-02")]
    facts = marts.fct_orders(enriched(spark, orders), RUN_AT)
    first = returns(spark, (3, dt.date(2024, 1, 4), 5.0))
    late = returns(spark, (1, dt.date(2024, 1, 31), 9.0))
    target = folder("revenue")
    job.refresh_revenue(spark, target, facts, first, RUN_AT)
    days = job.days_of_returns(facts, late)
    assert days == [dt.date(2023, 1, 5)]
    everything = first.unionByName(late)
    job.refresh_revenue(spark, target, facts, everything, RUN_AT, days)
    assert rows(job.read_revenue(spark, target)) == rows(marts.revenue_daily(facts, everything, RUN_AT))
    # A day whose orders are gone leaves the table.
    fewer = facts.where("order_id <> 2")
    job.refresh_revenue(spark, target, fewer, everything, RUN_AT, [dt.date(2023, 1, 6)])
    assert rows(job.read_revenue(spark, target)) == rows(marts.revenue_daily(fewer, everything, RUN_AT))


def test_incremental_orders_equal_a_full_run(spark, folder):
    early = [order(i, f"2024-01-{i:02d} 10:00:00") for i in range(1, 11)]
    # Order 3 is completed late and dated anew; order 11 is new.
    late = [order(3, "2024-01-12 08:00:00", updated_at="2024-01-12 08:00:00", net=50.0), order(11, "2024-01-11")]
    versions = (("2020-01-01", None),)
    second = [o for o in early if o["order_id"] != 3] + late
    target = folder("fct")
    for orders in (early, second):
        staged = staging.stg_orders(raw_orders(spark, *orders))
        job.refresh_orders(spark, target, staged, raw_customers(spark, *versions), payments(spark), RUN_AT)
    assert rows(read_target(spark, target).select(*FCT_ORDERS.names)) == rows(
        marts.fct_orders(enriched(spark, second, one_version=True), RUN_AT)
    )


def test_facts_are_brought_together_before_their_key_is_hashed(spark, folder, monkeypatch):
    batches, plain = [], job.upsert

    def kept(spark, target, batch, *rest, **options):
        batches.append(plan(batch))
        return plain(spark, target, batch, *rest, **options)

    monkeypatch.setattr(job, "upsert", kept)
    staged = staging.stg_orders(raw_orders(spark, order(1), order(2, "2024-01-05")))
    job.refresh_orders(spark, folder("fct"), staged, raw_customers(spark), payments(spark), RUN_AT)
    above, _, below = batches[0].partition("REBALANCE")
    assert below and "md5" in above and "md5" not in below


def test_customer_orders_summary(spark):
    orders = [order(1), order(2, "2024-01-05", "cancelled", 50.0), order(1), order(3, customer_id=2, net=None)]
    items = spark.createDataFrame([(1,), (1,), (2,), (9,)], "order_id long")
    got = {r.customer_id: r for r in enrich.customer_orders_summary(enriched(spark, orders), items).collect()}
    one = got[1]
    assert (one.frequency, one.monetary_value, one.recency_days) == (2, 200.0, 0)
    assert one.avg_order_value == pytest.approx(250 / 3) and one.avg_items_per_order == pytest.approx(5 / 3)
    assert (got[2].frequency, got[2].avg_order_value, got[2].avg_items_per_order, got[2].recency_days) == (1, None, None, 3)


def test_rfm_excludes_cancelled_only(spark):
    orders = [order(1), order(2, status="cancelled"), order(3, status="returned"), order(4, status=None, customer_id=2)]
    facts = enriched(spark, orders)
    got = marts.customer_rfm(facts, dt.date(2024, 2, 1)).collect()
    assert [(r.customer_id, r.total_orders, r.days_since_last_order, r.rfm_score, r.rfm_segment) for r in got] == [
        (1, 2, 30, 5 + 2 + 1, "Potential Loyalist")
    ]


def test_funnel_against_sets(spark):
    rng = random.Random(4)
    steps = list(staging.FUNNEL_STAGES) + ["refund"]
    events = [
        (
            f"e{i}",
            rng.choice([None, "s1", "s2", "s3"]),
            rng.choice([None, 1.0, 2.0]),
            rng.choice(steps),
            ts(f"2024-01-0{rng.randrange(1, 4)} 10:00:00"),
            rng.choice(["web", None]),
            "mobile",
        )
        for i in range(60)
    ]
    df = spark.createDataFrame(
        events,
        "event_id string, session_id string, customer_id double, event_type string, event_ts timestamp_ntz,"
        " channel string, device string",
    )
    got = {(r.event_date, r.channel): r for r in marts.funnel_conversion(df, RUN_AT).collect()}
    for group, row in got.items():
        mine = [e for e in events if (e[4].date(), e[5]) == group]
        sessions = lambda step: len({e[1] for e in mine if e[1] and (step is None or e[3] == step)})
        users = lambda step: len({e[2] for e in mine if e[2] and e[3] == step})
        assert row.total_sessions == sessions(None) and row.total_events == len(mine)
        for step in staging.FUNNEL_STAGES:
            assert row[f"sessions_{step}"] == sessions(step)
        assert (row.users_page_view, row.users_converted) == (users("page_view"), users("checkout_complete"))
        if sessions("page_view"):
            assert row.page_to_pdp_rate == pytest.approx(sessions("product_view") / sessions("page_view"), abs=1e-4)
        else:
            assert row.page_to_pdp_rate is None
    assert len(got) == len({(e[4].date(), e[5]) for e in events})


def test_dim_customers(spark):
    raw = spark.createDataFrame(
        [(1, 1, "n", "e", None, "F", "1997-12-31", "c", "new", None, True, "2023-01-01", None, True, "u")],
        "customer_key long, customer_id long, full_name string, email string, phone string, gender string,"
        " date_of_birth string, city string, segment string, referral_code string, is_active boolean,"
        " valid_from string, valid_to string, is_current boolean, updated_at string",
    )
    got = marts.dim_customers_scd(staging.stg_customers(raw), dt.date(2024, 1, 1)).first()
    assert (got.age_years, got.generation_cohort, got.valid_to_date_safe) == (27, "Gen Z", dt.date(9999, 12, 31))


# --- contracts and checks -----------------------------------------------------


def test_contract_names_types_and_nulls(spark):
    contract = struct("a long!, b string")
    good = spark.createDataFrame([(1, "x"), (2, None)], "a long, b string").select("b", "a")
    assert enforce_contract(good, contract).columns == ["a", "b"]
    assert rows(enforce_contract(good, contract)) == [(1, "x"), (2, None)]
    with pytest.raises(ContractBreach, match="missing"):
        enforce_contract(good.drop("b"), contract)
    with pytest.raises(ContractBreach, match="unexpected"):
        enforce_contract(good.withColumn("c", F.lit(1)), contract)
    with pytest.raises(ContractBreach, match="int is not bigint"):
        enforce_contract(good.withColumn("a", F.lit(1)), contract)
    with pytest.raises(Exception, match="a must not be null"):
        enforce_contract(good.withColumn("a", F.nullif("a", F.lit(2))), contract).collect()


def test_checks_and_their_null_handling(spark):
    df = spark.createDataFrame(
        [(1, "x", 5.0, "a@b.c"), (1, "y", 0.0, "bad"), (None, None, None, None), (None, "x", 11.0, "a@b")],
        "k long, s string, n double, e string",
    )
    assert checks.check_not_null(df, "k").count() == 2
    assert rows(checks.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(checks.check_accepted(df, "s", ["x"]).select("s")) == [("y",)]
    assert rows(checks.check_between(df, "n", 0, 10).select("n")) == [(11.0,)]
    assert rows(checks.check_between(df, "n", low=0, strict=True).select("n")) == [(0.0,)]
    assert checks.check_regex(df, "e", r"^[^@]+@[^@]+\.[^@]+$").count() == 2
    listed = [not_null("k"), unique("k"), accepted("s", "x"), between("n", 0, 10), matches("e", "@")]
    got = {r.check_name: r.n_failed for r in run_checks(df, "t", listed).collect()}
    assert got == {"not_null": 2, "unique": 1, "accepted_values": 1, "between": 1, "regex": 1}
    with pytest.raises(CheckFailed, match="t.k not_null: 2"):
        run_checks(df, "t", listed, fail_fast=True)
    assert run_checks(df, "t", [matches("e", ".")], fail_fast=True).first().n_failed == 0


def test_row_count(spark):
    assert checks.assert_row_count(spark.range(3), "m", 3).first().result == "PASS"
    assert checks.assert_row_count(spark.range(3), "m", 4).first().result == "FAIL"


# --- reports --------------------------------------------------------------------


def test_return_rate_does_not_multiply_items_by_returns(spark):
    items = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 10), (3, 12)], "order_id long, product_id long")
    products = spark.createDataFrame([(10, "tea"), (10, "tea"), (11, "tea"), (12, "rice")], "product_id long, category string")
    back = spark.createDataFrame([(1, "Rusak"), (1, "Rusak"), (1, None)], "order_id long, reason_clean string")
    assert rows(reports.return_rate(items, back, products)) == [("tea", "(none)", 1, 2, 0.5), ("tea", "Rusak", 1, 2, 0.5)]


def test_audit_totals_leave_out_the_size(spark):
    audit = spark.createDataFrame([("orphan_items", 3), ("events_after_dedup", 100)], "check_name string, n_rows long")
    assert reports.dq_total(audit).first()[0] == 3


def test_price_at_order_is_half_open(spark):
    items = spark.createDataFrame([("i", 1, 5)], "item_id string, order_id long, product_id long")
    orders = staging.stg_orders(raw_orders(spark, order(1)))
    products = spark.createDataFrame(
        [(5, ts("2023-01-01"), ts("2024-01-02 10:00:00"), 1.0), (5, ts("2024-01-02 10:00:00"), None, 2.0)],
        "product_id int, valid_from timestamp_ntz, valid_to timestamp_ntz, selling_price double",
    )
    for limits in (EAGER, NEVER):
        got = reports.price_at_order(items, orders, products, limits).collect()
        assert [r.price_at_time_of_order for r in got] == [2.0]


def test_product_return_rate_keeps_products_without_returns(spark):
    items = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 10), (3, 12), (4, None)], "order_id long, product_id long")
    products = spark.createDataFrame([(10, "tea"), (11, "tea")], "product_id long, category string")
    back = spark.createDataFrame([(1, "Rusak", 8.0), (1, None, 2.0), (1, "Rusak", 1.0), (9, "Rusak", 5.0)], "order_id long, reason_clean string, refund_amount_idr double")
    assert rows(reports.product_return_rate(items, back, products)) == [
        (10, "tea", 2, 1, 0.5, "(none)", 1, 1.0),
        (10, "tea", 2, 1, 0.5, "Rusak", 1, 4.5),
        (11, "tea", 1, 1, 1.0, "(none)", 1, 1.0),
        (11, "tea", 1, 1, 1.0, "Rusak", 1, 4.5),
        (12, None, 1, 0, 0.0, None, 0, 0.0),
    ]


def test_revenue_of_orders_with_several_rows_and_customers(spark):
    """Distinct orders and customers are counted once, whatever rows they come in."""
    day = dt.date(2024, 1, 1)
    data = [(1, 7, "s", 10.0), (1, 7, "s", 10.0), (1, 8, "s", 5.0), (2, 7, "s", None), (3, None, "s", 1.0), (4, 9, None, 2.0)]
    orders = spark.createDataFrame(
        [(i, c, day, "web", "X", g, n, 0.0, n, True, True) for i, c, g, n in data] + [(5, 3, day, "web", "X", "s", 99.0, 0.0, 99.0, False, True)],
        "order_id long, customer_id long, order_date_day date, channel string, shipping_city string, customer_segment string,"
        " gross_amount double, discount_total double, net_amount double, is_completed boolean, is_split_payment boolean",
    )
    returns = spark.createDataFrame([(5, 3.0)], "order_id long, refund_amount_idr double")
    found = marts.revenue_daily(orders, returns, dt.datetime(2024, 2, 1))
    columns = ["customer_segment", "n_orders", "n_unique_customers", "net_revenue", "avg_order_value", "n_split_payment_orders", "total_refunds_idr", "n_returns"]
    assert rows(found.select(*columns)) == [(None, 1, 1, 2.0, 2.0, 1, 0.0, 0), ("s", 3, 2, 26.0, 6.5, 5, 3.0, 1)]


def test_customer_sketches_of_days_add_up(spark):
    """Sketches of days with common customers give the customers of the month, within five times the stated error."""
    orders = spark.range(60_000).selectExpr(
        "id % 20011 AS customer_id", "cast(date_add(DATE '2024-01-01', cast(id % 29 AS INT)) AS DATE) AS order_date_day", "'web' AS channel", "true AS is_completed"
    )
    sketches = marts.customer_sketches(orders)
    assert sketches.count() == 29
    months = {r.period_start: r.n_customers for r in marts.customers_by_period(sketches, ("month",)).collect()}
    assert months.keys() == {dt.date(2024, 1, 1)} and abs(months[dt.date(2024, 1, 1)] / 20011 - 1) < 5 * 1.04 / 64
