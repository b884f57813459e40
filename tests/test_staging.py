import datetime as dt

import pytest
from conftest import EAGER, NEVER, plan, rows, ts
from pyspark.sql import functions as F

from cartwright.operators import checks
from cartwright.operators.checks import check_parsable
from cartwright.operators.dedup import dedup_first
from cartwright.plans import staging
from cartwright.sources import parquet

RAW_ORDERS = (
    "order_id long, customer_id long, store_id long, order_date string, status string, gross_amount double,"
    " discount_total double, net_amount double, channel string, shipping_city string, updated_at string,"
    " ingested_at string, batch_id string, source string"
)


def order(order_id, date="2024-01-02 10:00:00", status=" Completed ", net=100.0, **other):
    base = {
        "order_id": order_id,
        "customer_id": 1,
        "store_id": 1,
        "order_date": date,
        "status": status,
        "gross_amount": 120.0,
        "discount_total": 20.0,
        "net_amount": net,
        "channel": "web",
        "shipping_city": "Bandung",
        "updated_at": date,
        "ingested_at": date,
        "batch_id": "b1",
        "source": "synthetic",
    }
    return {**base, **other}


def raw_orders(spark, *orders):
    return spark.createDataFrame([dict(o) for o in orders], RAW_ORDERS)


def test_orders_are_typed_and_flagged(spark):
    raw = raw_orders(
        spark,
        order(1),
        order(2, net=-5.0, status="SHIPPED"),
        order(3, net=None),
        order(4, date="not a date"),
        order(5, date="2024-01-02T10:00:00.5"),
    )
    got = {r.order_id: r for r in staging.stg_orders(raw).collect()}
    assert len(got) == 5
    assert (got[1].order_ts, got[1].order_date, got[1].order_status) == (
        ts("2024-01-02 10:00:00"),
        dt.date(2024, 1, 2),
        "completed",
    )
    assert [got[i].is_negative_order for i in (1, 2, 3)] == [False, True, False]
    assert got[4].order_ts is None and got[5].order_ts == ts("2024-01-02 10:00:00.500")
    assert [r.order_id for r in check_parsable(raw, "order_date", "timestamp_ntz").collect()] == [4]


ITEMS = "item_id string, order_id long, unit_price double, discount double"


def test_items_flag_orphans_and_keep_rows(spark):
    orders = staging.stg_orders(raw_orders(spark, order(1), order(1), order(2)))
    items = spark.createDataFrame(
        [("a", 1, 100.0, 10.0), ("b", 9, 0.0, 5.0), ("c", None, None, 5.0), ("d", 2, 50.0, None)], ITEMS
    )
    got = rows(staging.stg_order_items(items, orders))
    assert got == [
        ("a", 1, 100.0, 10.0, False, 0.1),
        ("b", 9, 0.0, 5.0, True, 0.0),
        ("c", None, None, 5.0, True, None),
        ("d", 2, 50.0, None, False, None),
    ]


PAYMENTS = "payment_id long, order_id long, amount double, payment_method string, payment_date string"


def test_payments_flags(spark):
    orders = staging.stg_orders(raw_orders(spark, order(1), order(2)))
    payments = [
        (1, 1, 5.0, "cod", "2024-01-02 09:59:59"),
        (2, 1, 5.0, "e-wallet_a", "2024-01-02 10:00:00"),
        (3, 2, 5.0, "paylater", None),
        (4, 9, 5.0, "voucher", "2020-01-01 00:00:00"),
        (5, None, 5.0, None, "2020-01-01 00:00:00"),
        (6, None, 5.0, None, "2020-01-01 00:00:00"),
    ]
    raw = spark.createDataFrame(payments, PAYMENTS)
    for limits in (EAGER, NEVER):
        got = {r.payment_id: r for r in staging.stg_payments(raw, orders, limits=limits).collect()}
        assert [got[i].is_late_arriving for i in range(1, 7)] == [True, False, False, False, False, False]
        assert [got[i].is_split_payment for i in range(1, 7)] == [True, True, False, False, True, True]
        assert [got[i].payment_method_group for i in range(1, 5)] == ["cod", "e_wallet", "bnpl", "other"]
    graced = staging.stg_payments(raw, orders, grace_minutes=5)
    assert not any(r.is_late_arriving for r in graced.collect())


def test_dedup_keeps_the_first_and_is_repeatable(spark):
    df = spark.createDataFrame(
        [("e1", "t2", 3, "x"), ("e1", "t1", 2, "b"), ("e1", "t1", 2, "a"), ("e2", None, 1, "z"), ("e2", "t9", 1, "y")],
        "id string, at string, n int, v string",
    )
    assert rows(dedup_first(df, ["id"], ["at"])) == [("e1", "t1", 2, "a"), ("e2", "t9", 1, "y")]
    assert "WindowGroupLimit" in plan(dedup_first(df, ["id"], ["at"]))


def test_events_recompute_the_stage(spark):
    raw = spark.createDataFrame(
        [("e1", "s", 1.0, None, "checkout_start", "2024-01-01 00:00:01", "web", "mobile", 0, "i", "b")] * 2
        + [("e2", "s", None, 2.0, "refund", "2024-01-01 00:00:02", "web", "mobile", 5, "i", "b")],
        "event_id string, session_id string, customer_id double, product_id double, event_type string,"
        " event_ts string, channel string, device string, funnel_stage long, ingested_at string, batch_id string",
    )
    assert rows(staging.stg_events(raw).select("event_id", "funnel_stage")) == [("e1", 4), ("e2", 0)]


def test_scd_overlap(spark):
    versions = spark.createDataFrame(
        [
            (1, 1, "2023-01-01", "2023-06-01"),
            (2, 1, "2023-06-01", "2023-09-02"),
            (3, 1, "2023-09-01", None),
            (4, 2, "2023-01-01", None),
        ],
        "customer_key long, customer_id long, valid_from string, valid_to string",
    )
    got = {r.customer_key: (r.next_valid_from, r.has_scd_overlap) for r in staging.stg_customers(versions).collect()}
    assert got == {1: ("2023-06-01", False), 2: ("2023-09-01", True), 3: (None, False), 4: (None, False)}


def test_products_margins_and_price_changes(spark):
    columns = (
        "product_key long, product_id long, sku string, product_name string, category string, brand string,"
        " cost_price double, selling_price double, weight_gram long, is_active boolean, valid_from string,"
        " valid_to string, is_current boolean, updated_at string"
    )

    def version(key, price, start):
        return (key, 1, " s ", "n", "c", "b", 80.0, price, 5, True, start, None, True, start)

    raw = spark.createDataFrame(
        [
            version(1, 0.0, "2023-01-01 00:00:00"),
            version(2, 100.0, "2023-02-01 00:00:00"),
            version(3, 110.0, "2023-03-01 00:00:00"),
            version(4, None, "2023-04-01 00:00:00"),
        ],
        columns,
    )
    got = {r.product_key: r for r in staging.stg_products(raw).collect()}
    assert [got[k].previous_selling_price for k in (1, 2, 3, 4)] == [None, 0.0, 100.0, 110.0]
    assert [got[k].price_change_pct for k in (1, 2, 3, 4)] == [None, None, 0.1, None]
    assert [got[k].gross_margin_pct for k in (1, 2, 3, 4)] == [None, 0.2, 0.2727, None]
    assert got[4].price_tier == "luxury" and got[2].sku == "s"


def test_returns(spark):
    raw = spark.createDataFrame(
        [
            ("r1", 1, "2024-01-01", " barang CACAT ", 1.0, "usd", "x", "i"),
            ("r2", 1, "2024-01-01", None, 2.0, None, "x", "i"),
            ("r3", 1, "2024-01-01", "ok", 3.0, "EUR", "x", "i"),
        ],
        "return_ref string, order_id long, return_date string, reason string, refund_amount double,"
        " currency string, refund_method string, ingested_at string",
    )
    got = rows(staging.stg_returns(raw).select("return_ref", "reason_clean", "refund_amount_idr", "was_currency_converted"))
    assert got == [("r1", "Barang cacat", 15800.0, True), ("r2", None, 2.0, None), ("r3", "Ok", 3.0, True)]


def test_inventory_json(spark):
    raw = spark.createDataFrame(
        [("2024-01-07", 1, '{"last_restock":"2023-12-01","storage_zone":"A","temp_sensitive":true}'), ("2024-01-07", 2, "broken")],
        "snapshot_date string, product_id long, metadata string",
    )
    flat = staging.inventory_flatten(raw)
    assert flat.columns == ["snapshot_date", "product_id", "last_restock", "storage_zone", "temp_sensitive"]
    assert rows(flat) == [
        (dt.date(2024, 1, 7), 1, dt.date(2023, 12, 1), "A", True),
        (dt.date(2024, 1, 7), 2, None, None, None),
    ]


def test_history_features(spark):
    def version(key, customer, segment, city, start, end):
        return (key, customer, "n", "e", None, "F", "1999-05-05", city, segment, None, True, ts(start), ts(end) if end else None, ts(start))

    history = spark.createDataFrame(
        [
            version("a", 1, "new", "Jakarta", "2023-01-05", "2023-04-03"),
            version("b", 1, "loyal", "Surabaya", "2023-04-03", "2023-09-12"),
            version("c", 1, "churned", "Surabaya", "2023-09-12", None),
            version("d", 2, "new", "Jakarta", "2023-01-05", None),
        ],
        "dbt_scd_id string, customer_id long, full_name string, email string, phone string, gender string,"
        " date_of_birth string, city string, segment string, referral_code string, is_active boolean,"
        " dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, dbt_updated_at timestamp_ntz",
    )
    for limits in (EAGER, staging.HotKeys(), NEVER):
        got = {
            r.customer_version_key: r
            for r in staging.customer_history_features(history, dt.date(2024, 2, 1), limits).collect()
        }
        assert [got[k].n_versions for k in "abcd"] == [3, 3, 3, 1]
        assert [got[k].ever_churned for k in "abcd"] == [True, True, True, False]
        assert [got[k].segment_changed for k in "abcd"] == [False, True, True, False]
        assert [got[k].city_changed for k in "abcd"] == [False, True, False, False]
        assert [got[k].previous_segment for k in "abcd"] == [None, "new", "loyal", None]
        assert [got[k].is_current for k in "abcd"] == [False, False, True, True]
        assert got["a"].age_years == 25 and got["a"].generation_cohort == "millennial"


def test_flagging_keeps_every_row(spark):
    """Flagged plus unflagged rows are all rows, with and without hot keys."""
    orders = staging.stg_orders(raw_orders(spark, *(order(i) for i in range(20))))
    items = spark.range(500).select(
        F.concat(F.lit("i"), F.col("id")).alias("item_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("order_id"),
        F.lit(1.0).alias("unit_price"),
        F.lit(0.0).alias("discount"),
    )
    for limits in (EAGER, NEVER):
        counts = dict(rows(staging.stg_order_items(items, orders, limits).groupBy("is_orphan_record").count()))
        expected = sum(1 for i in range(500) if i % 3 and i % 40 >= 20)
        assert counts == {True: expected, False: 500 - expected}


def test_inventory_with_unknown_fields_and_broken_text(spark):
    feed = spark.createDataFrame(
        [
            ("2024-01-07", 1, '{"last_restock":"2023-10-01","storage_zone":"A","temp_sensitive":true}'),
            ("2024-01-07", 2, '{"storage_zone":"B","grade":"x","size":{"w":1}}'),
            ("2024-01-07", 3, '{"storage_zone":'),
            ("2024-01-07", 4, "[1]"),
            ("2024-01-07", 5, None),
            ("2024-01-07", 6, ""),
            ("2024-01-07", 7, "{}"),
        ],
        "snapshot_date string, product_id long, metadata string",
    )
    found = {r.product_id: r for r in staging.inventory_open(feed).collect()}
    assert [r.storage_zone for _, r in sorted(found.items())] == ["A", "B", None, None, None, None, None]
    assert found[2].other_fields == {"grade": "x", "size": '{"w":1}'} and found[1].other_fields is None and found[7].other_fields is None
    assert {k: r.rejected_text for k, r in found.items() if r.rejected_text is not None} == {3: '{"storage_zone":', 4: "[1]", 6: ""}
    whole = feed.where("product_id = 1")
    assert staging.inventory_open(whole).drop("other_fields", "rejected_text").collect() == staging.inventory_flatten(whole).collect()


def test_observed_checks_equal_a_summary_and_add_no_job(spark, folder):
    data = spark.createDataFrame([(1, "a", None), (2, "z", 5), (None, None, 11)], "id long, kind string, n long")
    rules = [checks.not_null("id"), checks.accepted("kind", "a", "b"), checks.between("n", 1, 10)]
    counted, summary = checks.observed(data, "t", rules)
    parquet.write_flat(counted, folder("t"))
    assert rows(summary()) == rows(checks.summarize_checks(data, "t", rules)) and rows(parquet.read_table(spark, folder("t"))) == rows(data)
    with pytest.raises(ValueError, match="uniqueness"):
        checks.observed(data, "t", [checks.unique("id")])
