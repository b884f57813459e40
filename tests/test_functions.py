import datetime as dt

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from cartwright import functions as fn
from cartwright.functions.keys import NULL_TOKEN


def evaluate(spark, schema, values, column):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.select("i", column.alias("v")).orderBy("i").select("v").collect()]


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2024-01-01 00:00:59", "2024-01-01 00:01:01", 1),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("2024-01-02 00:00:30", "2024-01-01 23:58:59", -2),
    ],
)
def test_minutes_count_boundaries(spark, start, end, minutes):
    got = evaluate(
        spark, "a timestamp_ntz, b timestamp_ntz", [(ts(start), ts(end))], fn.minutes_between(F.col("a"), F.col("b"))
    )
    assert got == [minutes]


def test_years_count_boundaries(spark):
    got = evaluate(
        spark,
        "a date, b date",
        [(dt.date(2000, 12, 31), dt.date(2024, 1, 1)), (dt.date(2001, 1, 1), dt.date(2001, 12, 31))],
        fn.years_between(F.col("a"), F.col("b")),
    )
    assert got == [24, 0]


def test_rfm_band_edges(spark):
    days = [30, 31, 60, 61, 90, 91, 180, 181, None]
    assert evaluate(spark, "d int", days, fn.rfm_recency_score(F.col("d"))) == [5, 4, 4, 3, 3, 2, 2, 1, 1]
    orders = [1, 2, 3, 5, 6, 9, 10]
    assert evaluate(spark, "n int", orders, fn.rfm_frequency_score(F.col("n"))) == [1, 2, 3, 3, 4, 4, 5]
    money = [499_999.0, 500_000.0, 1_000_000.0, 2_000_000.0, 5_000_000.0, None]
    assert evaluate(spark, "m double", money, fn.rfm_monetary_score(F.col("m"))) == [1, 2, 3, 4, 5, 1]
    total = [3, 4, 7, 10, 13]
    labels = ["Lost", "At Risk", "Potential Loyalist", "Loyal Customer", "Champion"]
    assert evaluate(spark, "s int", total, fn.rfm_segment_label(F.col("s"))) == labels


def test_rfm_thresholds_can_be_changed(spark):
    strict = fn.RfmConfig(recency_days=(14, 30, 60, 90))
    assert evaluate(spark, "d int", [14, 15], fn.rfm_recency_score(F.col("d"), strict)) == [5, 4]


def test_to_idr(spark):
    values = [(1.0, "USD"), (1.0, "usd"), (1.0, "SGD"), (1.0, "IDR"), (1.0, None), (None, "USD")]
    got = evaluate(spark, "a double, c string", values, fn.to_idr(F.col("a"), F.col("c")))
    assert got == [15800.0, 15800.0, 11900.0, 1.0, 1.0, None]
    assert evaluate(spark, "a double, c string", values[:1], fn.to_idr(F.col("a"), F.col("c"), {"USD": 16200})) == [16200.0]


def test_ratios(spark):
    values = [(1.0, 3.0), (1.0, 0.0), (1.0, None), (None, 1.0)]
    got = evaluate(spark, "n double, d double", values, fn.safe_divide(F.col("n"), F.col("d")))
    assert got == [0.3333, None, None, None]
    assert evaluate(spark, "c long", [12345, None], fn.cents_to_idr(F.col("c"))) == [123.45, None]


def test_sentence_case(spark):
    values = [" barang CACAT ", "PRODUK TIDAK SESUAI", "x", "", None]
    got = evaluate(spark, "t string", values, fn.sentence_case(F.col("t")))
    assert got == ["Barang cacat", "Produk tidak sesuai", "X", "", None]


def test_payment_groups_are_ordered_and_case_sensitive(spark):
    values = ["credit_card", "bank_transfer", "e-wallet_a", "card_wallet", "cod", "paylater", "COD", None]
    got = evaluate(spark, "m string", values, fn.payment_method_group(F.col("m")))
    assert got == ["card", "bank_transfer", "e_wallet", "card", "cod", "bnpl", "other", "other"]


def test_price_tiers(spark):
    values = [99_999.0, 100_000.0, 499_999.0, 500_000.0, 1_500_000.0, None]
    got = evaluate(spark, "p double", values, fn.price_tier(F.col("p")))
    assert got == ["budget", "mid_range", "mid_range", "premium", "luxury", "luxury"]


def test_cohorts(spark):
    years = [1997, 1996, 1981, 1965, 1946, 1945, None]
    labels = ["Gen Z", "Millennial", "Millennial", "Gen X", "Boomer", "Silent Generation", "Silent Generation"]
    assert evaluate(spark, "y int", years, fn.generation_cohort(F.col("y"))) == labels
    ages = [24, 25, 39, 40, 55, 56]
    by_age = ["gen_z", "millennial", "millennial", "gen_x", "gen_x", "boomer"]
    assert evaluate(spark, "a int", ages, fn.cohort_by_age(F.col("a"))) == by_age


def test_late_with_grace(spark):
    at = ts("2024-01-01 12:00:00")
    values = [(at, at + dt.timedelta(minutes=10)), (at, at + dt.timedelta(minutes=11)), (None, at)]
    schema = "p timestamp_ntz, o timestamp_ntz"
    assert evaluate(spark, schema, values, fn.is_late_arriving(F.col("p"), F.col("o"))) == [True, True, None]
    assert evaluate(spark, schema, values, fn.is_late_arriving(F.col("p"), F.col("o"), 10)) == [False, True, None]


def test_surrogate_key(spark):
    import hashlib

    got = evaluate(spark, "a long, b string", [(1, "x"), (1, None)], fn.surrogate_key("a", "b"))
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("1-x", f"1-{NULL_TOKEN}")]


def test_date_spine(spark):
    days = rows(fn.date_spine(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 1)))
    assert days == [(dt.date(2024, 2, 27),), (dt.date(2024, 2, 28),), (dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)]
