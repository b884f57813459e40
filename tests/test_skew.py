"""The paths for hot keys give what the plain paths and brute force give."""

import datetime as dt
import random

from conftest import EAGER, plan, rows, ts
from pyspark.sql import functions as F

from cartwright.operators.hot import HotKeys, cut_points, find_hot, with_piece
from cartwright.operators.lookup import lookup_join
from cartwright.operators.neighbours import with_neighbour
from cartwright.operators.pit import pit_join


def skewed_key(rng, spread=20):
    """A third of all rows on one key, some on none."""
    draw = rng.random()
    return 7 if draw < 0.34 else None if draw < 0.4 else rng.randrange(spread)


def test_find_hot(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(2,)] * 3 + [(None,)] * 7, "k long")
    found = {r.k: r.pieces for r in find_hot(df, "k").collect()}
    assert found == {1: 2, None: 2}
    assert find_hot(df, "k", HotKeys(share=3)) is None
    assert find_hot(df.where("false"), "k") is None


def test_all_equally_hot_keys_are_found(spark):
    df = spark.range(1200).select((F.col("id") % 600).alias("k"))
    assert find_hot(df, "k", HotKeys(share=0.005)).count() == 600


def test_small_inputs_are_searched(spark, folder):
    spark.createDataFrame([(1,)] * 50, "k long").write.parquet(folder("t"))
    assert find_hot(spark.read.parquet(folder("t")), "k").count() == 1


def test_lookup_join(spark):
    rng = random.Random(1)
    facts = [(i, skewed_key(rng)) for i in range(600)]
    df = spark.createDataFrame(facts, "id long, k long").repartition(6)
    names = spark.createDataFrame([(k, f"name{k}") for k in range(0, 20, 2)] + [(7, "hot")], "k long, name string")
    known = dict(rows(names))
    hot = find_hot(df, "k", EAGER)
    assert hot.count() > 1
    joined = lookup_join(df, names, "k", hot)
    assert rows(joined) == sorted(((i, k, known.get(k)) for i, k in facts), key=lambda r: tuple(str(v) for v in r))
    assert rows(lookup_join(df, names, "k")) == rows(joined)


def test_lookup_join_deals_copies_of_one_row(spark):
    copies = spark.createDataFrame([(7, "same")] * 200, "k long, v string").repartition(8)
    names = spark.createDataFrame([(7, "hot")], "k long, name string")
    joined = lookup_join(copies, names, "k", find_hot(copies, "k", EAGER))
    assert rows(joined) == [(7, "same", "hot")] * 200


def neighbours_by_hand(data, direction):
    out = []
    for k in {d[1] for d in data}:
        group = sorted((d for d in data if d[1] == k), key=lambda d: (d[2] is None, d[2] or "", d[0]))
        shifted = [*group[1:], None] if direction == "next" else [None, *group[:-1]]
        out += [(*g, s[2] if s else None, s[0] if s else None) for g, s in zip(group, shifted)]
    return sorted(out, key=lambda r: tuple(str(v) for v in r))


def test_with_neighbour_cuts_hot_keys(spark):
    rng = random.Random(2)
    data = []
    for i in range(500):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(12))
        at = None if rng.random() < 0.05 else f"{day} 0{rng.randrange(9)}:00:00"
        data.append((i, skewed_key(rng), at))
    df = spark.createDataFrame(data, "id long, k long, at string")
    take = {"near_at": "at", "near_id": "id"}
    hot = find_hot(df, "k", EAGER)
    for direction in ("next", "previous"):
        want = neighbours_by_hand(data, direction)
        assert rows(with_neighbour(df, "k", "at", take, direction, ["id"])) == want
        assert rows(with_neighbour(df, "k", "at", take, direction, ["id"], hot)) == want


def test_a_hot_key_on_one_day_is_cut_evenly(spark):
    """All rows of the key lie within a minute; no piece is over twice the average."""
    rng = random.Random(8)
    data = [(i, 7, f"2024-01-01 10:00:00.{rng.randrange(10**6):06d}") for i in range(6000)]
    data += [(i, 100 + i, "2024-01-01 10:00:00") for i in range(6000, 8000)]
    df = spark.createDataFrame(data, "id long, k long, at string")
    hot = find_hot(df, "k", HotKeys(share=0.2))
    cuts = cut_points(df, "k", "at", hot)
    sizes = [r["count"] for r in with_piece(df.where("k = 7"), "k", cuts, piece=F.col("at")).groupBy("piece").count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * 6000 / 4
    take = {"near_at": "at", "near_id": "id"}
    want = neighbours_by_hand([d for d in data if d[1] == 7], "next")
    assert rows(with_neighbour(df.where("k = 7"), "k", "at", take, "next", ["id"], hot)) == want
    # Versions of one minute, and facts within it.
    start = ts("2024-01-01 10:00:00")
    versions = [(i, 7, start + dt.timedelta(microseconds=100 * i), start + dt.timedelta(microseconds=100 * i + 100)) for i in range(3000)]
    dim = spark.createDataFrame(versions, "v long, k long, lo timestamp_ntz, hi timestamp_ntz")
    left = spark.createDataFrame([(i, 7, start + dt.timedelta(microseconds=100 * i + 5)) for i in range(0, 3000, 7)], "id long, k long, at timestamp_ntz")
    many = find_hot(dim, "k", HotKeys(share=0.2))
    parts = with_piece(dim, "k", cut_points(dim, "k", "lo", many), piece=F.col("lo")).groupBy("piece").count().collect()
    assert max(r["count"] for r in parts) <= 2 * 3000 / 4
    assert rows(pit_join(left, dim, "k", "at", "lo", "hi", hot=many).select("id", "v")) == rows(left.select("id", F.col("id").alias("v")))


def matches_by_hand(facts, versions, closed):
    out = []
    for fid, k, at in facts:
        hits = [
            v
            for v in versions
            if k is not None and v[1] == k and v[2] <= at and (v[3] is None or (at <= v[3] if closed == "both" else at < v[3]))
        ]
        out += [(fid, k, at, v[0]) for v in hits] or [(fid, k, at, None)]
    return sorted(out, key=lambda r: tuple(str(v) for v in r))


def test_pit_join_with_many_versions(spark):
    rng = random.Random(3)
    start = ts("2020-01-01 00:00:00")
    versions = []
    for i in range(200):
        begin = start + dt.timedelta(days=rng.randrange(900))
        end = None if rng.random() < 0.2 else begin + dt.timedelta(days=rng.randrange(-2, 90))
        versions.append((i, skewed_key(rng, 8), begin, end))
    facts = [(i, skewed_key(rng, 8), start + dt.timedelta(days=rng.randrange(-30, 1500))) for i in range(300)]
    left = spark.createDataFrame(facts, "id long, k long, at timestamp_ntz")
    dim = spark.createDataFrame(versions, "v long, k long, lo timestamp_ntz, hi timestamp_ntz")
    hot = find_hot(dim, "k", EAGER)
    for closed in ("left", "both"):
        want = matches_by_hand(facts, versions, closed)
        for found in (None, hot):
            got = pit_join(left, dim, "k", "at", "lo", "hi", closed, hot=found)
            assert rows(got) == want
            inner = pit_join(left, dim, "k", "at", "lo", "hi", closed, "inner", hot=found)
            assert rows(inner) == [w for w in want if w[3] is not None]


def test_pit_join_leaves_fact_skew_to_aqe(spark, folder):
    """A key with very many facts is split at run time."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    facts = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500).alias("k"),
        F.lit(ts("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("at"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    dim = spark.range(500).select(
        F.col("id").alias("k"),
        F.lit(ts("2023-01-01 00:00:00")).cast("timestamp_ntz").alias("lo"),
        F.lit(None).cast("timestamp_ntz").alias("hi"),
        F.col("id").alias("v"),
    )
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = pit_join(facts, dim, "k", "at", "lo", "hi")
        assert len(joined.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
