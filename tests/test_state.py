"""Upserts, interrupted writes, snapshots, loading."""

import datetime as dt
import os
import random
import sys
from pathlib import Path

import pytest
from conftest import plan, rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.operators.lookback import EPOCH, incremental_filter, max_timestamp
from cartwright.operators.snapshot import read_history, scd2_merge, scd2_snapshot
from cartwright.operators.upsert import align_schemas, upsert, upsert_frames
from cartwright.sources import keyindex, ledger, load, parquet, publish, storage
from cartwright.sources.publish import finish_pending, read_target, replace_partitions
from cartwright.streaming import stream_dedup_with_late

FACT = "id long, day date, v string"
MONDAY, TUESDAY = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def facts(spark, *data, schema=FACT):
    return spark.createDataFrame(list(data), schema)


def test_upsert_moves_a_key_between_partitions(spark, folder):
    target = folder("t")
    upsert(spark, target, facts(spark, (1, MONDAY, "a"), (2, TUESDAY, "b")), ["id"], "day")
    touched = upsert(spark, target, facts(spark, (1, TUESDAY, "c"), (3, None, "d")), ["id"], "day")
    assert set(touched) == {MONDAY, TUESDAY, None}
    assert rows(read_target(spark, target)) == [(1, TUESDAY, "c"), (2, TUESDAY, "b"), (3, None, "d")]
    assert not storage.path_exists(spark, f"{target}/day=2024-01-01")
    upsert(spark, target, facts(spark, (3, MONDAY, "e")), ["id"], "day")
    assert rows(read_target(spark, target)) == [(1, TUESDAY, "c"), (2, TUESDAY, "b"), (3, MONDAY, "e")]


def test_upsert_of_most_rows_shuffles_no_row_that_goes(spark, folder, monkeypatch):
    module = sys.modules[upsert.__module__]
    target, staged, plain = folder("t"), [], module.stage

    def counted(spark, df, *rest, **options):
        staged.append(df)
        return plain(spark, df, *rest, **options)

    monkeypatch.setattr(module, "stage", counted)
    day = {k: MONDAY if k % 2 else TUESDAY for k in range(9)}
    first = [(None if k == 0 else k, day[k], "old") for k in range(9)]
    upsert(spark, target, facts(spark, *first), ["id"], "day")
    upsert(spark, target, facts(spark, *((i, d, "new") for i, d, _ in first)), ["id"], "day")
    assert len(staged) == 2  # Nobody stays, so only batches are written.
    assert rows(read_target(spark, target)) == rows(facts(spark, *((i, d, "new") for i, d, _ in first)))
    most = [(i, d, "newer") for i, d, _ in first if i not in (None, 5)]
    upsert(spark, target, facts(spark, *most, (10, MONDAY, "more")), ["id"], "day")
    stay = [(None, TUESDAY, "new"), (5, MONDAY, "new")]
    assert rows(read_target(spark, target)) == rows(facts(spark, *most, (10, MONDAY, "more"), *stay))
    upsert(spark, target, facts(spark, (None, TUESDAY, "x"), *most[1:], (11, MONDAY, "y")), ["id"], "day", null_safe=False)
    want = [(None, TUESDAY, "new"), (None, TUESDAY, "x"), most[0], (5, MONDAY, "new"), *most[1:], (10, MONDAY, "more"), (11, MONDAY, "y")]
    assert rows(read_target(spark, target)) == rows(facts(spark, *want))


def test_newest_values_are_found_without_a_search_in_each_rows_path(spark, folder):
    written = folder("t")
    parquet.write_partitioned(spark.range(40).selectExpr("id", "cast(timestamp_seconds(id * 9000) as string) AS at"), written, "at", "day")
    found = ledger.table_files(spark, written, "at")
    assert "regexp_extract" not in plan(found).rsplit("Exchange", 1)[1]
    stored = {str(f.relative_to(written)) for f in Path(written).rglob("*.parquet")}
    assert {r.path for r in found.collect()} == stored and {r.newest[:10] for r in found.collect()} == {p[4:14] for p in stored}


def test_upsert_twice_changes_nothing(spark, folder):
    target, batch = folder("t"), facts(spark, (1, MONDAY, "a"), (2, TUESDAY, "b"))
    for _ in range(2):
        upsert(spark, target, batch, ["id"], "day")
        assert rows(read_target(spark, target)) == [(1, MONDAY, "a"), (2, TUESDAY, "b")]


def test_upsert_leaves_other_partitions_alone(spark, folder):
    target = folder("t")
    upsert(spark, target, facts(spark, (1, MONDAY, "a"), (2, TUESDAY, "b")), ["id"], "day")

    def monday_files():
        monday = read_target(spark, target).where(F.col("day") == MONDAY)
        return rows(monday.select(F.input_file_name()))

    before = monday_files()
    upsert(spark, target, facts(spark, (2, TUESDAY, "c")), ["id"], "day")
    assert monday_files() == before


def test_null_keys_match_when_null_safe(spark):
    old = facts(spark, (None, MONDAY, "old"), (1, MONDAY, "keep"))
    new = facts(spark, (None, MONDAY, "new"))
    assert rows(upsert_frames(old, new, ["id", "day"])) == [(1, MONDAY, "keep"), (None, MONDAY, "new")]
    assert len(rows(upsert_frames(old, new, ["id", "day"], null_safe=False))) == 3


def test_new_columns_are_appended(spark, folder):
    target = folder("t")
    upsert(spark, target, facts(spark, (1, MONDAY, "a"), (2, TUESDAY, "b")), ["id"], "day")
    wider = facts(spark, (2, TUESDAY, "c", 5), schema=FACT + ", extra int")
    upsert(spark, target, wider, ["id"], "day")
    upsert(spark, target, facts(spark, (4, TUESDAY), schema="id long, day date"), ["id"], "day")
    stored = read_target(spark, target)
    assert stored.columns == ["id", "day", "v", "extra"]
    assert rows(stored) == [(1, MONDAY, "a", None), (2, TUESDAY, "c", 5), (4, TUESDAY, None, None)]


def test_changed_types_are_refused(spark):
    with pytest.raises(ValueError, match="changes type"):
        align_schemas(facts(spark, (1, MONDAY, "a")), facts(spark, (1, MONDAY, 3), schema="id long, day date, v int"))


def test_repeated_batch_keys_can_be_refused(spark, folder):
    batch = facts(spark, (1, MONDAY, "a"), (1, MONDAY, "b"))
    with pytest.raises(ValueError, match="repeats a key"):
        upsert(spark, folder("t"), batch, ["id"], "day", assert_unique_batch=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_upserts_equal_a_dictionary(spark, tmp_path_factory, seed):
    rng, target, model = random.Random(seed), str(tmp_path_factory.mktemp("u") / "t"), {}
    for _ in range(3):
        batch = {rng.randrange(12): (rng.choice([MONDAY, TUESDAY, None]), str(rng.random())) for _ in range(5)}
        model.update(batch)
        upsert(spark, target, facts(spark, *((k, *v) for k, v in batch.items())), ["id"], "day")
    assert rows(read_target(spark, target)) == sorted(
        ((k, *v) for k, v in model.items()), key=lambda r: tuple(str(x) for x in r)
    )


def test_interrupted_publish_is_finished_by_the_next_call(spark, folder, monkeypatch):
    target = folder("t")
    upsert(spark, target, facts(spark, (1, MONDAY, "a"), (2, TUESDAY, "b")), ["id"], "day")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(publish, "finish_pending", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            replace_partitions(spark, facts(spark, (1, TUESDAY, "c")), target, "day", [MONDAY, TUESDAY])
    assert rows(read_target(spark, target)) == [(1, MONDAY, "a"), (2, TUESDAY, "b")]
    with pytest.raises(RuntimeError, match="finish_pending"):
        replace_partitions(spark, facts(spark, (9, TUESDAY, "x")), target, "day")
    assert finish_pending(spark, target)
    assert rows(read_target(spark, target)) == [(1, TUESDAY, "c")]
    assert not finish_pending(spark, target)


def test_a_publish_cut_off_between_renames_is_finished(spark, folder, monkeypatch):
    target = folder("t")
    upsert(spark, target, facts(spark, (1, MONDAY, "a"), (2, TUESDAY, "b")), ["id"], "day")
    real, calls = storage.move, []

    def once(*args):
        calls.append(args)
        if len(calls) > 1:
            raise RuntimeError("driver lost")
        real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(publish.storage, "move", once)
        with pytest.raises(RuntimeError, match="driver lost"):
            upsert(spark, target, facts(spark, (1, MONDAY, "x"), (2, TUESDAY, "y")), ["id"], "day")
    upsert(spark, target, facts(spark, (3, MONDAY, "z")), ["id"], "day")
    assert rows(read_target(spark, target)) == [(1, MONDAY, "x"), (2, TUESDAY, "y"), (3, MONDAY, "z")]
    assert set(keyindex.read_index(spark, target)) == {"2024-01-01", "2024-01-02"}
    assert len(storage.folders(spark, f"{target}/_keys")) == 2


def test_history_folders_follow_the_calendar(spark, folder):
    target = folder("h")
    for run in range(8):
        now = dt.datetime(2024, 1, 25) + dt.timedelta(days=2 * run)
        source = facts(spark, *((k, f"city {run}", "s", str(now - dt.timedelta(hours=1))) for k in range(3)), schema="customer_id long, city string, segment string, updated_at string")
        found = scd2_snapshot(spark, target, source, "customer_id", now=now)
        assert found.count() == 3 * (run + 1)
    assert sorted(storage.folders(spark, target)) == ["history_slice=closed_202401", "history_slice=closed_202402", "history_slice=open"]
    assert found.where("dbt_valid_to IS NULL").count() == 3
    # A run that is repeated with the same source closes nothing and writes no version twice.
    assert scd2_snapshot(spark, target, source, "customer_id", now=now).count() == 24


# --- key index --------------------------------------------------------------


def spoil(target, day):
    """Make a partition's files unreadable, so that whoever opens one fails."""
    for file in Path(target, f"day={day}").glob("part-*"):
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("id_of", [lambda day, k: 1000 * day + k, lambda day, k: 31 * k + day])
def test_an_upsert_opens_only_partitions_that_may_hold_its_keys(spark, folder, id_of):
    """Ids that grow with the day are told apart by their ranges, scattered ones by the filters."""
    target = folder("t")
    days = [dt.date(2024, 1, d) for d in range(1, 31)]
    data = [(id_of(day.day, k), day, "a") for day in days for k in range(300)]
    upsert(spark, target, facts(spark, *data), ["id"], "day")
    wanted = facts(spark, *((id_of(3, k), dt.date(2024, 2, 1), "moved") for k in range(0, 100, 10)))
    maybe = keyindex.may_hold(spark, target, wanted, ["id"], {str(d) for d in days})
    assert "2024-01-03" in maybe and len(maybe) <= 3
    for day in days:
        if str(day) not in maybe:
            spoil(target, day)
    touched = upsert(spark, target, wanted, ["id"], "day")
    assert touched == [dt.date(2024, 1, 3), dt.date(2024, 2, 1)]
    both = read_target(spark, target).where(F.col("day").isin(touched))
    assert both.where("v = 'moved'").count() == 10 and both.count() == 300


def test_the_index_misses_no_key(spark, folder):
    target, draw = folder("t"), random.Random(3)
    for _ in range(3):
        batch = {draw.randrange(400): (dt.date(2024, 1, draw.randint(1, 9)) if draw.random() > 0.1 else None) for _ in range(150)}
        batch[None] = MONDAY
        upsert(spark, target, facts(spark, *((k, d, "x") for k, d in batch.items())), ["id"], "day")
        stored = read_target(spark, target)
        existing = {r[0] for r in stored.select(F.coalesce(F.col("day").cast("string"), F.lit(publish.NULL_PARTITION))).collect()}
        for key in [*range(0, 400, 23), None]:
            at = stored.where(F.col("id").eqNullSafe(F.lit(key))).select(F.coalesce(F.col("day").cast("string"), F.lit(publish.NULL_PARTITION)))
            maybe = keyindex.may_hold(spark, target, facts(spark, (key, None, None)), ["id"], existing)
            assert {r[0] for r in at.collect()} <= maybe
    assert stored.groupBy("id").count().where("count > 1").isEmpty()


def test_two_column_keys_and_partitions_without_an_entry(spark, folder):
    target = folder("t")
    upsert(spark, target, facts(spark, (1, MONDAY, "a"), (1, TUESDAY, "b")), ["id", "v"], "day")
    replace_partitions(spark, facts(spark, (1, TUESDAY, "b"), (2, TUESDAY, "c")), target, "day")
    assert set(keyindex.read_index(spark, target)) == {"2024-01-01"}
    upsert(spark, target, facts(spark, (2, MONDAY, "c"), (1, None, "a")), ["id", "v"], "day")
    assert rows(read_target(spark, target)) == [(1, TUESDAY, "b"), (1, None, "a"), (2, MONDAY, "c")]
    upsert(spark, target, facts(spark, (1, MONDAY, "z")), ["id"], "day")  # other keys than the index has
    assert rows(read_target(spark, target)) == [(1, MONDAY, "z"), (2, MONDAY, "c")]


# --- snapshots --------------------------------------------------------------

CURRENT = "customer_id long, city string, segment string, updated_at string"
RUNS = [ts("2023-01-06"), ts("2023-04-04"), ts("2023-09-13")]


def state(spark, *data):
    return spark.createDataFrame(list(data), CURRENT)


def versions(df):
    return rows(df.select("customer_id", "segment", "dbt_valid_from", "dbt_valid_to"))


def test_three_snapshot_runs(spark, folder):
    target = folder("h")
    sources = [
        state(spark, (1, "Jakarta", "new", "2023-01-05"), (2, "Medan", "new", "2023-01-05")),
        state(spark, (1, "Surabaya", "loyal", "2023-04-03"), (2, "Medan", "new", "2023-01-05")),
        state(spark, (1, "Surabaya", "churned", "2023-09-12"), (2, "Medan", "new", "2023-01-05")),
    ]
    for now, source in zip(RUNS, sources):
        scd2_snapshot(spark, target, source, "customer_id", now=now)
    want = [
        (1, "churned", ts("2023-09-12"), None),
        (1, "loyal", ts("2023-04-03"), ts("2023-09-12")),
        (1, "new", ts("2023-01-05"), ts("2023-04-03")),
        (2, "new", ts("2023-01-05"), None),
    ]
    assert versions(read_history(spark, target)) == want
    scd2_snapshot(spark, target, sources[2], "customer_id", now=RUNS[2])
    assert versions(read_history(spark, target)) == want
    ids = [r.dbt_scd_id for r in read_history(spark, target).collect()]
    assert len(set(ids)) == 4


def test_deleted_keys_close_and_reopen(spark, folder):
    target = folder("h")
    both = state(spark, (1, "J", "new", "2023-01-05"), (2, "M", "new", "2023-01-05"))
    scd2_snapshot(spark, target, both, "customer_id", now=RUNS[0])
    scd2_snapshot(spark, target, both.where("customer_id = 2"), "customer_id", now=RUNS[1])
    assert versions(read_history(spark, target))[0] == (1, "new", ts("2023-01-05"), RUNS[1])
    scd2_snapshot(spark, target, both, "customer_id", now=RUNS[2])
    assert [v[3] for v in versions(read_history(spark, target)) if v[0] == 1] == [RUNS[1], None]
    scd2_snapshot(spark, target, both.where("false"), "customer_id", now=ts("2023-12-01"))
    assert all(v[3] is not None for v in versions(read_history(spark, target)))


def test_repeated_source_keys_are_refused(spark, folder):
    twice = state(spark, (1, "J", "new", "2023-01-05"), (1, "M", "new", "2023-01-06"))
    with pytest.raises(ValueError, match="repeats customer_id"):
        scd2_snapshot(spark, folder("h"), twice, "customer_id", now=RUNS[0])


def test_deletes_can_be_ignored_and_columns_added(spark):
    first = scd2_merge(None, state(spark, (1, "J", "new", "2023-01-05")), "customer_id", now=RUNS[0])
    wider = spark.createDataFrame([(2, "M", "new", "2023-02-01", True)], CURRENT + ", vip boolean")
    merged = scd2_merge(first, wider, "customer_id", now=RUNS[1], invalidate_hard_deletes=False)
    got = {r.customer_id: (r.dbt_valid_to, r.vip) for r in merged.collect()}
    assert got == {1: (None, None), 2: (None, True)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.booleans())
def test_validity_ranges(spark, seed, deletes):
    """At most one open version per key; and without deletions, which close a
    version at the run's time, ranges that do not overlap."""
    rng = random.Random(seed)
    stamps, present = dict.fromkeys(range(8), dt.datetime(2023, 1, 1)), set()
    closed, current = [], None
    for run in range(1, 4):
        now = dt.datetime(2023, run * 3, 1)
        for k in stamps:
            if rng.random() < 0.4:
                stamps[k] = now - dt.timedelta(days=rng.randrange(1, 20))
        arrived = {k for k in stamps if rng.random() < 0.7}
        present = arrived if deletes else present | arrived
        data = [(k, "c", f"s{run}", str(stamps[k])) for k in present]
        source = state(spark, *data)
        merged = scd2_merge(current, source, "customer_id", now=now)
        result = merged.collect()
        closed += [r for r in result if r.dbt_valid_to is not None]
        current = spark.createDataFrame([r for r in result if r.dbt_valid_to is None], merged.schema)
    history = sorted(closed + current.collect(), key=lambda r: (r.customer_id, r.dbt_valid_from))
    open_keys = [r.customer_id for r in history if r.dbt_valid_to is None]
    assert len(open_keys) == len(set(open_keys))
    for a, b in zip(history, history[1:]):
        if a.customer_id == b.customer_id and not deletes:
            assert a.dbt_valid_to == b.dbt_valid_from


# --- lookback and loading ----------------------------------------------------


def test_lookback_of_an_empty_target_loads_everything(spark):
    source = spark.createDataFrame([("2020-01-01",), ("2024-01-01",)], "at string")
    assert incremental_filter(source, source.where("false"), "at").count() == 2
    assert incremental_filter(source, None, "at").count() == 2
    assert max_timestamp(None, "at") == EPOCH == max_timestamp(source.where("false"), "at")


def test_lookback_includes_its_bound(spark):
    data = [("2024-01-06 23:59:59",), ("2024-01-07",), ("2024-01-07T00:00:00",), ("2024-01-10",), (None,)]
    source = spark.createDataFrame(data, "at string")
    target = spark.createDataFrame([("2024-01-10",)], "at string")
    assert rows(incremental_filter(source, target, "at", 3)) == data[1:4]
    padded = spark.createDataFrame([(" 2024-01-21 10:00:00",), ("soon",)], "at string")
    assert rows(incremental_filter(padded, target, "at", 3)) == [(" 2024-01-21 10:00:00",)]
    assert incremental_filter(source, target, "at", 3, full_refresh=True).count() == len(data)


RAW = "id long, ingested_at string"


LOADED = "id long, ingested_at string"


def test_a_second_load_opens_only_new_files(spark, folder):
    """Neither old source files nor old files of the table are read, whatever the load looks for."""
    src, dst = folder("src"), folder("dst")
    parquet.write_flat(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-10")], LOADED).coalesce(1), src)
    parquet.write_flat(spark.createDataFrame([(3, "2024-02-10")], LOADED), src, mode="append")
    load.incremental_load(spark, src, dst)
    first = ledger.commits(spark, dst)
    reaching = {r[0] for r in ledger.read_ledger(spark, dst).where("newest > '2024-02'").select("path").collect()}
    for place in (src, dst):
        for file in Path(place).glob("part-*.parquet"):
            if place == src or file.name not in reaching:
                body = file.stat()
                file.write_bytes(b"x" * body.st_size)
                os.utime(file, ns=(body.st_atime_ns, body.st_mtime_ns))
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    parquet.write_flat(spark.createDataFrame([(4, "2024-02-11"), (3, "2024-02-10"), (5, "2024-02-09"), (6, "2024-01-02")], LOADED), src, mode="append")
    assert load.watermark(spark, dst) == "2024-02-10"
    assert load.incremental_load(spark, src, dst, lookback="3 days") == load.APPENDED
    assert load.watermark(spark, dst) == "2024-02-11"
    again = ledger.loaded_after(spark, dst, first[-1], spark.read.schema(LOADED).parquet(dst).schema)
    assert rows(again) == [(4, "2024-02-11"), (5, "2024-02-09")]
    assert load.incremental_load(spark, src, dst) == load.APPENDED and len(ledger.commits(spark, dst)) == 2
    assert rows(ledger.loaded_after(spark, dst, ledger.commits(spark, dst)[-1], again.schema)) == []


def test_a_load_cut_off_between_renames_is_finished(spark, folder, monkeypatch):
    src, dst = folder("src"), folder("dst")
    for k in range(2):
        parquet.write_flat(spark.createDataFrame([(k, f"2024-01-0{k + 1}")], LOADED), src, mode="append")
        if k == 0:
            load.incremental_load(spark, src, dst)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(ledger.storage, "move", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            load.incremental_load(spark, src, dst)
    load.incremental_load(spark, src, dst)
    assert rows(parquet.read_table(spark, dst)) == [(0, "2024-01-01"), (1, "2024-01-02")]
    assert len(ledger.commits(spark, dst)) == 2


def test_a_table_without_a_ledger_gets_one(spark, folder):
    src, dst = folder("src"), folder("dst")
    parquet.write_flat(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], LOADED), dst)
    parquet.write_flat(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], LOADED), src)
    load.incremental_load(spark, src, dst, lookback="9 days")
    assert rows(parquet.read_table(spark, dst)) == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")]
    assert load.watermark(spark, dst) == "2024-01-03"


def test_incremental_load(spark, folder):
    src, dst = folder("src"), folder("dst")
    assert load.incremental_load(spark, src, dst) == load.SKIPPED
    parquet.write_flat(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], RAW), src)
    assert load.incremental_load(spark, src, dst) == load.REFRESHED
    late = spark.createDataFrame([(3, "2024-01-01"), (4, "2024-01-03"), (4, "2024-01-03")], RAW)
    parquet.write_flat(late, src, mode="append")
    assert load.incremental_load(spark, src, dst) == load.APPENDED
    assert rows(spark.read.parquet(dst).select("id")) == [(1,), (2,), (4,), (4,)]
    assert load.incremental_load(spark, src, dst, lookback="3 days") == load.APPENDED
    assert rows(spark.read.parquet(dst).select("id")) == [(1,), (2,), (3,), (4,), (4,)]


def test_load_without_watermark_refreshes(spark, folder):
    src, dst = folder("src"), folder("dst")
    parquet.write_flat(spark.createDataFrame([(1,)], "id long"), src)
    assert [load.incremental_load(spark, src, dst) for _ in range(2)] == [load.REFRESHED] * 2
    parquet.write_flat(spark.createDataFrame([(1, None)], RAW), src)
    assert [load.incremental_load(spark, src, dst) for _ in range(2)] == [load.REFRESHED] * 2


def test_failed_refresh_keeps_the_old_table(spark, folder):
    src, dst = folder("src"), folder("dst")
    parquet.write_flat(spark.createDataFrame([(1,)], "id long"), src)
    load.full_refresh(spark, src, dst)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        load.rebuild(broken, dst)
    assert rows(spark.read.parquet(dst)) == [(1,)]


def test_partitioned_layout_prunes(spark, folder):
    base = folder("events")
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 11:00:00"), (3, None)], "id long, at string")
    parquet.write_partitioned(df, base, "at", "day")
    back = parquet.read_partitioned(spark, base, "day", df.schema)
    one = back.where(F.col("day") == MONDAY)
    assert rows(one.select("id")) == [(1,)]
    assert "PartitionFilters: [isnotnull(day" in plan(one)
    assert back.count() == 3
    with pytest.raises(ValueError, match="not partitioned"):
        parquet.read_partitioned(spark, base, "id")


def test_materialize(spark, folder):
    df = spark.range(3)
    assert load.materialize(df, "m", "inline") is df
    assert load.materialize(df, "m_view", "view").count() == 3
    assert spark.catalog.tableExists("m_view")
    for _ in range(2):
        assert load.materialize(df, "m_table", "table", folder=folder("tables")).count() == 3
    assert storage.table_exists(spark, "m_table")
    spark.sql("DROP TABLE m_table")
    with pytest.raises(ValueError):
        load.materialize(df, "m", "cube")


def test_existence_checks(spark, folder):
    parquet.write_flat(spark.range(1), folder("a"))
    assert storage.files_exist(spark, folder("a") + "/*.parquet")
    assert not storage.files_exist(spark, folder("b") + "/*.parquet")
    assert storage.table_exists(spark, folder("a")) and not storage.table_exists(spark, folder("b"))
    assert not storage.table_exists(spark, "no_such_table")


# --- streams ----------------------------------------------------------------


def test_late_rows_of_a_stream_are_kept_apart(spark, folder):
    """Per micro-batch: on time, repeated, late, without a time; a replay changes nothing."""
    schema = "id long, at string"
    src, target, late, progress = folder("src"), folder("target"), folder("late"), folder("progress")
    arrivals = [
        [(1, "2024-01-10 00:00:00"), (2, "2024-01-01 00:00:00"), (1, "2024-01-10 01:00:00")],
        [(3, "2024-01-08 00:00:00"), (1, "2024-01-09 00:00:00"), (4, "2024-01-06 23:59:59"), (5, None), (6, "2024-02-01 00:00:00")],
        [(7, "2024-01-28 00:00:00"), (8, "2024-01-30 00:00:00"), (6, "2024-02-02 00:00:00")],
    ]
    for rows_ in arrivals:
        parquet.write_flat(spark.createDataFrame(rows_, schema), src, mode="append")
        stream = spark.readStream.schema(schema).parquet(src).withColumn("day", F.to_date("at"))
        stream_dedup_with_late(stream, target, late, ["id"], "at", "day", progress).awaitTermination()
    assert rows(read_target(spark, target).select("id", "at")) == [
        (1, "2024-01-10 00:00:00"), (2, "2024-01-01 00:00:00"), (3, "2024-01-08 00:00:00"), (5, None), (6, "2024-02-01 00:00:00"), (8, "2024-01-30 00:00:00"),
    ]
    left = spark.read.schema(schema).parquet(late).select("id", "at")
    assert rows(left) == [(4, "2024-01-06 23:59:59"), (7, "2024-01-28 00:00:00")]
    # The last micro-batch once more, as after a failure before its commit was noted.
    for kind in ("commits",):
        newest = max(Path(progress, kind).glob("[0-9]*"), key=lambda p: int(p.name))
        newest.unlink()
        newest.with_name(f".{newest.name}.crc").unlink(missing_ok=True)
    stream = spark.readStream.schema(schema).parquet(src).withColumn("day", F.to_date("at"))
    stream_dedup_with_late(stream, target, late, ["id"], "at", "day", progress).awaitTermination()
    assert rows(spark.read.schema(schema).parquet(late).select("id", "at")) == [(4, "2024-01-06 23:59:59"), (7, "2024-01-28 00:00:00")]
    assert read_target(spark, target).count() == 6
