"""Type 2 history from a current-state source (timestamp strategy)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.upsert import align_schemas, repeated_keys
from cartwright.sources.publish import finish_pending, partition_folders, publish, read_target, stage

SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = (
    "dbt_scd_id",
    "dbt_updated_at",
    "dbt_valid_from",
    "dbt_valid_to",
)
HISTORY_COLUMNS = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]
SLICE = "history_slice"
OPEN_SLICE = "open"


def _opened(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Every source row as a fresh version."""
    changed_at = F.col(updated_at).cast("timestamp_ntz")
    return source.withColumns(
        {
            SCD_ID: F.md5(F.concat_ws("|", F.col(key).cast("string"), changed_at.cast("string"))),
            UPDATED_AT: changed_at,
            VALID_FROM: changed_at,
            VALID_TO: F.lit(None).cast("timestamp_ntz"),
        }
    )


def scd2_merge(
    current: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    *,
    now: dt.datetime,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """Compare the open versions with the source.

    Returns the versions open afterwards and those closed by this run.  Source
    and open versions hold a key once each, so the full outer join meets no
    hot key.
    """
    fresh = _opened(source, key, updated_at)
    if current is None:
        return fresh
    old, new = align_schemas(current, fresh)
    columns = old.columns
    before = old.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("was"))
    after = new.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("gets"))
    pairs = before.join(after, F.col("_old_key") == F.col("_new_key"), "full_outer")

    was, gets = F.col("was"), F.col("gets")
    newer = F.coalesce(gets[VALID_FROM] > was[VALID_FROM], F.lit(False))
    closing = F.when(newer, gets[VALID_FROM])
    if invalidate_hard_deletes:
        closing = closing.when(gets.isNull(), F.lit(now).cast("timestamp_ntz"))
    kept = F.when(was.isNotNull(), was.withField(VALID_TO, closing))
    opened = F.when(gets.isNotNull() & (was.isNull() | newer), gets)
    versions = F.filter(F.array(kept, opened), lambda version: version.isNotNull())
    return pairs.select(F.inline(versions)).select(*columns)


def read_history(spark: SparkSession, history: str) -> DataFrame | None:
    stored = read_target(spark, history)
    return None if stored is None else stored.drop(SLICE)


def scd2_snapshot(
    spark: SparkSession,
    history: str,
    source: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    *,
    now: dt.datetime,
    invalidate_hard_deletes: bool = True,
    assert_unique_source: bool = True,
) -> DataFrame:
    """Bring the history table at ``history`` up to date and return it.

    A source that repeats a key is refused: each copy would open a version.
    Open versions live in one slice, closed ones in one for each month in which
    they ended, so the number of folders follows the calendar and not the number of runs. A run reads and
    rewrites the open slice and the months in which it closes something, as a rule the latest.
    """
    if assert_unique_source and repeated_keys(source, [key]).take(1):
        raise ValueError(f"the source repeats {key}")
    finish_pending(spark, history)
    stored = read_target(spark, history)
    current = None if stored is None else stored.where(F.col(SLICE) == OPEN_SLICE).drop(SLICE)
    merged = scd2_merge(
        current, source, key, updated_at, now=now, invalidate_hard_deletes=invalidate_hard_deletes
    )
    month = F.concat(F.lit("closed_"), F.date_format(VALID_TO, "yyyyMM"))
    sliced = merged.withColumn(SLICE, F.when(F.col(VALID_TO).isNull(), OPEN_SLICE).otherwise(month))
    stage(spark, sliced, history, SLICE)
    closing = set(partition_folders(spark, f"{history.rstrip('/')}/_pending/rows", SLICE)) - {OPEN_SLICE}
    before = set() if stored is None else closing & set(partition_folders(spark, history, SLICE))
    if before:
        earlier = stored.where(F.col(SLICE).isin(*before))
        _, aligned = align_schemas(sliced, earlier)
        stage(spark, aligned, history, SLICE, mode="append")
    publish(spark, history, sliced.schema, SLICE, [OPEN_SLICE])
    return read_history(spark, history)
