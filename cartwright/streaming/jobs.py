"""Incremental runs whose progress the streaming checkpoint keeps.

Each query processes what has arrived and stops (``availableNow``), so it can
be scheduled like its batch twin.  Checkpoints belong in shared storage.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cartwright.operators.dedup import dedup_first
from cartwright.operators.hot import right_keys, same_keys
from cartwright.operators.upsert import upsert
from cartwright.plans.staging import funnel_stage, timestamp_of
from cartwright.sources import storage
from cartwright.sources.keyindex import may_hold
from cartwright.sources.publish import finish_pending, in_partitions, partition_folders, read_target, value_of, written_copy


def read_stream(spark: SparkSession, src: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(src)


def stream_ingest(
    spark: SparkSession, src: str, dst: str, schema: StructType, checkpoint: str
) -> StreamingQuery:
    """Append every file not yet loaded.

    The checkpoint remembers files, not a newest timestamp, so rows that
    arrive with an old timestamp are loaded like any other.
    """
    return (
        read_stream(spark, src, schema)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", dst)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedup_events(raw_events: DataFrame, delay: str = "3 days") -> DataFrame:
    """Staged events from a stream, each id once within the watermark.

    State is kept for ``delay`` only, and an event that comes later than that
    is not emitted; where such events must not be lost, use ``stream_dedup_with_late`` or ``stream_upsert``.
    """
    typed = raw_events.select(
        "event_id",
        "session_id",
        "customer_id",
        "product_id",
        "event_type",
        timestamp_of("event_ts").cast("timestamp").alias("event_ts"),
        funnel_stage(F.col("event_type")).alias("funnel_stage"),
        "channel",
        "device",
        "ingested_at",
        "batch_id",
    )
    once = typed.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return once.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


LATE_STATE = "_late.json"


def stream_dedup_with_late(
    stream: DataFrame,
    target: str,
    late: str,
    keys: Sequence[str],
    time_col: str,
    partition_col: str,
    checkpoint: str,
    delay: str = "3 days",
) -> StreamingQuery:
    """Each key once in the table at ``target``; rows that come after the watermark go to the table at ``late``.

    A row is late when it lies more than ``delay`` before the newest row of earlier micro-batches, as a watermark
    has it; one without a time is not. What the two tables hold together is all that came, so nothing is lost without a trace.
    Known keys are looked up in the partitions of ``target`` that may hold them, so no state is kept for them; the
    newest time is a note beside the table. A replayed micro-batch finds the note and the late rows it wrote, and puts both there again.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        note = f"{target.rstrip('/')}/{LATE_STATE}"
        known = json.loads(storage.read_text(session, note) or "{}")
        before = known.get("before") if known.get("epoch") == epoch else known.get("newest")
        with written_copy(session, batch) as rows:
            at = F.col(time_col).cast("timestamp_ntz")
            bound = F.lit(before).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
            is_late = F.coalesce(at < bound, F.lit(False))
            rows.where(is_late).write.mode("overwrite").parquet(f"{late.rstrip('/')}/epoch={epoch}")
            once = dedup_first(rows.where(~is_late), list(keys), [time_col])
            _insert_unknown(session, target, once, keys, partition_col)
            newest = rows.agg(F.max(at).cast("string")).first()[0]
        now = {"epoch": epoch, "before": before, "newest": max(filter(None, (before, newest)), default=None)}
        storage.write_text(session, note, json.dumps(now))

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _insert_unknown(session: SparkSession, target: str, rows: DataFrame, keys: Sequence[str], partition_col: str) -> None:
    """Insert the rows whose key the table does not hold."""
    finish_pending(session, target)
    stored = read_target(session, target)
    if stored is None:
        upsert(session, target, rows, keys, partition_col)
        return
    with written_copy(session, rows) as rows:
        maybe = may_hold(session, target, rows, keys, partition_folders(session, target, partition_col))
        kind = stored.schema[partition_col].dataType
        held = stored.where(in_partitions(partition_col, [value_of(folder, kind) for folder in maybe]))
        fresh = rows.join(right_keys(held.select(*keys), keys), same_keys(keys), "left_anti") if maybe else rows
        upsert(session, target, fresh, keys, partition_col, stable_partitions=True)


def stream_upsert(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_col: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    first_wins: bool = True,
) -> StreamingQuery:
    """Upsert each micro-batch; a batch replayed after a failure changes nothing.

    ``prepare`` turns the micro-batch into fact rows, one per key.  A key that
    the table holds already keeps its row, as in the batch path, where the first
    occurrence stays; without ``first_wins`` the newer row replaces it.  Only partitions
    that may hold a key of the micro-batch by the table's key index are looked into.
    """

    def apply(batch: DataFrame, _epoch: int) -> None:
        session = batch.sparkSession
        rows = batch if prepare is None else prepare(batch)
        if first_wins:
            _insert_unknown(session, target, rows, keys, partition_col)
        else:
            upsert(session, target, rows, keys, partition_col)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
