"""Delete-and-insert by key, on DataFrames and on partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.hot import right_keys, same_keys
from cartwright.sources.keyindex import may_hold
from cartwright.sources.publish import (
    distinct_values,
    finish_pending,
    in_partitions,
    partition_folders,
    publish,
    read_target,
    stage,
    value_of,
    written_copy,
)


def align_schemas(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both frames the columns of either: the target's first, then new ones."""
    types = {f.name: f.dataType for f in [*batch.schema, *target.schema]}
    columns = [*target.columns, *(c for c in batch.columns if c not in target.columns)]
    for name in set(target.columns) & set(batch.columns):
        if target.schema[name].dataType != batch.schema[name].dataType:
            raise ValueError(f"column {name} changes type in the batch")

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(
            *(c if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns)
        )

    return aligned(target), aligned(batch)


def _matching(target: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool, how: str) -> DataFrame:
    batch_keys = batch.select(*keys).distinct()
    if null_safe:
        return target.join(right_keys(batch_keys, keys), same_keys(keys), how)
    return target.join(batch_keys, list(keys), how)


def upsert_frames(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], *, null_safe: bool = True
) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch."""
    old, new = align_schemas(target, batch)
    return _matching(old, new, keys, null_safe, "left_anti").unionByName(new)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def upsert(
    spark: SparkSession,
    target: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    *,
    null_safe: bool = True,
    stable_partitions: bool = False,
    assert_unique_batch: bool = False,
    arranged: bool = False,
) -> list:
    """Apply ``batch`` to the table at ``target``; returns the touched partitions.

    Only partitions that gain or lose rows are rewritten, and each row is written once: the
    batch first, then the rows that stay in the touched partitions, beside it.  Which other partitions lose rows is
    looked up in the key index; of those that may hold a key of the batch, two columns are
    read.  With ``stable_partitions`` the caller vouches that a key never changes partition and even that is saved.
    A batch that is ``arranged`` comes from ``balanced`` and is written as it lies.
    """
    finish_pending(spark, target)
    current = read_target(spark, target)
    schema = batch.schema
    if current is not None:
        current, batch = align_schemas(current, batch)
        schema = batch.schema
    new = stage(spark, batch, target, partition_col, arranged=arranged)
    if assert_unique_batch and repeated_keys(new, keys).take(1):
        finish_pending(spark, target)  # There is no plan yet: what is staged is dropped.
        raise ValueError(f"the batch repeats a key {tuple(keys)}")
    touched: set = set()
    if current is not None:
        kind = schema[partition_col].dataType
        existing = set(partition_folders(spark, target, partition_col))
        gaining = set(partition_folders(spark, f"{target.rstrip('/')}/_pending/rows", partition_col))
        touched = {value_of(folder, kind) for folder in gaining & existing}
        if not stable_partitions:
            maybe = may_hold(spark, target, new, keys, existing - gaining)
            touched |= _losing(current, new, keys, null_safe, partition_col, {value_of(folder, kind) for folder in maybe})
        if touched:
            affected = current.where(in_partitions(partition_col, touched))
            # A batch of most of these rows: who stays is found by keys alone, so that rows which go are not shuffled.
            if 2 * new.count() > affected.count():
                with written_copy(spark, _matching(affected.select(*keys), new, keys, null_safe, "left_anti").distinct()) as kept:
                    if not kept.isEmpty():
                        staying = _matching(_sifted(affected, kept, keys), kept, keys, True, "left_semi")
                        stage(spark, staying, target, partition_col, mode="append")
            else:
                staying = _matching(affected, new, keys, null_safe, "left_anti")
                stage(spark, staying, target, partition_col, mode="append")
    return publish(spark, target, schema, partition_col, touched, keys)


#: Bits of the filter of staying keys; it is broadcast as at most 2^19 rows of two numbers, whatever the table.
SIFTED_BITS = 1 << 25


def _sifted(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key may be among the ``wanted``: all that are, and few others while there are fewer keys than bits."""
    cell = F.pmod(F.xxhash64(*keys), F.lit(SIFTED_BITS)).alias("_cell")
    bit = F.expr("shiftleft(1L, cast(_cell & 63 as int))")
    words = wanted.select(cell).groupBy(F.shiftright("_cell", 6).alias("_word")).agg(F.bit_or(bit).alias("_mask"))
    probed = rows.select("*", cell).withColumn("_at", F.shiftright("_cell", 6))
    near = probed.join(F.broadcast(words), F.col("_at") == F.col("_word")).where(F.col("_mask").bitwiseAND(bit) != 0)
    return near.select(*rows.columns)


def _losing(
    current: DataFrame, new: DataFrame, keys: Sequence[str], null_safe: bool, partition_col: str, among: set
) -> set:
    """The partitions ``among`` those given that hold a key of ``new``; one value for each comes to the driver."""
    if not among:
        return set()
    slim = current.where(in_partitions(partition_col, among)).select(*dict.fromkeys([*keys, partition_col]))
    return set(distinct_values(_matching(slim, new, keys, null_safe, "left_semi"), partition_col))
