"""Keep the first row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order``, then by the remaining columns.

    The tie-break makes the kept row a function of the data alone.  Spark
    pushes the rank limit below the shuffle, so each task sends at most one
    row per key and a key with many copies stays cheap.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, *order}]
    ranked = Window.partitionBy(*keys).orderBy(*(F.asc_nulls_last(c) for c in [*order, *tie_break]))
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
