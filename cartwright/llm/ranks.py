"""Exact ranks within groups of any size, without a window over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, group: str, order: list[str], path: str) -> DataFrame:
    """``rows`` with ``owner``, the number of the row's group among all groups in their order, ``rank``, the row's number in its
    group (both from 0), and ``n``, the size of the group. Nulls come first and are a group.

    The rows are dealt out by ranges of (group, order) and written to ``path``, sorted, with a running number. What comes
    before a range is summed over one row per range and group, so no window holds more rows than
    there are ranges or groups in a range, and a group with a third of the table is spread over a third of the ranges. Rows
    that are equal in ``group`` and ``order`` spread too, by a seeded random number; their ranks among each other are arbitrary.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "_tie"]
    dealt = rows.withColumn("_tie", F.rand(7)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    # The running number holds the range in its upper bits.
    placed = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    heads = placed.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    same_group = Window.partitionBy(group)
    earlier = F.sum("_rows").over(same_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    in_range = Window.partitionBy("_range").orderBy(F.col(group).asc_nulls_first())
    heads = heads.select(
        "*", F.coalesce(earlier, F.lit(0)).alias("_before"), F.sum("_rows").over(same_group).alias("n")
    ).withColumn("_new", F.sum(F.when(F.col("_before") == 0, 1).otherwise(0)).over(in_range))
    by_range = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = heads.groupBy("_range").agg(F.max("_new").alias("_all")).select("_range", F.sum("_all").over(by_range).alias("_old"))
    heads = heads.join(ranges, "_range").select(
        F.col("_range").alias("_r"),
        F.col(group).alias("_g"),
        "_first",
        "_before",
        "n",
        (F.coalesce("_old", F.lit(0)) + F.col("_new") - 1).alias("owner"),
    )
    met = placed.join(heads, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    return met.select(*rows.columns, "owner", (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), "n")
