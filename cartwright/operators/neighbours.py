"""Values of the next or previous row of the same key, also for huge keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.operators.hot import cut_points, with_piece


def with_neighbour(
    df: DataFrame,
    key: str,
    order_col: str,
    take: Mapping[str, str],
    direction: str = "next",
    tie_break: Sequence[str] = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``take`` = {new column: source column} from the neighbouring row.

    Rows of a key are ordered by ``order_col`` (NULL last), then ``tie_break``;
    each key is one window group.  With ``hot`` keys (see ``find_hot``), a hot
    key is cut at values of ``order_col`` that part its rows evenly, so also a key
    whose rows share one day.  Each piece is its own group, and
    a stand-in for the adjacent piece's nearest row closes it: pieces of all
    hot keys together have one stand-in each, whatever their number of rows.
    """
    if direction not in ("next", "previous"):
        raise ValueError("direction is 'next' or 'previous'")
    forward = direction == "next"
    shift = F.lead if forward else F.lag
    values = F.struct(*(F.col(source).alias(name) for name, source in take.items()))
    sorting = [F.asc_nulls_last(order_col), *(F.asc(c) for c in tie_break)]
    added = {name: F.col("_near")[name] for name in take}
    if hot is None:
        group = Window.partitionBy(key).orderBy(*sorting)
        return df.withColumn("_near", shift(values).over(group)).withColumns(added).drop("_near")

    numbered = with_piece(df, key, cut_points(df, key, order_col, hot), _at=F.col(order_col))
    # Rows without a place come last.
    cut = numbered.select(
        *df.columns,
        F.when(F.col("_n_cuts").isNotNull(), F.coalesce("_at", F.col("_n_cuts") + 1)).alias("_piece"),
        values.alias("_values"),
        F.lit(False).alias("_stands_in"),
    )
    position = F.struct(F.col(order_col), *(F.col(c) for c in tie_break))
    nearest = F.min_by("_values", position) if forward else F.max_by("_values", position)
    edges = cut.where(F.col("_piece").isNotNull()).groupBy(key, "_piece").agg(nearest.alias("_edge"))
    adjacent = shift("_edge").over(Window.partitionBy(key).orderBy("_piece"))
    stand_ins = edges.withColumn("_values", adjacent).where(F.col("_values").isNotNull())
    stand_ins = stand_ins.drop("_edge").withColumn("_stands_in", F.lit(True))

    closing = F.asc("_stands_in") if forward else F.desc("_stands_in")
    group = Window.partitionBy(key, "_piece").orderBy(closing, *sorting)
    pieces = cut.unionByName(stand_ins, allowMissingColumns=True)
    near = pieces.withColumn("_near", shift("_values").over(group)).where(~F.col("_stands_in"))
    return near.withColumns(added).select(*df.columns, *take)
