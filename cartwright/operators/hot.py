"""Keys that hold so many rows that one task should not get them all.

``find_hot`` reads the key column once into a heavy-hitter sketch of bounded size; no
row is shuffled.  A key is hot by its share of the rows, so by arithmetic only a bounded
number of keys can be.  What the operators then do with the list affects only how rows are
spread, never the result: a list that is out of date, approximate or empty gives the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotKeys:
    """Hot are the keys with more than ``share`` times the rows of an average
    task after a shuffle: no more than shuffle partitions / share keys."""

    share: float = 1.0


#: Keys a sketch can track at most, a limit of the built-in function.
MOST_TRACKED = 1_000_000


def find_hot(df: DataFrame, key: str, limits: HotKeys = HotKeys()) -> DataFrame | None:
    """The hot values of ``key`` with a number of ``pieces`` to cut each into, and about how many rows they have.

    None when there are none, which is the usual case and leaves the plan of
    the calling operator as it would be without this precaution.  A key with
    a single row is never hot, however small the table.

    The sketch tracks 16 times as many keys as can be hot: it errs by a quarter of the
    limit at most and finds every key above the limit (up to some 60,000 tasks; with more, the hottest).
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(math.ceil(tasks / limits.share) + 1, MOST_TRACKED // 16)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {16 * most})")
    n_rows, heaviest = df.agg(F.count(F.lit(1)), sketch).first()
    limit = max(1.0, limits.share * n_rows / tasks)
    rows = [(value, max(2, min(tasks, math.ceil(n / limit))), n) for value, n in heaviest or [] if n > limit]
    if not rows:
        return None
    schema = df.select(key).withColumns({"pieces": F.lit(1), "n_rows": F.lit(1).cast("long")}).schema
    schema[key].nullable = True
    return df.sparkSession.createDataFrame(rows, schema)


def right_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rename the keys of a join's right side, so both sides can be told apart."""
    return df.withColumnsRenamed({key: f"_right_{key}" for key in keys})


def same_keys(keys: Sequence[str]) -> Column:
    """Equality with a ``right_keys`` side, NULL equal to NULL; stays an equi-join."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))


def with_pieces(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``_pieces``: NULL, or the number of pieces of the row's hot key.

    ``hot`` has no more rows than ``HotKeys`` allows, so it is broadcast.
    """
    listed = right_keys(hot.select(key, F.col("pieces").alias("_pieces")), [key])
    return df.join(F.broadcast(listed), same_keys([key]), "left").drop(f"_right_{key}")


#: Values drawn for each piece of a hot key, to find where to cut it.
DRAWN = 32


def cut_points(df: DataFrame, key: str, order_col: str, hot: DataFrame) -> DataFrame:
    """``key, cuts``: for each hot key the values of ``order_col`` that part its rows into about equal pieces.

    Taken from a sample whose size follows the number of pieces, not of rows. They come to the driver, at most one
    for each piece, so that every use of them in a plan sees the same ones.
    """
    listed = right_keys(hot, [key])
    some = df.where(F.col(order_col).isNotNull()).select(key, order_col).join(F.broadcast(listed), same_keys([key]))
    drawn = some.where(F.rand(11) * F.col("n_rows") < F.col("pieces") * DRAWN)
    values = F.sort_array(F.collect_list(order_col)).alias("values")
    sampled = drawn.groupBy(key).agg(values, F.first("pieces").alias("pieces"))
    places = F.sequence(F.lit(1), F.col("pieces") - 1)
    cuts = F.array_distinct(F.transform(places, lambda i: F.get("values", F.expr("size(values)") * i / F.col("pieces"))))
    found = sampled.select(key, cuts.alias("cuts"))
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def with_piece(df: DataFrame, key: str, cuts: DataFrame, **positions: Column) -> DataFrame:
    """Add for each of ``positions`` the number of its key's cuts up to it: it never decreases along the key.

    NULL for keys without cuts, and where the position is NULL.
    """
    listed = right_keys(cuts.withColumnRenamed("cuts", "_cuts"), [key])
    known = df.join(F.broadcast(listed), same_keys([key]), "left")

    def passed(at: Column) -> Column:
        return F.when(at.isNotNull(), F.size(F.filter("_cuts", lambda c: c <= at)))

    numbered = {name: F.when(F.col("_cuts").isNotNull(), passed(at)) for name, at in positions.items()}
    return known.withColumns(numbered | {"_n_cuts": F.when(F.col("_cuts").isNotNull(), F.size("_cuts"))}).drop(f"_right_{key}", "_cuts")
