"""Joining facts to the dimension version that was valid at their time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.hot import cut_points, with_piece

# Fixed value: end of a version that is still open, in the closed comparison.
OPEN_END = "2999-12-31"


def supersede(valid_to: Column, next_valid_from: Column) -> Column:
    """End of validity when a newer version replaces the older from its start."""
    return F.least(valid_to, next_valid_from)


def _by_piece(
    facts: DataFrame, versions: DataFrame, key: str, ts: str, valid_from: str, valid_to: str, hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_piece``: 0 for ordinary keys; for hot ones the piece of time the fact lies in, and each piece a
    version reaches into. Times are cut where the versions' starts are parted evenly, however close they lie; an
    open version reaches to the last piece."""
    cuts = cut_points(versions, key, valid_from, hot)
    dated = with_piece(facts, key, cuts, _at=F.col(ts))
    dated = dated.withColumn("_piece", F.when(F.col("_n_cuts").isNull(), 0).otherwise(F.coalesce("_at", F.lit(-1))))
    reached = with_piece(versions, key, cuts, _begin=F.col(valid_from), _end=F.col(valid_to))
    begin, end = F.col("_begin"), F.coalesce("_end", "_n_cuts")
    covered = F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))
    pieces = F.when(F.col("_n_cuts").isNull(), F.array(F.lit(0))).otherwise(covered)
    listed = reached.withColumn("_piece", F.explode(pieces))
    return dated.drop("_at", "_n_cuts"), listed.drop("_begin", "_end", "_n_cuts")


def pit_join(
    left: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    valid_from: str,
    valid_to: str,
    closed: str = "left",
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left columns plus the dimension's columns (without its key and range).

    ``closed="left"`` matches ``from <= ts < to`` with NULL ``to`` open;
    ``closed="both"`` matches both ends, so a fact on a boundary meets two
    versions.  The range columns are timestamps named unlike any left column.

    The key drives the join and the range filters its matches; both sides come
    straight from a shuffle, so AQE can split a key with very many facts.  A
    key with very many versions (``hot``, found on ``dim``) would compare each
    of its facts with each of them, so its rows also have to agree on the piece of time.
    """
    if closed not in ("left", "both") or how not in ("left", "inner"):
        raise ValueError("closed is 'left' or 'both', how is 'left' or 'inner'")
    at, lo, hi = F.col(ts), F.col(valid_from), F.col(valid_to)
    if closed == "both":
        valid = at.between(lo, F.coalesce(hi, F.lit(OPEN_END).cast("timestamp_ntz")))
    else:
        valid = (lo <= at) & (hi.isNull() | (at < hi))
    facts, versions = left, dim
    if hot is not None:
        facts, versions = _by_piece(left, dim, key, ts, valid_from, valid_to, hot)
        versions = versions.withColumnRenamed("_piece", "_dim_piece")
        valid = valid & (F.col("_piece") == F.col("_dim_piece"))
    versions = versions.withColumnRenamed(key, "_dim_key")
    matched = facts.join(versions, (F.col(key) == F.col("_dim_key")) & valid, how)
    taken = [c for c in dim.columns if c not in (key, valid_from, valid_to)]
    return matched.select(*left.columns, *taken)
