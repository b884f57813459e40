"""Left join to a table that holds each key once, safe with hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.hot import with_pieces


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Add the columns of ``lookup`` (unique on ``key``) to every fact.

    With ``hot`` keys (see ``find_hot``), facts of a hot key are dealt out to
    its pieces and its lookup row is repeated once per piece.  The piece comes
    from the task that holds the row, not from a random number, so a task that
    is run again deals the same way; and it also parts exact copies.  Call it
    on facts that come from a scan, where a hot key is spread over many tasks.
    """
    added = [c for c in lookup.columns if c != key]
    if hot is None:
        return facts.join(lookup, key, "left").select(*facts.columns, *added)
    dealt = with_pieces(facts, key, hot).withColumn(
        "_piece", F.coalesce(F.pmod(F.spark_partition_id(), F.col("_pieces")), F.lit(0))
    )
    every_piece = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    repeated = with_pieces(lookup, key, hot).withColumn("_piece", F.explode(every_piece))
    joined = dealt.join(repeated.drop("_pieces"), [key, "_piece"], "left")
    return joined.select(*facts.columns, *added)
