"""A Bloom filter of row keys, so that long texts are not shuffled only to be dropped by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter. It is broadcast as one row of two numbers for 64 bits, so at most 2^19 rows whatever the input.
BITS = 1 << 25


def _cell(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITS))


def sifted(rows: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str]) -> DataFrame:
    """The rows whose ``columns`` may be among the keys: all that are, and few others while there are fewer keys than bits.

    Beyond that it lets more and more through; the join that follows decides in any case.
    Null is a value like others. The columns of ``rows`` stay as they are.
    """
    cell = _cell(*key_columns)
    bit = F.expr("shiftleft(1L, cast(_cell & 63 as int))")
    words = keys.select(cell.alias("_cell")).groupBy(F.shiftright("_cell", 6).alias("_word")).agg(F.bit_or(bit).alias("_mask"))
    probed = rows.withColumn("_cell", _cell(*columns)).withColumn("_at", F.shiftright("_cell", 6))
    met = probed.join(F.broadcast(words), F.col("_at") == F.col("_word")).where(F.col("_mask").bitwiseAND(bit) != 0)
    return met.select(*(F.col(f"`{c}`") for c in rows.columns))
