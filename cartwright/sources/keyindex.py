"""What keys the partitions of a table may hold, kept beside the table.

Each partition has the range of its keys and a Bloom filter with 16 to 32 bits per key. Ranges are in one small file with
one entry per partition; filters are Parquet rows of 64 bits, one folder per commit. An entry
is replaced together with its partition (see ``publish``), and one that is missing means that anything may be there, so the index narrows a
search and never changes its result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from cartwright.sources import storage

INDEX_FILE = "_index.json"
FILTERS = "_keys"
HASHES = 4
#: A filter takes a foreign key for its own in 1 of 400 cases at most. So more keys than these would be found
#: everywhere by chance; then only ranges count, and the caller reads the keys of what they leave.
MOST_PROBED = 200


def read_index(spark: SparkSession, target: str) -> dict[str, dict]:
    text = storage.read_text(spark, f"{target.rstrip('/')}/{INDEX_FILE}")
    return {} if text is None else json.loads(text)


def write_index(spark: SparkSession, target: str, entries: dict[str, dict]) -> None:
    """Store the entries; filters that no entry names are deleted."""
    root = target.rstrip("/")
    storage.write_text(spark, f"{root}/{INDEX_FILE}", json.dumps(entries))
    used = {entry["commit"] for entry in entries.values()}
    for commit in set(storage.folders(spark, f"{root}/{FILTERS}")) - used:
        storage.delete(spark, f"{root}/{FILTERS}/{commit}")


def _cells(keys: Sequence[str], bits: Column) -> Column:
    """The key's bits in a filter of so many; null is a key like others."""
    return F.array(*(F.pmod(F.xxhash64(*keys, F.lit(seed)), bits) for seed in range(HASHES)))


def _bit(cell: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))


def _range_of(df: DataFrame, key: str) -> tuple[Column, Column]:
    """Least and greatest key, where keys of this type can be written down; else null."""
    kind = df.schema[key].dataType
    if isinstance(kind, (IntegralType, StringType)):
        return F.min(key), F.max(key)
    return F.lit(None), F.lit(None)


def index_rows(
    spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str], partition_col: str, folder_of
) -> dict[str, dict]:
    """Entries for the partitions of ``rows``; their filters are written below ``target``, where nothing names them yet.

    Reads the keys and the partition twice: once for range and number, which comes to the driver as one row per
    partition, once for the filters, which are as long as the partition needs.
    """
    lo, hi = _range_of(rows, keys[0])
    by_partition = rows.groupBy(partition_col).agg(
        F.count(F.lit(1)).alias("n"), lo.alias("lo"), hi.alias("hi"), F.count_if(F.col(keys[0]).isNull()).alias("nulls")
    )
    commit, entries, sizes = uuid.uuid4().hex, {}, []
    for value, n, low, high, nulls in by_partition.collect():
        bits = 1 << max(10, (16 * n - 1).bit_length())
        entries[folder_of(value)] = {"lo": low, "hi": high, "nulls": nulls > 0, "bits": bits, "commit": commit, "keys": list(keys)}
        sizes.append((value, folder_of(value), bits))
    if not sizes:
        return entries
    schema = rows.select(F.col(partition_col).alias("_value")).schema.add("part", "string").add("bits", "long")
    schema["_value"].nullable = True
    listed = F.broadcast(spark.createDataFrame(sizes, schema))  # One row per partition.
    placed = rows.select(*keys, F.col(partition_col).alias("_own")).join(listed, F.col("_own").eqNullSafe(F.col("_value")))
    cells = placed.select("part", "bits", F.explode(_cells(keys, F.col("bits"))).alias("cell"))
    words = cells.groupBy("part", "bits", F.expr("cell div 64").alias("word")).agg(F.bit_or(_bit(F.col("cell"))).alias("mask"))
    words.write.parquet(f"{target.rstrip('/')}/{FILTERS}/{commit}")
    return entries


def may_hold(spark: SparkSession, target: str, wanted: DataFrame, keys: Sequence[str], among: Iterable[str]) -> set[str]:
    """Of the partition folders ``among`` those that may hold a key of ``wanted``; no data file of the table is opened."""
    among, index = set(among), read_index(spark, target)
    known = {name: e for name, e in index.items() if name in among and e["keys"] == list(keys)}
    if not known:
        return among
    lo, hi = _range_of(wanted, keys[0])
    low, high, nulls, n = wanted.agg(lo, hi, F.count_if(F.col(keys[0]).isNull()), F.count(F.lit(1))).first()
    if not n:
        return set()

    def overlaps(entry: dict) -> bool:
        if nulls and entry["nulls"]:
            return True
        if low is None and nulls < n or entry["lo"] is None and not entry["nulls"]:
            return True  # No range is known.
        return low is not None and entry["lo"] is not None and entry["lo"] <= high and low <= entry["hi"]

    near = {name: e for name, e in known.items() if overlaps(e)}
    if n > MOST_PROBED or not near:
        return (among - known.keys()) | near.keys()
    sizes = F.explode(F.array(*(F.lit(b).cast("long") for b in sorted({e["bits"] for e in near.values()})))).alias("bits")
    named = wanted.select(*keys).distinct().select(F.xxhash64(*keys).alias("_key"), *keys, sizes)
    probes = named.select("_key", "bits", F.explode(_cells(keys, F.col("bits"))).alias("cell")).distinct()
    counted = probes.select("*", F.expr("cell div 64").alias("word"), _bit(F.col("cell")).alias("bit"))
    commits = sorted({e["commit"] for e in near.values()})
    root = f"{target.rstrip('/')}/{FILTERS}"
    filters = spark.read.schema("part string, bits long, word long, mask long").parquet(*(f"{root}/{c}" for c in commits))
    current = spark.createDataFrame([(name, e["bits"], e["commit"]) for name, e in near.items()], "part string, bits long, commit string")
    # A filter counts if the entry names its commit: older commits may still hold filters of replaced partitions.
    commit = F.regexp_extract(F.col("_metadata.file_path"), f"{FILTERS}/([0-9a-f]+)/", 1)
    live = filters.select("*", commit.alias("commit")).join(F.broadcast(current), ["part", "bits", "commit"], "left_semi")
    hits = live.join(counted, ["bits", "word"]).where(F.col("mask").bitwiseAND(F.col("bit")) != 0)
    needed = probes.groupBy("_key", "bits").agg(F.count(F.lit(1)).alias("needed"))
    found = hits.groupBy("part", "_key", "bits").agg(F.count(F.lit(1)).alias("met")).join(needed, ["_key", "bits"])
    maybe = found.where("met = needed").select("part").distinct().collect()
    return (among - known.keys()) | {row[0] for row in maybe}
