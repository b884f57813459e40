"""Which files a table was loaded from, which it consists of, and the newest value in each.

A load is a commit: rows are written once to a hidden folder inside the table, the ledger's entries beside them, and a
note says that both are complete. Then the files are renamed into the table, the entries last. A
load that is lost in between is finished by the next one. With the ledger a load lists the source
folder, opens new files only, and reads no old file of the table to find the newest value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from cartwright.sources import storage

LEDGER, LOADING = "_ledger", "_loading"
#: ``newest`` is of a TABLE file. A SOURCE file was taken from ``taken`` on (``inclusive`` or not), as a whole where that is null.
ENTRY = "kind string, path string, length long, modified timestamp, newest string, taken string, inclusive boolean"
SOURCE, TABLE = "source", "table"


def _entry(kind: str, **known: Column) -> list[Column]:
    values = {"kind": F.lit(kind), **known}
    types = dict(pair.split() for pair in ENTRY.split(", "))
    return [values.get(name, F.lit(None)).cast(type_).alias(name) for name, type_ in types.items()]


def source_files(spark: SparkSession, src: str) -> DataFrame:
    """SOURCE entries of the Parquet files below ``src``, from their listing; a file that is written anew is another one."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(src).select(*_entry(SOURCE, path=F.col("path"), length=F.col("length"), modified=F.col("modificationTime")))


def table_files(spark: SparkSession, written: str, watermark_col: str) -> DataFrame:
    """TABLE entries of what was written below a folder: path in the table and newest value, from one column."""
    rows = spark.read.parquet(written)
    path = F.regexp_extract("file", r"([^/]+=[^/]*/)*[^/]+$", 0)
    newest = F.max(watermark_col) if watermark_col in rows.columns else F.max(F.lit(None))
    # The search is for each file, not for each row.
    by_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(newest.alias("newest"))
    by_file = by_file.groupBy(path.alias("path")).agg(F.max("newest").alias("newest"))
    return by_file.select(*_entry(TABLE, path=F.col("path"), newest=F.col("newest")))


def commits(spark: SparkSession, dst: str) -> list[str]:
    """Names of the table's loads, oldest first; empty for a table without a ledger."""
    return sorted(name for name in storage.folders(spark, f"{dst.rstrip('/')}/{LEDGER}"))


def read_ledger(spark: SparkSession, dst: str, names: list[str] | None = None) -> DataFrame | None:
    """All entries, or those of some loads."""
    names = commits(spark, dst) if names is None else names
    if not names:
        return None
    return spark.read.schema(ENTRY).parquet(*(f"{dst.rstrip('/')}/{LEDGER}/{name}" for name in names))


def next_commit(spark: SparkSession, dst: str) -> str:
    """Numbered, and unlike any load of a table that stood there before."""
    before = commits(spark, dst)
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    return f"{number:012d}-{uuid.uuid4().hex[:8]}"


def finish_loading(spark: SparkSession, dst: str) -> bool:
    """Finish a load that was lost while its files were renamed; drop one that was not complete."""
    root, live = f"{dst.rstrip('/')}/{LOADING}", dst.rstrip("/")
    name = storage.read_text(spark, f"{root}/complete.txt")
    if name is None:
        storage.delete(spark, root)
        return False
    storage.move_files(spark, f"{root}/rows", live)
    storage.move(spark, f"{root}/entries", f"{live}/{LEDGER}/{name}")
    storage.delete(spark, root)
    return True


def append(spark: SparkSession, dst: str, writer, read: DataFrame, watermark_col: str) -> None:
    """Add rows and the SOURCE entries ``read`` to the table in one commit; ``writer`` is a writer of the rows."""
    root = f"{dst.rstrip('/')}/{LOADING}"
    writer.parquet(f"{root}/rows")
    entries = read
    if storage.has_parquet(spark, f"{root}/rows"):
        entries = entries.unionByName(table_files(spark, f"{root}/rows", watermark_col))
    entries.write.mode("overwrite").parquet(f"{root}/entries")
    storage.write_text(spark, f"{root}/complete.txt", next_commit(spark, dst))
    finish_loading(spark, dst)


def adopt(spark: SparkSession, dst: str, watermark_col: str) -> None:
    """Give a table that was loaded without a ledger its first entries."""
    root = f"{dst.rstrip('/')}/{LOADING}"
    table_files(spark, dst, watermark_col).write.mode("overwrite").parquet(f"{root}/entries")
    storage.write_text(spark, f"{root}/complete.txt", next_commit(spark, dst))
    finish_loading(spark, dst)


def begin(spark: SparkSession, dst: str, building: str, read: DataFrame, watermark_col: str) -> None:
    """Write the entries of a rebuilt table beside its rows below ``building``, before both take the place of ``dst``."""
    entries = table_files(spark, building, watermark_col).unionByName(read)
    entries.write.mode("overwrite").parquet(f"{building.rstrip('/')}/{LEDGER}/{next_commit(spark, dst)}")


def newest_value(spark: SparkSession, dst: str, kind: DataType) -> object | None:
    """The newest loaded value as a ``kind``, from the ledger's entries alone."""
    entries = read_ledger(spark, dst).where(F.col("kind") == TABLE)
    return entries.agg(F.max(F.col("newest").cast(kind))).first()[0]


def not_taken(spark: SparkSession, src: str, entries: DataFrame, start: Column | None) -> DataFrame:
    """SOURCE entries of files that were not read yet, or, with ``start``, not as far back as that."""
    known = entries.where(F.col("kind") == SOURCE)
    if start is not None:
        taken = F.col("taken").cast("timestamp_ntz")
        known = known.where(F.col("taken").isNull() | (taken < start) | ((taken == start) & F.col("inclusive")))
    same = ["path", "length", "modified"]
    return source_files(spark, src).join(known.select(*same).distinct(), same, "left_anti").select(*known.columns)


def files_of(spark: SparkSession, dst: str, entries: DataFrame, schema: StructType) -> DataFrame:
    """The rows of the table files among ``entries``; only those files are listed or opened."""
    paths = [row[0] for row in entries.where(F.col("kind") == TABLE).select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    root = dst.rstrip("/")
    return spark.read.schema(schema).option("basePath", root).parquet(*(f"{root}/{path}" for path in paths))


def loaded_after(spark: SparkSession, dst: str, commit: str | None, schema: StructType) -> DataFrame:
    """The rows loaded after a commit; all rows if the table no longer knows it, as after a full refresh."""
    names = commits(spark, dst)
    if commit is None or commit not in names:
        return spark.read.schema(schema).parquet(dst)
    later = read_ledger(spark, dst, names[names.index(commit) + 1 :]) if names[-1] != commit else None
    return spark.createDataFrame([], schema) if later is None else files_of(spark, dst, later, schema)
