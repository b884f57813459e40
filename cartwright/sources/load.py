"""Loading raw Parquet files into tables: whole, by watermark, or replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from cartwright.sources import ledger, storage
from cartwright.sources.parquet import balanced, read_table

SKIPPED, REFRESHED, APPENDED = "skipped", "full_refresh", "appended"


def _writer(df: DataFrame, mode: str, partition_col: str | None) -> DataFrameWriter:
    if partition_col is None:
        return df.write.mode(mode)
    return balanced(df, partition_col).write.mode(mode).partitionBy(partition_col)


def rebuild(df: DataFrame, dst: str, partition_col: str | None = None) -> None:
    """Store ``df`` as the whole table at ``dst``.

    The new content is complete before it takes the old one's place.
    """
    building = dst.rstrip("/") + "__building"
    _writer(df, "overwrite", partition_col).parquet(building)
    storage.swap_in(df.sparkSession, building, dst)


def full_refresh(
    spark: SparkSession, src: str, dst: str, partition_col: str | None = None, watermark_col: str = "ingested_at"
) -> str:
    """Rebuild ``dst`` from every source file; no source files, no change.

    The ledger of what was read takes the table's place together with its rows.
    """
    if not storage.files_exist(spark, src):
        return SKIPPED
    read = ledger.source_files(spark, src)
    source = read_table(spark, src)
    building = dst.rstrip("/") + "__building"
    _writer(source, "overwrite", partition_col).parquet(building)
    if watermark_col in source.columns:
        ledger.begin(spark, dst, building, read, watermark_col)
    storage.swap_in(spark, building, dst)
    return REFRESHED


def replace_table(spark: SparkSession, src: str, dst: str) -> str:
    """Replace a current-state table by the next batch."""
    if not storage.files_exist(spark, src):
        return SKIPPED
    rebuild(read_table(spark, src), dst)
    return REFRESHED


def watermark(spark: SparkSession, dst: str, watermark_col: str = "ingested_at") -> object | None:
    """Newest loaded value, or None without a table, a column or a value; from the ledger where there is one."""
    if not storage.has_parquet(spark, dst):
        return None
    target = read_table(spark, dst)
    if watermark_col not in target.columns:
        return None
    if ledger.commits(spark, dst):
        return ledger.newest_value(spark, dst, target.schema[watermark_col].dataType)
    return target.agg(F.max(watermark_col)).first()[0]


def incremental_load(
    spark: SparkSession,
    src: str,
    dst: str,
    watermark_col: str = "ingested_at",
    lookback: str | None = None,
    partition_col: str | None = None,
) -> str:
    """Append the source rows that are newer than the newest loaded row.

    Without a target, a watermark column or a watermark value the whole source
    is loaded.  The strict comparison loses rows that arrive with an older
    watermark; ``lookback`` (an interval such as ``"3 days"``) also takes rows of that
    period that the target does not hold yet.

    By the ledger only files are opened that were not read before, and, to find what the target
    holds of the lookback period, those of its files that reach into it.
    """
    if not storage.files_exist(spark, src):
        return SKIPPED
    ledger.finish_loading(spark, dst)
    newest = watermark(spark, dst, watermark_col)
    if newest is None:
        return full_refresh(spark, src, dst, partition_col, watermark_col)
    if not ledger.commits(spark, dst):
        ledger.adopt(spark, dst, watermark_col)
    entries = ledger.read_ledger(spark, dst)
    start = None if lookback is None else F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {lookback}")
    read = ledger.not_taken(spark, src, entries, start)
    # The paths of new files, as many as a load brings.
    paths = [row[0] for row in read.select("path").collect()]
    if not paths:
        return APPENDED
    source = spark.read.option("basePath", _base(src)).parquet(*paths)
    if start is None:
        fresh, taken = source.where(F.col(watermark_col) > F.lit(newest)), F.lit(newest)
    else:
        fresh, taken = _missing_rows(spark, source, dst, entries, watermark_col, start), start
    read = read.withColumns({"taken": taken.cast("string"), "inclusive": F.lit(start is not None)})
    ledger.append(spark, dst, _writer(fresh, "overwrite", partition_col), read, watermark_col)
    return APPENDED


def _base(src: str) -> str:
    """The folder whose children name partitions: ``src`` up to its first wildcard."""
    plain = []
    for part in src.split("/"):
        if any(c in part for c in "*?[{"):
            break
        plain.append(part)
    return "/".join(plain)


def _missing_rows(
    spark: SparkSession, source: DataFrame, dst: str, entries: DataFrame, watermark_col: str, start: Column
) -> DataFrame:
    """Rows since ``start`` that occur more often in source than target."""
    recent = F.col(watermark_col).try_cast("timestamp_ntz") >= start
    schema = read_table(spark, dst).schema
    reaching = entries.where(F.coalesce(F.col("newest").try_cast("timestamp_ntz") >= start, F.lit(True)))
    target = ledger.files_of(spark, dst, reaching, schema)
    return source.where(recent).select(*schema.names).exceptAll(target.where(recent))


def materialize(df: DataFrame, name: str, kind: str, schema: str | None = None, folder: str | None = None) -> DataFrame:
    """Expose a model as an inlined plan, a temp view or a stored table.

    Tables are stored below ``folder``, by default in the session's warehouse.
    """
    spark = df.sparkSession
    if kind == "inline":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}: use inline, view or table")
    if schema:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        name = f"{schema}.{name}"
    writer = df.write.mode("overwrite")
    if folder is not None:
        writer = writer.option("path", f"{folder.rstrip('/')}/{name.replace('.', '/')}")
    writer.saveAsTable(name)
    return spark.table(name)
