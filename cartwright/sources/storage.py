"""Existence checks and folder swaps on whatever file system a path names."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _hadoop(spark, path)
    return fs.exists(location)


def files_exist(spark: SparkSession, pattern: str) -> bool:
    """True when a path or glob pattern matches something."""
    fs, location = _hadoop(spark, pattern)
    found = fs.globStatus(location)
    return found is not None and len(found) > 0


def is_hidden(name: str) -> bool:
    """Names Spark's readers pass over, by the same rule."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _below(spark: SparkSession, path: str) -> Iterator[tuple[str, Any]]:
    """Visible files at any depth, lazily: path relative to ``path``, and the file's own."""
    fs, location = _hadoop(spark, path)
    if not fs.exists(location):
        return
    base = str(fs.makeQualified(location)).rstrip("/") + "/"
    listing = fs.listFiles(location, True)
    while listing.hasNext():
        found = listing.next().getPath()
        relative = str(found).removeprefix(base)
        if not any(is_hidden(part) for part in relative.split("/")):
            yield relative, found


def has_parquet(spark: SparkSession, path: str) -> bool:
    """True when a dataset folder holds a data file at any depth; stops at the first hit."""
    return any(relative.endswith(".parquet") for relative, _ in _below(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path."""
    fs, location = _hadoop(spark, path)
    if not fs.exists(location):
        return []
    return [found.getPath().getName() for found in fs.listStatus(location) if found.isDirectory()]


def move(spark: SparkSession, source: str, destination: str) -> None:
    """Put a file or folder in the place of what is at ``destination``.

    Can be repeated after it was cut off: it is done when the source is gone.
    """
    fs, old = _hadoop(spark, source)
    _, new = _hadoop(spark, destination)
    if not fs.exists(old):
        return
    if fs.exists(new):
        fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot put {source} in place of {destination}")


def move_files(spark: SparkSession, source: str, destination: str) -> None:
    """Move the files below one folder to the same places below another; can be repeated like ``move``."""
    fs, base = _hadoop(spark, destination)
    made = set()
    for relative, found in list(_below(spark, source)):
        _, new = _hadoop(spark, f"{destination.rstrip('/')}/{relative}")
        parent = relative.rpartition("/")[0]
        if parent not in made:
            fs.mkdirs(new.getParent())
            made.add(parent)
        if not fs.rename(found, new):
            raise OSError(f"cannot move {found} below {base}")


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """True for a catalog table or for a dataset folder holding data files."""
    if "/" in name_or_path:
        return has_parquet(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, location = _hadoop(spark, path)
    if fs.exists(location):
        fs.delete(location, True)


def swap_in(spark: SparkSession, finished: str, live: str) -> None:
    """Put a fully written folder in the place of the live one by renames."""
    fs, new = _hadoop(spark, finished)
    _, target = _hadoop(spark, live)
    if fs.exists(target):
        _, retired = _hadoop(spark, live.rstrip("/") + "__retired")
        if fs.exists(retired):
            fs.delete(retired, True)
        if not fs.rename(target, retired):
            raise OSError(f"cannot retire {live}")
        if not fs.rename(new, target):
            fs.rename(retired, target)
            raise OSError(f"cannot put {finished} in place of {live}")
        fs.delete(retired, True)
        return
    fs.mkdirs(target.getParent())
    if not fs.rename(new, target):
        raise OSError(f"cannot put {finished} in place of {live}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small metadata file, complete before it appears under its name."""
    fs, partial = _hadoop(spark, path + ".partial")
    _, final = _hadoop(spark, path)
    out = fs.create(partial, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(partial, final):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, location = _hadoop(spark, path)
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
