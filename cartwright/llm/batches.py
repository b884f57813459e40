"""Helpers of the operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows go to Python workers by so many bytes at once. The default counts 10,000 rows or 64 MB, of which the executor and
#: the worker hold several copies for each task.
MOST_BATCH = 1 << 20


def in_small_batches(spark: SparkSession) -> SparkSession:
    """Lets later queries of the session send long texts to Python workers in batches of few bytes."""
    spark.conf.set(BATCH_BYTES, str(MOST_BATCH))
    return spark


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column in one array, and the n + 1 offsets; null is empty."""
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = filled.buffers()
    starts = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def pieces(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows with about ``size`` bytes each; a longer row is alone in its range."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (multiply and shift), so that all bits depend on all bits."""
    out = values ^ (values >> np.uint64(32))
    out = out * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


#: Odd, so that it has an inverse modulo 2**64.
BASE = 0xD6E8FEB86659FD93
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2**64 for i < n, kept for the next call."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[size] = (both[0], both[1])
    return _POWERS[size][0][:n], _POWERS[size][1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte * BASE ** position before each position, n + 1 values."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range that depends on its bytes and its length only."""
    _, down = powers(len(sums))
    value = (sums[ends] - sums[starts]) * down[starts]
    return mixed(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))
