"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# UTC keeps wall-clock (NTZ) and zoned timestamps interchangeable.  The AQE
# settings let Spark split a join partition that one hot key has filled, even
# when a later operator wanted the unsplit partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; sizes and memory stay with the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "cartwright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session for jobs, benches and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder, because
    there driver and executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="cartwright-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback
