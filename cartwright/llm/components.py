"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.session import shared_dir


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for each node of ``links`` (a, b).

    Each round points every node's neighbours at the smallest of them: first the larger
    neighbours, then the smaller ones. Both are aggregates with map-side combine and a join back, so no
    neighbourhood is ever gathered in one place. Rounds are written tables in the shared folder; a
    number per round comes to the driver.
    """
    spark = links.sparkSession
    folder = f"{shared_dir(spark)}/components-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def ordered(df: DataFrame) -> DataFrame:
        """Larger node first; no loops, no repetition."""
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def star(edges: DataFrame) -> DataFrame:
        """Large star: the larger neighbours of each node, and small star after it."""
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = ordered(both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        down = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        near = large.join(down, F.col("a") == F.col("n"))
        return ordered(near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(near.select("a", F.col("m").alias("b"))))

    edges, sign, turn = stored(ordered(links), "0"), None, 0
    while True:
        turn += 1
        edges = stored(star(edges), str(turn))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        sign = now
