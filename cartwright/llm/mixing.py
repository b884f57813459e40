"""Mixing sources to target weights by hash-seeded Poisson replication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mixture:
    """``weights``: relative target weight by source; sources that are not named
    get their number of rows to the power ``temper``.  ``epochs``: rows out per
    row in, on average.  ``most_rate``: a larger repetition rate is drawn in equal
    parts of at most so much, as exp(-rate) is 0 in a double beyond 745."""

    weights: tuple[tuple[str, float], ...] = ()
    temper: float = 0.5
    epochs: float = 1.0
    seed: int = 42
    most_rate: float = 500.0


def uniform(seed: int, *values: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(v.cast("string"), F.lit("~")) for v in values))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, mix: Mixture) -> DataFrame:
    """``_source, rate, parts, cdf``: the mean number of copies of each source, the number of
    equal parts it is drawn in, and the Poisson distribution function of a part, as
    far as it differs from 1 in a double.

    Counts cover all rows; null is a source of its own.
    """
    counted = docs.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    given = F.create_map(*(F.lit(x) for pair in mix.weights for x in pair)) if mix.weights else None
    own = F.pow("n", F.lit(mix.temper))
    weight = F.coalesce(F.element_at(given, F.coalesce("_source", F.lit("~"))), own) if mix.weights else own
    weighed = counted.withColumn("weight", weight.cast("double"))
    whole = weighed.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_weight"))
    rate = F.round(F.col("weight") / F.col("all_weight") * F.col("all_n") * F.lit(mix.epochs) / F.col("n"), 9)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(mix.most_rate)).cast("int"))
    steps = F.sequence(F.lit(1), (F.ceil(F.col("part") + 12 * F.sqrt("part")) + 20).cast("int"))
    # p(k) = p(k - 1) * part / k, and their running sums, in one fold.
    start = F.struct(
        F.exp(-F.col("part")).alias("p"), F.exp(-F.col("part")).alias("sum"), F.array(F.exp(-F.col("part"))).alias("cdf")
    )

    def step(so_far: Column, k: Column) -> Column:
        p = so_far["p"] * F.col("part") / k
        total = so_far["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.concat(so_far["cdf"], F.array(total)).alias("cdf"))

    return (
        weighed.crossJoin(F.broadcast(whole))  # one row of totals
        .withColumn("rate", rate)
        .withColumn("parts", parts)
        .withColumn("part", F.col("rate") / F.col("parts"))
        .select("_source", "rate", "parts", F.aggregate(steps, start, step)["cdf"].alias("cdf"))
    )


def small_side(table: DataFrame, most: int = 10_000) -> DataFrame:
    """The table marked for broadcast if it has at most ``most`` rows, else as it
    is, for a shuffle join whose skewed partitions Spark splits."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with a ``_key`` that their draws depend on: the doc_id, or for a null id
    a hash of all columns and a number that tells equal rows apart.

    Equal rows with a null id are counted and numbered by that count, so the keys do not depend on partitioning.
    """
    named = docs.where("doc_id is not null").withColumn("_key", F.col("doc_id").cast("string"))
    columns = [F.col(c) for c in docs.columns]
    nameless = docs.where("doc_id is null").groupBy(*columns).agg(F.count(F.lit(1)).alias("_of"))
    numbered = nameless.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_of")).alias("_nth"))
    content = F.xxhash64(*(x for c in columns for x in (c.isNull(), c)))
    return named.unionByName(numbered.withColumn("_key", F.concat_ws(":", F.lit("~"), content, "_nth")).drop("_nth"))


def replicated(docs: DataFrame, mix: Mixture) -> DataFrame:
    """``mixed`` with the ``_key`` of each row."""
    # Names that the rows' own columns may have.
    listed = small_side(rates(docs, mix).withColumnsRenamed({"rate": "_rate", "parts": "_parts", "cdf": "_cdf"}))
    joined = keyed(docs).withColumn("_u", uniform(mix.seed, F.col("_key"))).join(
        listed, F.col("source").eqNullSafe(F.col("_source"))
    )
    # Independent Poisson counts add up to one of the summed rate; the first part draws as a whole rate does.
    first = F.size(F.filter("_cdf", lambda c: c <= F.col("_u")))
    others = F.transform(F.sequence(F.lit(2), F.col("_parts")), lambda k: uniform(mix.seed, F.col("_key"), k))
    more = F.aggregate(others, F.lit(0), lambda n, u: n + F.size(F.filter("_cdf", lambda c: c <= u)))
    times = first + F.when(F.col("_parts") > 1, more).otherwise(F.lit(0))
    return (
        joined.withColumn("_n", times)
        .where("_n > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .drop("_u", "_source", "_rate", "_parts", "_cdf", "_n")
    )


def mixed(docs: DataFrame, mix: Mixture = Mixture()) -> DataFrame:
    """Each row as often as its Poisson count says, with ``copy`` from 1, unordered.

    The count is the inverse distribution function at a hash of seed and doc_id,
    so the result does not depend on partitioning.  Repeated doc_ids draw
    alike; each row with a null id draws for itself; a rate of 0 drops a source. A column ``copy`` of the rows gives way.
    """
    return replicated(docs, mix).drop("_key")


def shuffled(docs: DataFrame, seed: int, *keys: str) -> DataFrame:
    """All rows dealt to partitions by a seeded hash and sorted by it within each:
    a uniform order over the whole table, the same on every run."""
    spin = F.xxhash64(F.lit(seed), *(F.col(k) for k in keys))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        docs.withColumn("_spin", spin).repartition(n, "_spin").sortWithinPartitions("_spin", *keys).drop("_spin")
    )


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """Replicate to the target weights and shuffle globally; adds ``copy``."""
    # Null in all rows that have an id, where it leaves the hash as it is.
    own = F.when(F.col("doc_id").isNull(), F.col("_key"))
    rows = replicated(docs, mixture).withColumn("_key", own)
    return shuffled(rows, mixture.seed, "doc_id", "copy", "_key").drop("_key")
