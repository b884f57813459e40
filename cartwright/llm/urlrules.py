"""URL filter: rules on host suffixes and path prefixes, found through short hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hex digits of the digest that the join uses: 32 bits.
SHORT = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expression(host: Column, path: Column) -> Column:
    """Host and path as one text; a host has no line feed after a rule's host check."""
    return F.concat_ws("\n", host, path)


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digests.

    Rules with a null or empty host or a null path are left out.  Of rules with
    the same host and path one remains: ``allow`` before ``block``.
    """
    once = (
        rules.select(
            F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
        )
        .where("rule_host <> '' and rule_path is not null and verdict is not null")
        .groupBy("rule_host", "rule_path")
        .agg(F.min("verdict").alias("verdict"))
    )
    digest = F.sha2(expression(F.col("rule_host"), F.col("rule_path")), 256)
    return once.withColumn("rule_digest", digest).withColumn("rule_short", F.substring(digest, 1, SHORT))


def verdicts(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per distinct url: ``_url, host, path, rule, verdict``.

    Each url is expanded into host suffixes and path prefixes, but only of the
    label counts and lengths that occur among the rules, so that a url with
    thousands of labels or a very long path stays cheap.  The expressions meet
    the rules in an equi-join on the first 32 bits of their SHA-256; a match
    counts when the whole digest agrees.  The longest host and path together
    win, then the longer host; without a rule the verdict is ``default``.  A
    null url has an empty host and path.
    """
    listed = prepared(rules)
    shapes = listed.agg(
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    labels, lengths = sorted(shapes["labels"]), sorted(shapes["lengths"])

    urls = pages.select(F.col(url).alias("_url")).distinct()
    parts = urls.select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    if not labels:
        return parts.select("_url", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    own = F.size(F.split("host", r"\."))
    suffixes = F.array_compact(
        F.array(*(F.when(own >= n, F.substring_index("host", ".", -n)) for n in labels))
    )
    prefixes = F.array_compact(
        F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths))
    )
    expanded = (
        parts.select("_url", F.explode(suffixes).alias("h"), prefixes.alias("paths"))
        .select("_url", "h", F.explode("paths").alias("p"))
        .withColumn("digest", F.sha2(expression(F.col("h"), F.col("p")), 256))
    )
    found = expanded.join(listed, F.substring("digest", 1, SHORT) == F.col("rule_short")).where(
        "digest = rule_digest"
    )
    best = found.groupBy(F.col("_url").alias("_found")).agg(
        F.max(
            F.struct(
                (F.length("rule_host") + F.length("rule_path")).alias("size"),
                F.length("rule_host").alias("host_size"),
                F.concat("rule_host", "rule_path").alias("rule"),
                "verdict",
            )
        ).alias("best")
    )
    return parts.join(best, F.col("_url") == F.col("_found"), "left").select(
        "_url", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` for each row; repeated rows and null urls stay.

    Only distinct urls are expanded; the verdicts return by a join on the url.
    """
    judged = verdicts(pages, rules, url, default)
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_row_url"))
    return rows.join(judged, F.col("_row_url").eqNullSafe(F.col("_url"))).select(
        F.col("_key").alias(key), "host", "path", "rule", "verdict"
    )
