"""Document fingerprints: one-permutation MinHash, densified and packed, in column functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sketch:
    """``words`` per shingle; 2 ** ``bin_bits`` bins; ``low_bits`` kept of each bin's minimum."""

    words: int = 5
    bin_bits: int = 7
    low_bits: int = 8

    @property
    def bins(self) -> int:
        return 1 << self.bin_bits


def word_hashes(text: Column) -> Column:
    """Hashes of the words between white space (U+0020, U+0009 to U+000D), lower-cased."""
    words = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, words: int) -> Column:
    """63-bit hashes of all runs of ``words`` words, sorted; a shorter text is one shingle, no words are none."""
    n = F.size(hashes)
    runs = F.arrays_zip(*(F.slice(hashes, k + 1, F.greatest(n - words + 1, F.lit(0))) for k in range(words)))
    positive = lambda value: F.shiftrightunsigned(value, 1)
    return (
        F.when(n >= words, F.sort_array(F.transform(runs, lambda run: positive(F.xxhash64(run)))))
        .when(n > 0, F.array(positive(F.xxhash64(hashes))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def bin_of(value: Column, s: Sketch) -> Column:
    return F.shiftright(value, 63 - s.bin_bits)


def bin_minima(ordered: Column, s: Sketch) -> Column:
    """Of sorted hashes, the first in each bin that has any; the bin is the hash's top bits."""
    return F.filter(
        ordered, lambda x, i: (i == 0) | (bin_of(x, s) != bin_of(F.get(ordered, i - 1), s))
    )


def densified(minima: Column, full: Column, s: Sketch) -> Column:
    """The low bits of each bin's minimum; an empty bin borrows from a full one.

    ``full`` has the numbers of the bins of ``minima``.  Bin i tries the bins in an order of its own, drawn
    by a hash of both numbers, until it meets a full one: optimal densification.  The first full bin
    in that order is the one with the smallest hash.  A text without words has no bins at all.
    """
    place, width = s.bins - 1, s.low_bits
    low_of = lambda x: x.bitwiseAND((1 << width) - 1)
    numbered = lambda i, x: F.shiftleft(i, width).bitwiseOR(low_of(x))
    turns = lambda i: F.transform(full, lambda j: F.xxhash64(i, j).bitwiseAND(~place).bitwiseOR(j))
    lender = lambda i: F.array_position(full, F.array_min(turns(i)).bitwiseAND(place))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(place).cast("bigint"))
    own = F.transform(minima, lambda x: numbered(bin_of(x, s), x))
    lent = F.transform(F.array_except(every, full), lambda i: numbered(i, F.get(minima, (lender(i) - 1).cast("int"))))
    low = F.transform(F.sort_array(F.concat(own, lent)), lambda x: low_of(x).cast("int"))
    return F.when(F.size(minima) > 0, low).otherwise(F.array().cast("array<int>"))


def packed(low: Column, s: Sketch) -> Column:
    """The low bits of all bins as one hex text."""
    digits = s.low_bits // 4
    return F.array_join(F.transform(low, lambda x: F.lpad(F.lower(F.hex(x)), digits, "0")), "")


def likeness(a: Column, b: Column, s: Sketch) -> Column:
    """Estimated Jaccard index from two arrays of low bits, from 0 to 1.

    Different minima agree in their low bits by chance, 1 in 2 ** low_bits; the share of equal bins is
    corrected for that.  Two texts without words are alike (1); one without words is like no other (0).
    """
    same = F.size(F.array_remove(F.zip_with(a, b, lambda x, y: x == y), False)) / F.lit(s.bins)
    chance = 1 / (1 << s.low_bits)
    estimate = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(estimate)
    )


def with_low_bits(df: DataFrame, texts: dict[str, str], s: Sketch) -> DataFrame:
    """Add the array of low bits of each text column, under the given names.

    Step by step, so that each array is computed once and not again for each of its elements.
    """
    df = df.withColumns({f"_w_{name}": word_hashes(F.col(text)) for text, name in texts.items()})
    for step in (lambda c: shingle_hashes(c, s.words), lambda c: bin_minima(c, s)):
        df = df.withColumns({f"_w_{name}": step(F.col(f"_w_{name}")) for name in texts.values()})
    bins = {f"_b_{name}": F.transform(f"_w_{name}", lambda x: bin_of(x, s)) for name in texts.values()}
    low = {name: densified(F.col(f"_w_{name}"), F.col(f"_b_{name}"), s) for name in texts.values()}
    return df.withColumns(bins).withColumns(low).drop(*bins, *(f"_w_{name}" for name in texts.values()))


def fingerprints(docs: DataFrame, s: Sketch = Sketch()) -> DataFrame:
    """``doc_id, fingerprint`` of each row; null text counts as empty."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    return with_low_bits(rows, {"_text": "_low"}, s).select("doc_id", packed(F.col("_low"), s).alias("fingerprint"))


#: Ranges of ids: about so many rows each, and at most so many ranges, which bounds what the driver gets.
RANGE_ROWS, MOST_RANGES, COARSE = 1000, 65_536, 64


def id_ranges(rows: DataFrame) -> DataFrame:
    """Add ``_range``: ranges of ``_key`` in ascending order, of about equal size.

    Approximate quantiles give coarse ranges, which are cut evenly by value.
    """
    marks = [k / COARSE for k in range(COARSE + 1)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_key", marks, 10_000).alias("at")).first()
    at = sorted(set(found["at"] or [0]))
    fine = max(1, min(MOST_RANGES, -(-found["n"] // RANGE_ROWS)) // COARSE)
    listed = F.array(*(F.lit(x).cast("long") for x in at))
    coarse = F.least(F.size(F.filter(listed, lambda x: x <= F.col("_key"))), F.lit(len(at) - 1))
    rows = rows.withColumn("_coarse", F.greatest(coarse, F.lit(1)))
    low = F.get(listed, F.col("_coarse") - 1).cast("double")
    high = F.get(listed, F.col("_coarse")).cast("double")
    part = F.floor((F.col("_key").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * fine)
    part = F.least(F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)), F.lit(fine - 1))
    return rows.withColumn("_range", (F.col("_coarse") * fine + part).cast("int")).drop("_coarse")


def with_next(docs: DataFrame, fields: list[str]) -> tuple[DataFrame, object]:
    """Deal rows to ranges of ids and let each range also hold the rows that follow its last one.

    Returns the rows with ``_key, _range, _guest`` and the window in which ``lead`` finds the next row in
    descending order of doc_id, after the last the first.  Null ids come last; equal ids in
    order of their text.  Only ids go to the driver, one per range.
    """
    rows = id_ranges(docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))))
    heads = [tuple(r) for r in rows.groupBy("_range").agg(F.max("_key")).orderBy(F.desc("_range")).collect()]
    spark = docs.sparkSession
    # The head of each range is a guest in the range above it; the first of all in the last.
    guests = [(heads[(k + 1) % len(heads)][1], heads[k][0]) for k in range(len(heads))]
    listed = spark.createDataFrame(guests, "_head long, _host int").groupBy("_head").agg(F.collect_list("_host").alias("_hosts"))
    placed = rows.join(F.broadcast(listed), F.col("_key") == F.col("_head"), "left")
    own = F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("g")))
    more = F.transform("_hosts", lambda r: F.struct(r.alias("r"), F.lit(True).alias("g")))
    dealt = placed.withColumn("_at", F.explode(F.concat(own, F.coalesce(more, F.array().cast("array<struct<r:int,g:boolean>>")))))
    dealt = dealt.select(*fields, "_key", F.col("_at.r").alias("_range"), F.col("_at.g").alias("_guest"))
    return dealt, Window.partitionBy("_range").orderBy("_guest", F.desc("_key"), *fields)


def edited_pairs(docs: DataFrame, s: Sketch = Sketch()) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and their likenesses.

    The edited text has the last floor(n / 2) of n characters replaced by the first as many, or all,
    of the next row's text in descending order of doc_id (after the last: the first).  A single row is
    its own next.  Null texts count as empty, repeated rows stay, an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    dealt, order = with_next(rows, ["doc_id", "_text"])
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    pairs = dealt.withColumns({"_next": F.lead("_text").over(order), "_place": F.row_number().over(order)}).withColumn(
        "_edited",
        F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)),
    )
    sketched = with_low_bits(pairs, {"_text": "_low", "_edited": "_edited_low"}, s).select(
        "doc_id", "_key", "_range", "_guest", "_low", "_edited_low",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        "_place",
    )
    again = Window.partitionBy("_range").orderBy("_place")
    return (
        sketched.withColumn("_next_low", F.lead("_low").over(again))
        .where(~F.col("_guest"))
        .select(
            "doc_id", "n_chars", "edited_sha256",
            packed(F.col("_low"), s).alias("fingerprint"),
            packed(F.col("_edited_low"), s).alias("edited_fingerprint"),
            likeness(F.col("_low"), F.col("_edited_low"), s).alias("near_edited"),
            likeness(F.col("_low"), F.col("_next_low"), s).alias("near_next"),
        )
    )
