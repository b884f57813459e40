"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns a
DataFrame; all but the last keep the columns of ``documents``. ``run`` writes what a
stage returns as Parquet into the shared folder and reads it again for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import jaccard, langid, mixing, packing, repeats
from cartwright.llm.batches import in_small_batches
from cartwright.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A prediction with a smaller posterior is no decision.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those without a letter, and those no language is likely for, be it that two are
    equally likely or that the n-grams are less like the best language's labelled rows than like random ones or
    are more likely under a uniform model. Without any label no language is known, and all documents go."""
    in_small_batches(spark)
    found = langid.identify(docs, langid.learned_from(docs))
    sure = (F.col("_lang.lang_pred") != langid.UNDETERMINED) & (F.col("_lang.score") >= LEAST_SCORE)
    return found.where(sure & (F.col("_lang.margin") >= 0)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays, one with a null
    id only if none has an id; of repeated rows one. Groups follow from the links alone, not from ids. Documents
    without words link with nothing and stay."""
    found = jaccard.labelled(docs.select("doc_id", "text"))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("one")
    grouped = found.where("n_shingles > 0").groupBy("label").agg(one).select("one.doc_id", "one.row")
    stay = grouped.unionByName(found.where("n_shingles = 0").select("doc_id", "row").distinct())
    stay = stay.withColumnsRenamed({"doc_id": "_id", "row": "_of"})
    rows = docs.withColumn("_row", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = rows.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_of")))
    return kept.dropDuplicates(["_id", "_of"]).select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every string of 200 bytes that repeats goes; documents stay, if only as empty text."""
    cut = repeats.remove_repeats(docs.select(*COLUMNS), keep="string")
    text = F.col("_kept")
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh as the square root of their size; rows are repeated or left out accordingly and shuffled."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("target_weights", target_weights),
    ("packed", packed),
]

#: Suffix arrays and tokens are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
