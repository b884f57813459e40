"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")

#: Fixed odd factors of the n-gram hash, one per place of a character.
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


@dataclass(frozen=True)
class NgramSettings:
    """``orders``: lengths of the n-grams; ``bits``: log2 of the hashed features;
    ``alpha``: added to each count; ``most_languages``: a table with more labels
    is refused, which bounds the broadcast matrix."""

    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 15
    alpha: float = 0.5
    most_languages: int = 200


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_probability: np.ndarray  # features x languages
    settings: NgramSettings


def _features(texts: list[str], s: NgramSettings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For about 250,000 characters at a time: feature ids, one row per order,
    and an array of the starts and ends of each text."""
    pad = "\0" * (max(s.orders) - 1) or "\0"
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size < 250_000):
            size += len(texts[last])
            last += 1
        group = texts[first:last]
        code = np.frombuffer((pad.join(group) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(t) for t in group], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes + len(pad))[:-1]))
        bounds = np.stack((starts, starts + sizes), axis=1).ravel()
        n = len(code) - len(pad)
        ids = np.empty((len(s.orders), n), np.int64)
        for row, order in enumerate(s.orders):
            value = np.full(n, order * 0x2545F491 & 0xFFFFFFFF, np.uint32)
            for place in range(order):
                value ^= code[place : place + n] * np.uint32(FACTORS[place])
                value = (value << np.uint32(13)) | (value >> np.uint32(19))
            value *= np.uint32(FACTORS[-1])
            ids[row] = value >> np.uint32(32 - s.bits)
        yield ids, bounds
        first = last


def _inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """1 inside a text, 0 on the padding between two."""
    step = np.zeros(n + 1, np.int8)
    full = bounds[::2] < bounds[1::2]
    step[bounds[::2][full]] = 1
    ends = bounds[1::2][full]
    step[ends[ends <= n]] -= 1
    return np.cumsum(step[:n], dtype=np.int8).astype(bool)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", settings: NgramSettings = NgramSettings()) -> Model:
    """Count the n-grams of every labelled row and turn them into log-probabilities.

    Rows with a null text or label teach nothing.  Each task counts in arrays and
    emits one row per language and feature seen; a sum with map-side combine
    brings back at most languages x 2 ** bits numbers.
    """
    size = 1 << settings.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for value, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(label, []).append(value.lower())
            for label, texts in by.items():
                total = counts.setdefault(label, np.zeros(size, np.int64))
                for ids, bounds in _features(texts, settings):
                    keep = _inside(bounds, ids.shape[1])
                    for row in ids:
                        total += np.bincount(row[keep], minlength=size)
        for label, total in counts.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(total[seen])],
                names=["lang", "feature", "n"],
            )

    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    summed = (
        rows.mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    )
    table = summed.limit(settings.most_languages * size + 1).toPandas()
    languages = sorted(table["lang"].unique())
    if len(languages) > settings.most_languages or len(table) > settings.most_languages * size:
        raise ValueError(f"more than {settings.most_languages} languages")
    counts = np.zeros((size, len(languages)))
    place = {name: k for k, name in enumerate(languages)}
    counts[table["feature"].to_numpy(), table["lang"].map(place).to_numpy(dtype=int) if len(table) else []] = table["n"]
    smooth = counts + settings.alpha
    return Model(languages, np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32), settings)


def least_means(model: Model) -> np.ndarray:
    """For each language, half way between the mean log-probability of an n-gram of its labelled rows (smoothed
    as the model is) and that of a feature drawn at random, which any other text comes near to or goes below; but
    at least that of a uniform model, which explains a text better that is below it."""
    value = model.log_probability.astype(np.float64)
    return np.maximum(((np.exp(value) * value).sum(axis=0) + value.mean(axis=0)) / 2, -np.log(len(value)))


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The most probable language of each text, its posterior under equal priors, and by how much the text's
    mean log-probability per n-gram is above the least of that language; the latter does not grow with the length.

    ``und`` with score and margin 0 for null, for text without a letter, and when no
    language was learned.  Equal posteriors go to the first name.
    """
    names = np.full(len(texts), UNDETERMINED, object)
    score, margin = np.zeros(len(texts)), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    if not model.languages or not known:
        return list(names), score, margin
    done, least = 0, least_means(model)
    for ids, bounds in _features([texts[k].lower() for k in known], model.settings):
        n = len(bounds) // 2
        total = np.zeros((n, len(model.languages)))
        for row in ids:
            part = model.log_probability[np.append(row, 0)]
            total += np.add.reduceat(part, bounds, axis=0, dtype=np.float64)[::2]
        best = total.argmax(axis=1)
        chance = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        where = known[done : done + n]
        names[where] = np.array(model.languages, object)[best]
        score[where] = chance.round(6)
        margin[where] = total[np.arange(n), best] / (len(ids) * (bounds[1::2] - bounds[::2])) - least[best]
        done += n
    return list(names), score, margin


def predictor(df: DataFrame, model: Model):
    """A vectorised function of a text column: struct of ``lang_pred``, ``score`` and ``margin``.

    The broadcast matrix has at most most_languages x 2 ** bits numbers."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, margin double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = [t if isinstance(t, str) else None for t in texts]
            names, score, margin = score_texts(values, shared.value)
            yield pd.DataFrame({"lang_pred": names, "score": score, "margin": margin})

    return predict


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_from(docs: DataFrame, settings: NgramSettings = NgramSettings()) -> Model:
    """A model of the rows outside the held-out fold; rows with a null id teach nothing."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), settings=settings)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with a struct column ``_lang`` of the prediction."""
    return docs.withColumn("_lang", predictor(docs, model)(F.col("text")))
