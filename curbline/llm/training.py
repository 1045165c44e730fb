"""Bounded samples of labelled documents to fit models on, and numbers for their features."""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import fold, stored

FOLDS = 5
_UNIT = 1 << 30
# Bytes of all texts that a model is fitted on, about.
SAMPLE_BYTES = 24 << 20


def held_out(key: str = "doc_id") -> Column:
    """The fold that no model learns from. Rows without an id are never learned from either."""
    return fold(FOLDS, key) == 0


def sampled(rows: DataFrame, label: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows for each value of the label at most, chosen by a hash of doc_id.

    ``rows`` has doc_id and the label only. All rows are counted; a class under the bound
    is taken whole.
    """
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    rates = [F.lit(_UNIT)]
    for value, n in counts.items():
        rates.append(F.when(F.col(label) == value, int(min(1.0, most / n) * _UNIT)))
    # Every value has a rate, so the whole of _UNIT is never used.
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(_UNIT))
    return rows.where(chance < F.coalesce(*rates[1:], rates[0]))


def labelled_ids(labels: DataFrame, label: str, most: int, seed: int = 1) -> DataFrame:
    """doc_id and label, stored, of about ``most`` rows of each class that may be learned from."""
    known = labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return stored(sampled(known, "label", most, seed), f"sample-{label}")


def thinned(rows: DataFrame, most_bytes: int = SAMPLE_BYTES, seed: int = 2) -> DataFrame:
    """``rows`` with doc_id and text, or where the texts are larger than ``most_bytes`` together, as
    large a part of them as is expected to fit, chosen by a hash of doc_id. Texts stay whole."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= most_bytes:
        return rows
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(_UNIT))
    return rows.where(chance < int(most_bytes / size * _UNIT))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: int = 1):
    """doc_id, text and label of a sample of the labelled documents that may be learned from,
    bounded in rows and in bytes. The chosen ids are stored, so that Spark knows their size when it
    joins them."""
    chosen = labelled_ids(labels, label, most, seed)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").where("text IS NOT NULL")
    return thinned(texts.join(chosen, "doc_id"))


def hashed(names, bits: int) -> np.ndarray:
    """Places of the names in a table of 2**bits, by CRC-32."""
    mask = (1 << bits) - 1
    return np.fromiter([crc32(w.encode("utf-8", "replace")) & mask for w in names], np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def logit(p: float) -> float:
    p = min(max(p, 1e-9), 1 - 1e-9)
    return math.log(p / (1 - p))
