"""A quality classifier: a factorisation machine over hashed words and structure statistics.

Score: sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j). The pairs cost linear
time by the sum-of-squares identity: half of (sum v_i x_i)^2 - sum (v_i x_i)^2, by factor.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, words
from curbline.llm.training import hashed, held_out, labelled_texts, sigmoid

BITS = 15
FACTORS = 8
BINS = 8
# Labelled documents of each class that the model is fitted on.
SAMPLE = 4000
EPOCHS = 6
# Score from which a document counts as good.
KEPT_FROM = 0.3
SYMBOLS = re.compile(r"[#*$%&|<>]")
STATISTICS = [
    "words",
    "characters",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "punctuation",
    "spaces",
    "distinct_words",
    "most_common_word",
    "repeats_in_a_row",
    "duplicate_lines",
    "words_a_line",
    "words_without_letters",
    "short_words",
    "distinct_pairs",
    "longest_word",
    "ends_with_mark",
]


def statistics(text: str, own: list[str]) -> list[float]:
    """What STATISTICS names, of one text with its words: sizes in logarithms, else shares."""
    n, size = max(1, len(own)), max(1, len(text))
    letters = sum(map(len, own)) or 1
    counts: dict[str, int] = {}
    for w in own:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(len(own)),
        np.log1p(len(text)),
        letters / n,
        sum(map(str.isupper, own)) / n,
        sum(map(text.count, "0123456789")) / size,
        len(SYMBOLS.findall(text)) / size,
        sum(map(text.count, ".,;:!?")) / n,
        (size - letters) / size,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, own, own[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        sum(w.isalpha() for w in counts) / max(1, len(counts)),
        sum(len(w) < 4 for w in own) / n,
        len(set(zip(own, own[1:], strict=False))) / n,
        np.log1p(max(map(len, counts), default=0)),
        float(text.rstrip()[-1:] in ".!?"),
    ]


@dataclass(frozen=True)
class Machine:
    """The fitted model. Places 0 to 2**BITS - 1 are words, then BINS for each statistic."""

    cuts: np.ndarray  # statistics x (BINS - 1)
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def features(self, text: str | None):
        """Places and values of one text. All its distinct words together have length 1."""
        own = words(text)
        stats = np.asarray(statistics(text or "", own))
        bins = (stats[:, None] > self.cuts).sum(1) + np.arange(len(stats)) * BINS + (1 << BITS)
        places = hashed({w.lower() for w in own}, BITS)
        values = np.full(len(places), 1 / np.sqrt(max(1, len(places))))
        values = np.concatenate([values, np.full(len(bins), 1 / np.sqrt(len(bins)))])
        return np.concatenate([places, bins]), values

    def score(self, text: str | None) -> float:
        places, values = self.features(text)
        return float(sigmoid(self.margin(places, values)[0]))

    def margin(self, places, values):
        each = self.factors[places] * values[:, None]
        total = each.sum(0)
        pairs = 0.5 * (total @ total - (each * each).sum())
        return self.bias + self.linear[places] @ values + pairs, each, total


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Machine:
    """Adagrad on the log loss, with ridge penalties, in a fixed random order."""
    random = np.random.default_rng(seed)
    size = (1 << BITS) + BINS * len(STATISTICS)
    stats = [statistics(t or "", words(t)) for t in texts] or [[0.0] * len(STATISTICS)]
    cuts = np.quantile(np.asarray(stats), np.arange(1, BINS) / BINS, axis=0).T
    share = (sum(labels) + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    model = Machine(cuts, bias, np.zeros(size), random.normal(0, 0.02, (size, FACTORS)))
    rows = [model.features(t) for t in texts]
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for epoch in range(EPOCHS):
        step = 0.15 / (1 + 0.3 * epoch)
        for i in random.permutation(len(rows)):
            places, values = rows[i]
            margin, each, total = Machine(cuts, bias, model.linear, model.factors).margin(
                places, values
            )
            error = float(sigmoid(margin)) - labels[i]
            gain = error * values + 1e-4 * model.linear[places]
            grow = error * values[:, None] * (total - each) + 1e-3 * model.factors[places]
            np.add.at(seen_w, places, gain * gain)
            np.add.at(seen_v, places, grow * grow)
            seen_b += error * error
            np.subtract.at(model.linear, places, step * gain / np.sqrt(seen_w[places]))
            np.subtract.at(model.factors, places, step * grow / np.sqrt(seen_v[places]))
            bias -= step * error / np.sqrt(seen_b)
    return Machine(cuts, float(bias), model.linear, model.factors)


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Machine:
    """Fit on about ``most`` labelled documents of each class, none of them held out. A class
    that is cut to the bound is rarer in the sample than it should be; the bias makes up for
    it, so that scores are probabilities."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out())
    n = known.agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    rows = labelled_texts(docs, labels, "quality", most).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    model = fit([r["text"] for r in rows], [r["label"] for r in rows])
    taken = [sum(r["label"] == k for r in rows) for k in (1, 0)]
    if all(n) and all(taken):
        shift = np.log(n[0] / n[1]) - np.log(taken[0] / taken[1])
        model = Machine(model.cuts, model.bias + float(shift), model.linear, model.factors)
    return model


def scored(docs: DataFrame, model: Machine) -> Column:
    """The score as a column over ``text``, for filters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    @F.pandas_udf("double")
    def score_of(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return score_of(F.col("text"))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id and score of every whole text. Null and empty texts are texts without words;
    repeated rows are scored alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        own = shared.value
        for rows in batches:
            found = [own.score(t) for t in rows.column("text").to_pylist()]
            yield batch(doc_id=rows.column("doc_id"), score=pa.array(found, pa.float64()))

    return map_arrow(
        docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, score double"
    )
