"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

The regression is trained with follow-the-regularised-leader and elastic-net penalties, so
most of its weights are exactly zero; a temperature fitted on documents kept aside makes its
scores probabilities.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, stored
from curbline.llm.training import held_out, sampled

BITS = 14
ORDERS = (1, 2, 3)
# Documents that the model is fitted on, over all languages.
SAMPLE = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
# Characters whose n-grams are counted at a time; memory stays bounded for any text.
CHUNK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def n_gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of the letters, words apart. None if there is no letter."""
    # Numbers such as ² and Ⅷ are among what the pattern finds, and no letters.
    if not text or not any(found[0].isalpha() for found in LETTER.finditer(text)):
        return None
    letters = NOT_LETTERS.sub(" ", f" {text} ".lower())
    codes = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(1 << BITS)
    longest = max(ORDERS) - 1
    for at in range(0, len(codes), CHUNK):
        # An n-gram belongs to the chunk in which it begins.
        part = codes[at : at + CHUNK + longest].astype(np.uint64)
        begins = min(CHUNK, len(codes) - at)
        key = np.zeros(len(part), np.uint64)
        for order in range(1, max(ORDERS) + 1):
            key = (key[: len(part) - order + 1] + part[order - 1 :]) * _MIX
            if order in ORDERS:
                place = (key[:begins] >> np.uint64(64 - BITS)).astype(np.int64)
                counts += np.bincount(place, minlength=1 << BITS)
    return counts


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all the texts each n-gram place occurs, and the number of texts."""

    def run(batches):
        total, texts = np.zeros(1 << BITS, np.int64), 0
        for rows in batches:
            for text in rows.column("text").to_pylist():
                if (counts := n_gram_counts(text)) is not None:
                    total += counts > 0
                    texts += 1
        yield batch(
            place=pa.array(np.arange(len(total) + 1), pa.int32()),
            n=pa.array(np.append(total, texts), pa.int64()),
        )

    summed = map_arrow(docs.select("text"), run, "place int, n bigint").groupBy("place")
    found = {r["place"]: r["n"] for r in summed.agg(F.sum("n").alias("n")).collect()}
    return np.array([found.get(i, 0) for i in range(1 << BITS)]), found.get(1 << BITS, 0)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(counts) * idf
    return vector / (np.sqrt(vector @ vector) or 1.0)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x (places + 1), the last for the bias
    temperature: float

    def margins(self, vector: np.ndarray) -> np.ndarray:
        return self.weights[:, :-1] @ vector + self.weights[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = n_gram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.margins(tf_idf(counts, self.idf)) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader, proximal: weights follow from the sums of gradients."""

    def __init__(self, classes: int, size: int):
        self.z = np.zeros((classes, size))
        self.n = np.zeros((classes, size))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        lasso = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -lasso / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(w @ values)
        p[label] -= 1
        g = p[:, None] * values
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[:, at] = n + g * g


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: list[str], idf: np.ndarray):
    """``rows``: label, places and counts. Every tenth row sets the temperature instead."""
    size = 1 << BITS
    random = np.random.default_rng(11)
    aside = [r for i, r in enumerate(rows) if i % 10 == 9]
    learned = [r for i, r in enumerate(rows) if i % 10 != 9]
    leader = Leader(len(languages), size + 1)

    def vector(places, counts):
        values = np.log1p(counts) * idf[places]
        return values / (np.sqrt(values @ values) or 1.0)

    for _ in range(EPOCHS):
        for i in random.permutation(len(learned)):
            label, places, counts = learned[i]
            values = np.append(vector(places, counts), 1.0)
            leader.learn(np.append(places, size), values, label)
    weights = leader.weights()
    margins = np.array(
        [weights[:, p] @ vector(p, c) + weights[:, -1] for _, p, c in aside]
    ).reshape(len(aside), len(languages))
    truth = np.array([r[0] for r in aside], int)
    return Model(languages, idf, weights, temperature(margins, truth))


def temperature(margins: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of the least log loss, by golden-section search over its logarithm."""
    if not len(truth):
        return 1.0

    # As sure as so many documents allow: one more might be wrong.
    unsure = 1 / (len(truth) + 2)

    def loss(log_t: float) -> float:
        p = np.maximum(softmax(margins / np.exp(log_t)), 1e-12)
        own = np.log(p[np.arange(len(truth)), truth])
        return -float(((1 - unsure) * own + unsure * np.log(p).mean(1)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, most: int = SAMPLE) -> Model:
    """Learn from documents with a language that are not held out: document frequencies from all
    of them, weights from a sample of about ``most``, split evenly over the languages."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = known.select(
        F.col("doc_id").cast("bigint"), F.col("lang").cast("string").alias("lang"), "text"
    )
    frequencies, texts = document_frequencies(known)
    idf = np.log((1 + texts) / (1 + frequencies)) + 1
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    rows = sampled(known, "lang", max(1, most // max(1, len(languages))), seed=4)
    place_of = {name: i for i, name in enumerate(languages)}

    def run(batches):
        for part in batches:
            columns = [part.column(c).to_pylist() for c in ("doc_id", "lang", "text")]
            kept = []
            for doc_id, lang, text in zip(*columns, strict=True):
                if (counts := n_gram_counts(text)) is not None:
                    places = np.flatnonzero(counts)
                    data = places.astype(np.int32).tobytes(), counts[places].tobytes()
                    kept.append((doc_id, place_of[lang], *data))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, t)
                        for c, t in zip(
                            zip(*kept, strict=True),
                            (pa.int64(), pa.int32(), pa.binary(), pa.binary()),
                            strict=True,
                        )
                    ],
                    ["doc_id", "label", "places", "counts"],
                )

    schema = "doc_id bigint, label int, places binary, counts binary"
    found = stored(map_arrow(rows, run, schema), "language-sample").collect()
    # A fixed random order that does not depend on how the rows came in.
    found.sort(key=lambda r: (hash((r["doc_id"], 17)), bytes(r["places"]), bytes(r["counts"])))
    examples = [
        (r["label"], np.frombuffer(r["places"], np.int32), np.frombuffer(r["counts"], np.float64))
        for r in found
    ]
    return fit(examples, languages, idf)


def predicted(docs: DataFrame, model: Model) -> Column:
    """lang_pred and score as a struct over ``text``, for filters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    @F.pandas_udf("lang_pred string, score double")
    def prediction(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return prediction(F.col("text"))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every whole text. Texts without a letter, null and empty
    ones among them, are "und" with score 0, as is everything if nothing could be learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        own = shared.value
        for rows in batches:
            found = [own.predict(t) for t in rows.column("text").to_pylist()]
            yield batch(
                doc_id=rows.column("doc_id"),
                lang_pred=pa.array([f[0] for f in found], pa.string()),
                score=pa.array([f[1] for f in found], pa.float64()),
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("bigint"), "text"),
        run,
        "doc_id bigint, lang_pred string, score double",
    )
