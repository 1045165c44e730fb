"""Toxicity by weak supervision.

Voters are lexicons (word stems that toxic texts of the labelled sample have and others lack)
and patterns. A generative label model, fitted by expectation-maximisation, estimates how often
each voter fires on toxic and on other texts, and which voters depend on each other: a voter's
parameters are conditional on the one that it depends on most, in a tree of such pairs. Its
posteriors, of labelled and unlabelled texts, are the labels that a sparse linear classifier over
words and word beginnings is trained on. Labels don't vote. They serve to find lexicons and to judge
voters, and where a text has one its posterior takes it as found by somebody who sometimes errs.

Tasks turn a text into hashed words and beginnings with their numbers, and the votes of patterns.
The driver holds those of a sample that is bounded in rows and in bytes.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, words
from curbline.llm.training import held_out, labelled_ids, logit, sigmoid, thinned

BITS = 20
# Labelled documents of each class, and documents without regard to labels, that models see.
SAMPLE, UNLABELLED = 4000, 4000
STEMS = 64
# Stems whose names are looked up, the best of them first.
CANDIDATES = 2000
# Lengths of word beginnings that serve as stems.
BEGINNINGS = (3, 4, 5, 6, 7)
# What a stem can be asked for: so many distinct words, and such a share of all of them.
LIMITS = ((1, 0.0), (2, 0.004), (2, 0.01), (3, 0.01), (3, 0.02))
LEAST_TEXTS, LEAST_ODDS = 5, 10
ROUNDS = 25
# Length of all the words of a text together, beside a voter's 1.
WORDS_LENGTH = 3.0
# Conditional mutual information, in nats, from which two voters depend on each other.
DEPENDENT = 0.002
# One label in so many is wrong.
ERRS = 50
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.6, 1.0, 1.0, 0.1
RUN = re.compile(r"[^\W\d_]+")
PATTERNS = [
    re.compile(r"[^\W\d_]{3,}!{2,}"),  # a word shouted at
    re.compile(r"\b(you|tu|vous|du|ihr|eres)\b[^.!?\n]{0,20}\b(are|es|bist|seid|êtes)\b", re.I),
    re.compile(r"([!?])\1{2,}"),
    re.compile(r"\b[A-Z]{4,}(?:\s+[A-Z]{4,}){3,}"),
    re.compile(r"[^\W\d_][*@#$%]{2,}[^\W\d_]"),  # letters struck out
    re.compile(r"\b(such|so|quel|was für|qué)\b[^.!?\n]{0,30}!", re.I),
    re.compile(r"([^\W\d_])\1{3,}"),  # letters drawn out
    re.compile(r"\b(shut up|go away|get lost|ta gueule|halt|cállate)\b", re.I),
]


def plain_words(token: str) -> tuple[str, ...]:
    return tuple(RUN.findall(token.lower()))


def vocabulary_of(text: str | None) -> set[str]:
    """The distinct words of a text: lower-case runs of letters."""
    return {w for token in set(words(text)) for w in plain_words(token)}


# ---------------------------------------------------------------------------
# What the tasks send
# ---------------------------------------------------------------------------


def names_of(word: str) -> tuple[str, ...]:
    """A word's stems: its beginnings, and the whole word."""
    return (*(word[:k] for k in BEGINNINGS if len(word) > k), f"{word} ")


def place_of(name: str) -> int:
    return crc32(name.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def stems_of(text: str | None) -> tuple[Counter, int]:
    """How many distinct words of the text have each stem, and how many there are."""
    own = vocabulary_of(text)
    return Counter(name for w in own for name in names_of(w)), len(own)


@dataclass(frozen=True)
class Sample:
    """Hashed stems of several texts one after the other. ``text`` is the place of each stem's text;
    ``size`` the distinct words of each text, ``patterns`` the votes of PATTERNS, and ``label`` 1, 0,
    or -1 where it is not known or not to be used."""

    text: np.ndarray
    place: np.ndarray
    count: np.ndarray
    size: np.ndarray
    patterns: np.ndarray
    label: np.ndarray

    @staticmethod
    def of(rows: list) -> Sample:
        """Of rows with places, counts, size, patterns and label."""
        places = [np.frombuffer(r["places"], "<i4") for r in rows]
        counts = [np.frombuffer(r["counts"], "<i4") for r in rows]
        bits = np.array([r["patterns"] for r in rows], np.int64)
        none = np.zeros(0, np.int32)
        return Sample(
            np.repeat(np.arange(len(rows), dtype=np.int32), [len(p) for p in places]),
            np.concatenate([none, *places]),
            np.concatenate([none, *counts]),
            np.array([r["size"] for r in rows], np.int64),
            (bits[:, None] >> np.arange(len(PATTERNS)) & 1).astype(bool),
            np.array([-1 if r["label"] is None else r["label"] for r in rows], np.int64),
        )

    def reaches(self, least: int, share: float) -> np.ndarray:
        """Which stems have a count that a voter with these limits asks for."""
        asked = np.maximum(least, share * self.size).astype(np.float32)
        return self.count >= asked[self.text]


def packed(text: str | None) -> dict:
    stems, size = stems_of(text)
    places: Counter = Counter()
    for name, n in stems.items():
        places[place_of(name)] += n
    return {
        "places": np.fromiter(places.keys(), "<i4", len(places)).tobytes(),
        "counts": np.fromiter(places.values(), "<i4", len(places)).tobytes(),
        "size": size,
        "patterns": sum((p.search(text or "") is not None) << i for i, p in enumerate(PATTERNS)),
    }


def packed_rows(rows: DataFrame) -> DataFrame:
    """doc_id, label, and what ``packed`` makes of the text."""

    def run(batches):
        for part in batches:
            made = [packed(t) for t in part.column("text").to_pylist()]
            yield batch(
                doc_id=part.column("doc_id"),
                label=part.column("label"),
                places=pa.array([m["places"] for m in made], pa.binary()),
                counts=pa.array([m["counts"] for m in made], pa.binary()),
                size=pa.array([m["size"] for m in made], pa.int32()),
                patterns=pa.array([m["patterns"] for m in made], pa.int32()),
            )

    return map_arrow(
        rows.select("doc_id", "label", "text"),
        run,
        "doc_id long, label int, places binary, counts binary, size int, patterns int",
    )


def stem_names(rows: DataFrame, places: set[int]) -> dict[int, str]:
    """The commonest stem of ``rows`` at each of the places."""

    def run(batches):
        for part in batches:
            found: Counter = Counter()
            for text in part.column("text").to_pylist():
                stems, _ = stems_of(text)
                found.update(name for name in stems if place_of(name) in places)
            yield batch(
                place=pa.array([place_of(name) for name in found], pa.int32()),
                name=pa.array(found.keys(), pa.string()),
                n=pa.array(found.values(), pa.int64()),
            )

    counted = map_arrow(rows.select("text"), run, "place int, name string, n long")
    best = counted.groupBy("place", "name").agg(F.sum("n").alias("n"))
    best = best.groupBy("place").agg(F.min(F.struct(-F.col("n"), "name")).alias("best"))
    return {r["place"]: r["best"]["name"] for r in best.collect()}  # CANDIDATES at most


# ---------------------------------------------------------------------------
# Voters
# ---------------------------------------------------------------------------


def candidate_stems(sample: Sample, most: int = CANDIDATES) -> list[tuple]:
    """(worth, place, least count, least share of the distinct words) of the stems that could be
    voters, best first: of each stem's limits the one with the highest log-odds between the
    classes, weighed by the texts that reach it."""
    toxic, other = ((sample.label == k)[sample.text] for k in (1, 0))
    n_toxic, n_other = (max(1, int((sample.label == k).sum())) for k in (1, 0))
    worth = np.zeros((len(LIMITS), 1 << BITS), np.float32)
    for i, limit in enumerate(LIMITS):
        reached = sample.reaches(*limit)
        n = np.bincount(sample.place[reached & toxic], minlength=1 << BITS)
        m = np.bincount(sample.place[reached & other], minlength=1 << BITS)
        odds = (n + 0.5) / n_toxic / ((m + 0.5) / n_other)
        worth[i] = np.where((n >= LEAST_TEXTS) & (odds > LEAST_ODDS), n * np.log(odds), 0)
    limits, best = worth.argmax(0), worth.max(0)
    order = np.argsort(-best, kind="stable")[:most]
    return [(float(best[i]), i, *LIMITS[limits[i]]) for i in order.tolist() if best[i] > 0]


def lexicons(candidates: list[tuple], names: dict[int, str], most: int = STEMS) -> list[tuple]:
    """Voters (stem, least count, least share). One for a family: stems that begin alike are the
    same lexicon."""
    voters: list[tuple] = []
    for _, place, least, share in candidates:
        stem = names.get(place)
        if stem and not any(v[0].startswith(stem) or stem.startswith(v[0]) for v in voters):
            voters.append((stem, least, share))
    return voters[:most]


def lexicon_votes(sample: Sample, voters: list[tuple]) -> np.ndarray:
    """texts x voters: which lexicons fire."""
    fired = np.zeros((len(sample.size), len(voters)), bool)
    for j, (stem, least, share) in enumerate(voters):
        at = (sample.place == place_of(stem)) & sample.reaches(least, share)
        fired[sample.text[at], j] = True
    return fired


def votes(sample: Sample, voters: list[tuple]) -> np.ndarray:
    """The lexicons, then the patterns. Labels don't vote."""
    return np.column_stack([lexicon_votes(sample, voters), sample.patterns])


# ---------------------------------------------------------------------------
# The label model
# ---------------------------------------------------------------------------


@dataclass
class LabelModel:
    """``prior``: of the toxic class. ``parent[j]``: the voter that j depends on, or -1.
    ``fires[y, a, j]``: how often j fires on class y where its parent does (a = 1) or does not; without
    a parent, both are alike. The votes of a text are as likely as the product of these over all
    voters, whether they fire or not."""

    prior: float
    parent: np.ndarray
    fires: np.ndarray

    def posterior(self, fired: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """Given the votes and, where ``known`` has a class, that it was found by somebody who errs
        once in ERRS."""
        above = np.where(self.parent >= 0, fired[:, self.parent], False).astype(int)
        at = above, np.arange(fired.shape[1])
        yes, no = np.log(self.fires[1] / self.fires[0]), np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        found = 0.0 if known is None else np.array([logit(1 / ERRS), -logit(1 / ERRS), 0.0])[known]
        return sigmoid(logit(self.prior) + np.where(fired, yes[at], no[at]).sum(1) + found)


def dependences(fired: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """Mutual information of every two voters, given the class."""
    total = sum(w.sum() for w in weights)
    out = np.zeros((fired.shape[1],) * 2)
    for w in weights:
        both = (fired * w[:, None]).T @ fired
        one = (w @ fired)[:, None] + np.zeros_like(both)
        n = w.sum() + 1e-9
        joint = {(1, 1): both, (1, 0): one - both, (0, 1): one.T - both, (0, 0): n - one - one.T + both}
        for (a, b), count in joint.items():
            own, other = (one if a else n - one), (one.T if b else n - one.T)
            ratio = np.maximum(count, 1e-12) * n / np.maximum(own * other, 1e-12)
            out += np.where(count > 1e-9, count / total * np.log(ratio), 0)
    np.fill_diagonal(out, 0)
    return out


def strongest_tree(information: np.ndarray) -> np.ndarray:
    """Parents in the spanning forest of the strongest dependences, those over DEPENDENT alone."""
    n = len(information)
    parent, reach, by = np.full(n, -1), np.full(n, -1.0), np.full(n, -1)
    left = set(range(n))
    while left:
        j = max(left, key=lambda k: (reach[k], -k))
        left.remove(j)
        parent[j] = by[j] if reach[j] >= DEPENDENT else -1
        closer = information[j] > reach
        reach[closer], by[closer] = information[j][closer], j
    return parent


def label_model(fired: np.ndarray, lexicon_voters: int, known: np.ndarray | None = None) -> LabelModel:
    """Fit to the votes. It starts from "a lexicon fired" and alternates posteriors with the
    likeliest tree of dependences and its parameters.

    ``known`` has the class of some texts, and -1 for the others. Voters are then judged on these as
    well: a lexicon of one language never fires with one of another, and votes alone could not tell
    which of two such groups is toxic. The class of a text isn't among its votes.
    """
    fired = fired.astype(float)
    p = np.where(fired[:, :lexicon_voters].any(1), 0.95, 0.02)
    known = np.full(len(p), -1) if known is None else known
    model = None
    for _ in range(ROUNDS):
        p = np.where(known < 0, p, known)
        weights = [1 - p, p]
        parent = strongest_tree(dependences(fired, weights))
        above = np.where(parent >= 0, fired[:, parent], 0)
        fires = np.zeros((2, 2, fired.shape[1]))
        for y, w in enumerate(weights):
            for a in (0, 1):
                at = w[:, None] * (above == a)
                fires[y, a] = ((at * fired).sum(0) + 0.5) / (at.sum(0) + 1)
            fires[y][:, parent < 0] = fires[y, 0][parent < 0]
        prior = float(np.clip(p.mean(), 1e-3, 1 - 1e-3))
        model = LabelModel(prior, parent, np.clip(fires, 1e-4, 1 - 1e-4))
        p = model.posterior(fired.astype(bool))
    return model


# ---------------------------------------------------------------------------
# The classifier
# ---------------------------------------------------------------------------


class Classifier:
    """Sparse logistic regression on the lexicon voters and on the distinct words of a text with
    their beginnings. The words of a text together have a length that does not depend on
    their number. What is known of a word is remembered per process."""

    def __init__(self, bias: float, voters: list[tuple], of_voter: list[float], of_place: dict):
        self.bias, self.voters, self.of_voter, self.of_place = bias, voters, of_voter, of_place
        self.stems = {s: i for i, s in enumerate(dict.fromkeys(v[0] for v in voters))}
        self.asked = [(self.stems[s], least, share) for s, least, share in voters]
        self.tokens: dict[str, tuple[str, ...]] = {}
        self.known: dict[str, tuple[float, tuple[int, ...]]] = {}

    def _word(self, w: str) -> tuple[float, tuple[int, ...]]:
        names = names_of(w)
        hits = tuple(self.stems[x] for x in names if x in self.stems)
        found = sum(self.of_place.get(place_of(x), 0.0) for x in names), hits
        if len(w) < 64:
            self.known[w] = found
        return found

    def margin(self, text: str | None) -> float:
        tokens, known = self.tokens, self.known
        if len(tokens) > 250_000:
            tokens.clear()
            known.clear()
        own: set[str] = set()
        for token in set(words(text)):
            found = tokens.get(token)
            if found is None:
                found = plain_words(token)
                if len(token) < 64:
                    tokens[token] = found
            own.update(found)
        total, counts = 0.0, [0] * len(self.stems)
        for w in own:
            value, hits = known.get(w) or self._word(w)
            total += value
            for i in hits:
                counts[i] += 1
        lexicon = sum(
            weight
            for weight, (stem, least, share) in zip(self.of_voter, self.asked, strict=True)
            if counts[stem] >= least and counts[stem] >= share * len(own)
        )
        return self.bias + lexicon + total * word_value(len(own))

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.margin(text)))


def word_value(n):
    return WORDS_LENGTH / np.maximum(1, n) ** 0.5


def fit_classifier(sample: Sample, target: np.ndarray, voters: list[tuple], seed: int = 5) -> Classifier:
    """Follow-the-regularised-leader on the posteriors; the lasso drops words of no use. Texts without
    label on which all lexicons abstain teach nothing and are left out."""
    first = 1 << BITS  # voters come after the words, the bias after the voters
    size, random = first + len(voters) + 1, np.random.default_rng(seed)
    z, n = np.zeros(size), np.zeros(size)
    fired, ends = lexicon_votes(sample, voters), np.searchsorted(sample.text, np.arange(len(target) + 1))
    values = sample.count * word_value(sample.size).astype(np.float32)[sample.text]

    def weights(at):
        lasso = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at >= first, 0, L1), 0)
        return -lasso / ((BETA + np.sqrt(n[at])) / ALPHA + np.where(at >= first, 0, L2))

    told = np.flatnonzero((sample.label >= 0) | fired.any(1))
    for _ in range(EPOCHS):
        for i in random.permutation(told):
            own, own_voters = slice(ends[i], ends[i + 1]), np.flatnonzero(fired[i])
            at = np.concatenate([sample.place[own], first + own_voters, [size - 1]])
            x = np.concatenate([values[own].astype(float), np.ones(len(own_voters) + 1)])
            w = weights(at)
            g = (float(sigmoid(w @ x)) - target[i]) * x
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    final = weights(np.arange(size))
    kept = np.flatnonzero(final[:first])
    of_place = dict(zip(kept.tolist(), final[kept].tolist(), strict=True))
    return Classifier(float(final[-1]), voters, final[first:-1].tolist(), of_place)


def training_rows(docs: DataFrame, labels: DataFrame, most: int, unlabelled: int) -> DataFrame:
    """doc_id, text and label of the labelled sample, and of about ``unlabelled`` more documents, as
    many of them labelled as it happens, without label. None is held out."""
    chosen = labelled_ids(labels, "toxic", most)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = texts.where(~held_out())
    rate = min(1.0, unlabelled / max(1, texts.count()))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(rate * (1 << 30))
    joined = texts.join(chosen, "doc_id", "left")
    return thinned(joined.where(F.col("label").isNotNull() | chance))


def train(
    docs: DataFrame, labels: DataFrame, most: int = SAMPLE, unlabelled: int = UNLABELLED
) -> Classifier:
    """Voters, label model and classifier from about ``most`` labelled documents of each class and
    ``unlabelled`` others, none of them held out, and of SAMPLE_BYTES together at most. Without labels
    of both classes, or without a lexicon, every score is the prior."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out())
    n = known.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    prior = Classifier(logit((n[0] + 0.5) / (n[0] + n[1] + 1)), [], [], {})
    if not all(n):
        return prior
    rows = training_rows(docs, labels, most, unlabelled)
    held = packed_rows(rows).collect()
    held.sort(key=lambda r: (r["doc_id"], r["places"]))
    sample = Sample.of(held)
    del held  # the arrays are copies
    candidates = candidate_stems(sample)
    names = stem_names(rows.where("label = 1"), {c[1] for c in candidates}) if candidates else {}
    voters = lexicons(candidates, names)
    if not voters:
        return prior
    fired = votes(sample, voters)
    model = label_model(fired, len(voters), sample.label)
    return fit_classifier(sample, model.posterior(fired, sample.label), voters)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id and score of every whole text. Null and empty texts have no words and get the score
    of the bias; repeated rows are scored alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.bias, model.voters, model.of_voter, model.of_place)
    )  # of bounded size

    def run(batches):
        own = Classifier(*shared.value)
        for rows in batches:
            found = [own.score(t) for t in rows.column("text").to_pylist()]
            yield batch(doc_id=rows.column("doc_id"), score=pa.array(found, pa.float64()))

    return map_arrow(
        docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, score double"
    )
