"""Language-model scores: the probability of a text summed over all its segmentations.

A word is the end of every path through a lattice whose arcs are the pieces of an existing
unigram vocabulary, and one arc for the whole word, weighted by its count in the training
texts. The vocabulary's scores weight the pieces at first; expectation-maximisation over all
distinct training words, of all their segmentations, adapts them. The forward recursion in
log space gives the sum over all paths. Pieces do not cross words, so the sum for a text is the product of the
sums for its words, and each distinct word is computed once for the whole corpus.

The count of distinct words grows with the corpus, so no task holds them all. Texts are
read once and turned into groups: a bounded list of distinct words, and the texts as
positions in it. The lists are counted, joined with the counts, and returned to their
groups; a word crosses the shuffle once for each group that has it, however often it occurs.
"""

from __future__ import annotations

import math
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, fold, larger, lower_words, map_arrow, stored
from curbline.llm.vocabularies import vocabulary

PIECES = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
# A group ends when it has as many distinct words, or tokens.
GROUP_WORDS, GROUP_TOKENS = 250_000, 2_000_000
# Words that are summed at once: those of one length share the array operations.
WORDS_AT_ONCE = 20_000
# Rounds of learning, uses of pieces that the vocabulary stands for, and lanes of sums.
ROUNDS, PRIOR, LANES = 2, 1000.0, 64
WORD_START = "▁"

GROUPS = """grp bigint, doc_ids binary, held binary, sizes binary, tokens binary,
  words array<string>, train array<int>, train_docs bigint"""
SCORES = """doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint,
  train_tokens bigint, base_score double, score double"""


class Lattice:
    """All segmentations of many words at once.

    ``weights``: natural logs of the probability of each piece; the last is that of a byte, which
    spells characters that no piece has. The vocabulary's scores are ranks (0, -1, -2, ...),
    so Zipf's law makes them probabilities: a piece of rank r weighs 1 / (r + 2.7).
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        plain = [i for i in range(size) if not any(test(i) for test in special)]
        self.pieces = [model.id_to_piece(i) for i in plain]
        weight = np.array([1 / (2.7 - model.get_score(i)) for i in plain] + [1 / (size + 2.7)])
        # All 256 bytes have the last rank.
        self.prior = np.log(weight / (weight[:-1].sum() + 256 * weight[-1]))
        self.longest = max(map(len, self.pieces))
        keys = np.array([self._hashes(self._codes([p]))[-1][0, 0] for p in self.pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _codes(group: list[str]) -> np.ndarray:
        """Words of one length as a matrix of characters."""
        data = "".join(group).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(data, np.uint32).reshape(len(group), -1)

    def _hashes(self, codes: np.ndarray) -> list[np.ndarray]:
        """By length from 1, hashes of the substrings from every position."""
        out, key = [], np.zeros(codes.shape, np.uint64)
        codes = codes.astype(np.uint64)
        longest = getattr(self, "longest", codes.shape[1])
        for n in range(1, min(longest, codes.shape[1]) + 1):
            key = (key[:, : codes.shape[1] - n + 1] + codes[:, n - 1 :] + _ONE) * _MIX
            out.append(key)
        return out

    def _arcs(self, codes: np.ndarray) -> list[np.ndarray]:
        """By length from 1, the piece from every position, or -1."""
        out = []
        for key in self._hashes(codes):
            found = np.full(key.shape, -1, np.int32)
            row, at = np.nonzero(self.seen[(key >> np.uint64(44)).astype(np.int64)])
            wanted = key[row, at]
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[place] == wanted
            found[row[hit], at[hit]] = self.order[place[hit]]
            out.append(found)
        return out

    def masses(self, words_: list[str], weights: np.ndarray, counts: np.ndarray | None = None):
        """Natural log of the sum over all segmentations of each word. ``counts`` takes the expected
        uses of each piece, the last place those of bytes."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words_):
            by_length.setdefault(len(w), []).append(i)
        out = np.empty(len(words_))
        for own in by_length.values():
            for k in range(0, len(own), 2048):
                part = own[k : k + 2048]
                out[part] = self._group([WORD_START + words_[i] for i in part], weights, counts)
        return out

    def _group(self, group: list[str], weights: np.ndarray, counts: np.ndarray | None):
        codes = self._codes(group)
        size = codes.shape[1]
        arcs = self._arcs(codes)
        padded = np.append(weights[:-1], -np.inf)  # -1 is no piece
        logs = [padded[a] for a in arcs]
        spelled = arcs[0] < 0
        n_bytes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        logs[0] = np.where(spelled, n_bytes * weights[-1], logs[0])
        ahead = np.full((len(group), size + 1), -np.inf)
        ahead[:, 0] = 0
        for j in range(1, size + 1):
            lengths = range(1, min(len(arcs), j) + 1)
            ahead[:, j] = log_sum([ahead[:, j - n] + logs[n - 1][:, j - n] for n in lengths])
        total = ahead[:, size]
        if counts is not None:
            back = np.full((len(group), size + 1), -np.inf)
            back[:, size] = 0
            for i in range(size - 1, -1, -1):
                lengths = range(1, min(len(arcs), size - i) + 1)
                back[:, i] = log_sum([back[:, i + n] + logs[n - 1][:, i] for n in lengths])
            for n, (arc, log) in enumerate(zip(arcs, logs, strict=True), 1):
                used = np.exp(ahead[:, : size - n + 1] + log + back[:, n:] - total[:, None])
                has = arc >= 0
                counts[:-1] += np.bincount(arc[has], used[has], len(counts) - 1)
                if n == 1:
                    counts[-1] += (used * n_bytes)[spelled].sum()
        return total


# Added to the flag of a text that is held out, where it has no doc_id.
WITHOUT_ID = 2
_MIX, _ONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)


def log_sum(terms: list[np.ndarray]) -> np.ndarray:
    stack = np.stack(terms)
    most = stack.max(0)
    return most + np.log(np.exp(stack - most).sum(0))


@lru_cache(maxsize=1)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def learned_weights(counted: DataFrame, folder: str | None, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the pieces after ``rounds`` of expectation-maximisation on all distinct training
    words, from those of the vocabulary, which stay in as PRIOR uses of pieces.

    Each distinct word counts once: these weights are for words that were not seen.
    """
    own = lattice(vocabulary(PIECES, folder))
    weights = own.prior
    for _ in range(rounds):

        def expected(batches, weights=weights):
            own = lattice(vocabulary(PIECES, folder))
            counts = np.zeros(len(weights))
            for rows in larger(batches, WORDS_AT_ONCE):
                own.masses(rows.column("word").to_pylist(), weights, counts)
            yield batch(
                lane=pa.array([TaskContext.get().partitionId() % LANES], pa.int32()),
                counts=pa.array([counts.tobytes()], pa.binary()),
            )

        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_buffer(), float) for x in table.column("counts"))
            return pa.table({"lane": pa.array([0], pa.int32()), "counts": [total.tobytes()]})

        schema = "lane int, counts binary"
        uses = map_arrow(counted.where("c > 0").select("word"), expected, schema)
        uses = uses.groupBy("lane").applyInArrow(added, schema)
        found = uses.groupBy("lane").applyInArrow(added, schema).first()
        if found is None:
            break
        counts = np.frombuffer(found["counts"], float) + PRIOR * np.exp(own.prior)
        # The last place is the sum over bytes.
        counts[-1] = max(counts[-1] / 256, 1e-3)
        weights = np.log(counts / (counts[:-1].sum() + 256 * counts[-1]))
    return weights


def groups_of_texts(docs: DataFrame) -> DataFrame:
    """Documents as positions in lists of distinct words, one row for each group."""

    def run(batches):
        part, groups = TaskContext.get().partitionId(), 0
        place: dict[bytes, int] = {}
        doc_ids, held, sizes, tokens = array("q"), bytearray(), array("i"), array("I")

        def group():
            nonlocal groups
            at = np.frombuffer(tokens, np.uint32)
            learned = np.frombuffer(held, np.uint8) & 1 == 0
            training = np.repeat(learned, np.frombuffer(sizes, np.int32))
            train = np.bincount(at[training], minlength=len(place)).astype(np.int32)
            out = batch(
                grp=pa.array([(part << 32) + groups], pa.int64()),
                doc_ids=pa.array([doc_ids.tobytes()], pa.binary()),
                held=pa.array([bytes(held)], pa.binary()),
                sizes=pa.array([sizes.tobytes()], pa.binary()),
                tokens=pa.array([at.tobytes()], pa.binary()),
                words=pa.ListArray.from_arrays(
                    pa.array([0, len(place)], pa.int32()), pa.array([w.decode("utf-8", "replace") for w in place], pa.string())
                ),
                train=pa.ListArray.from_arrays(
                    pa.array([0, len(place)], pa.int32()), pa.array(train, pa.int32())
                ),
                train_docs=pa.array([int(learned.sum())], pa.int64()),
            )
            groups += 1
            return out

        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))
            for doc_id, is_held, text in zip(*columns, strict=True):
                own = lower_words(text)
                tokens.extend([place.setdefault(w, len(place)) for w in own])
                doc_ids.append(0 if doc_id is None else doc_id)
                held.append(is_held + WITHOUT_ID * (doc_id is None))
                sizes.append(len(own))
                if len(place) >= GROUP_WORDS or len(tokens) >= GROUP_TOKENS:
                    yield group()
                    place = {}
                    doc_ids, held, sizes, tokens = array("q"), bytearray(), array("i"), array("I")
        if doc_ids:
            yield group()

    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "text",
    )
    return map_arrow(rows, run, GROUPS)


def score(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Scores of all documents: see SCORES.

    A word of count c has probability (c + V * m) / (N + V), m being its sum over the
    segmentations, N the tokens and V the distinct tokens of the training texts; the end of a
    text is a token as well. Null and empty texts are an end alone. Repeated rows are scored,
    and counted, as often as they come; rows without doc_id are not of the fold that is held out, so
    they are scored and learned from like others; an empty table gives no rows.
    """
    groups = stored(groups_of_texts(docs), "word-groups")
    listed = groups.select("grp", F.posexplode(F.arrays_zip("words", "train")).alias("at", "w"))
    listed = listed.select("grp", "at", F.col("w.words").alias("word"), F.col("w.train").alias("n"))

    counts = listed.groupBy("word").agg(F.sum("n").alias("c"))
    counted = stored(counts, "word-counts")
    weights = learned_weights(counted, folder)

    def masses(batches):
        own = lattice(vocabulary(PIECES, folder))
        for rows in larger(batches, WORDS_AT_ONCE):
            found = own.masses(rows.column("word").to_pylist(), weights)
            yield batch(
                word=rows.column("word"), c=rows.column("c"), mass=pa.array(found, pa.float64())
            )

    counted = stored(map_arrow(counted, masses, "word string, c bigint, mass double"), "word-masses")
    n_words, distinct = counted.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    ends = groups.agg(F.sum("train_docs")).first()[0] or 0
    n = (n_words or 0) + ends
    v = distinct + (ends > 0)

    returned = (
        listed.select("grp", "at", "word")
        .join(counted, "word")
        .groupBy("grp")
        .agg(
            F.collect_list("at").alias("at"),
            F.collect_list("c").alias("c"),
            F.collect_list("mass").alias("mass"),
        )
    )
    texts = groups.select("grp", "doc_ids", "held", "sizes", "tokens")

    def run(batches):
        log_end = -math.log(len(weights))
        for rows in batches:
            for i in range(rows.num_rows):
                data = [rows.column(c)[i].as_py() for c in ("doc_ids", "held", "sizes", "tokens")]
                doc_ids = np.frombuffer(data[0], np.int64)
                held = np.frombuffer(data[1], np.uint8)
                sizes = np.frombuffer(data[2], np.int32).astype(np.int64)
                tokens = np.frombuffer(data[3], np.uint32)
                lists = [rows.column(c)[i].values for c in ("at", "c", "mass")]
                at, c, mass = (np.asarray(x if x is not None else [], float) for x in lists)
                at = at.astype(np.int64)
                c, mass = np.append(c, ends), np.append(mass, log_end)
                base, mixed = log_probabilities(c, mass, n, v)
                order = np.empty(len(at), np.int64)
                order[at] = np.arange(len(at))
                own = order[tokens]
                doc = np.repeat(np.arange(len(sizes)), sizes)
                total = [
                    np.bincount(doc, x[own], minlength=len(sizes)) + x[-1]
                    for x in (base, mixed, (c > 0).astype(float))
                ]
                yield batch(
                    doc_id=pa.array(doc_ids, pa.int64(), mask=held & WITHOUT_ID > 0),
                    held_out=pa.array((held & 1).astype(bool), pa.bool_()),
                    n_tokens=pa.array(sizes + 1, pa.int64()),
                    n_known=pa.array(total[2].astype(np.int64), pa.int64()),
                    train_tokens=pa.array(np.full(len(sizes), n), pa.int64()),
                    base_score=pa.array(total[0], pa.float64()),
                    score=pa.array(total[1], pa.float64()),
                )

    return map_arrow(texts.join(returned, "grp", "left"), run, SCORES)


def log_probabilities(c: np.ndarray, mass: np.ndarray, n: int, v: int):
    """log10 of each token: add-one base, and the count's arc with those of the pieces."""
    base = np.log10((c + 1) / (n + v + 1))
    if n == 0:
        return base, mass / math.log(10)
    escape = math.log(v / (n + v)) + mass
    with np.errstate(divide="ignore"):
        mixed = np.logaddexp(np.log(c / (n + v)), escape)
    return base, mixed / math.log(10)
