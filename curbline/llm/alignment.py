"""Alignment of two tokenizers on every document, with corpus-wide counts of aligned pairs.

A text is encoded by a byte-level BPE (A) and a piece BPE (B). Where tokens of both end at the same
byte, they are linked, and the text is cut into groups. How often each pair of ids is linked in the
whole corpus is found in these steps:

1. Every task aligns its documents and keeps its distinct pairs with counts, by shard. A shard
   holds all pairs of a B id.
2. The distinct pairs of each shard get a minimal perfect hash: pair number i of n has slot i.
3. The counts of up to ``LEAF_TASKS`` tasks become a dense vector by slot, and vectors are added up
   in a tree, ``FAN`` at a time, to one for each shard. The pairs themselves are kept by slot, so
   that a look-up verifies what it has found.
4. A second pass aligns the documents again and looks the counts up. Shards are files; a task reads
   those it needs and holds at most ``HELD_BYTES`` of them, whatever their number.

No step sees all pairs at once. A shard has at most the ids of A times its share of those of B.
Documents never move.

Before a space that follows anything but white space, tokens of both sides end: A splits there, and
no piece of B has a space behind another character. So a text is aligned part by part, and what
is known of a part is remembered.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, stored
from curbline.llm.packing import ByteTokenizer
from curbline.llm.perfect_hash import PerfectHash, mixed
from curbline.llm.shared_files import located, parquet_files
from curbline.llm.vocabularies import vocabulary
from curbline.session import fresh_path

PIECE_BPE = "piece_bpe_32k.model"
SHARDS = 128
LEAF_TASKS = 512
FAN = 32
# Letters of text aligned at a time, about.
ALIGNED_BYTES = 1 << 20
# Parts, and letters of them, beyond which a task forgets what it knows of parts.
HELD_PARTS, HELD_LETTERS = 250_000, 6_000_000
# Distinct pairs of a task after which they are handed on.
HELD_PAIRS = 1 << 20
HELD_BYTES = 96 << 20
B_BITS = np.uint64(32)
B_MASK = np.uint64((1 << 32) - 1)


# ---------------------------------------------------------------------------
# Tokens and links
# ---------------------------------------------------------------------------

ODD_SPACE = re.compile(r"^ |\s ")
BORDER = re.compile(r"(?<=\S)(?= )")


def parts_of(text: str) -> list[str]:
    """The parts of a text that are aligned on their own, each without the space before it."""
    if ODD_SPACE.search(text):
        return [part[1:] for part in BORDER.split(f" {text}")]
    return text.split(" ")


class Aligner:
    """Aligns texts by their parts. Part number i has ``n_a[i]`` and ``n_b[i]`` tokens, ``n_links[i]`` of
    the linked ``pairs``, and the text ``groups[i]`` where those are wanted. A part that loses bytes
    has no tokens and is ``lost``."""

    def __init__(self, folder: str | None):
        from sentencepiece import SentencePieceProcessor

        self.coder = ByteTokenizer(folder).coder
        self.pieces = SentencePieceProcessor(model_file=vocabulary(PIECE_BPE, folder))
        self.a_bytes = [self._token(i) for i in range(self.coder.n_vocab)]
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("pieces of the vocabulary cross the spaces between words")
        self.b_bytes = [self._piece(i, name) for i, name in enumerate(names)]
        self.space = self.pieces.piece_to_id("▁")  # B adds none to an empty text
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.forget()

    def _token(self, i: int) -> bytes:
        try:
            return self.coder.decode_single_token_bytes(i)
        except KeyError:  # an id without a token
            return b""

    def _piece(self, i: int, name: str) -> bytes:
        if self.pieces.is_byte(i):
            return bytes([int(name[3:-1], 16)])
        return name.replace("▁", " ").encode()

    def forget(self, with_groups: bool = False) -> None:
        none = np.zeros(0, np.int64)
        self.number: dict[str, int] = {}
        self.n_a = self.n_b = self.n_links = none
        self.pairs, self.lost = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.groups: list[str] = []
        self.with_groups, self.letters = with_groups, 0

    def is_full(self) -> bool:
        return len(self.number) > HELD_PARTS or self.letters > HELD_LETTERS

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Part numbers of all texts one after the other, and how many each text has: none where
        there is no text, or where either side loses bytes of it."""
        parts, sizes = [], []
        for text in texts:
            own = parts_of(text) if text else []
            parts += own
            sizes.append(len(own))
        self.learn([p for p in set(parts) if p not in self.number])
        found, sizes = np.array([self.number[p] for p in parts], np.int64), np.array(sizes, np.int64)
        if self.lost[found].any():
            of = np.repeat(np.arange(len(sizes)), sizes)
            gone = np.unique(of[self.lost[found]])
            found, sizes[gone] = found[~np.isin(of, gone)], 0
        return found, sizes

    def learn(self, parts: list[str]) -> None:
        """Align new parts. Behind white space a part would not end for A, so such parts go alone."""
        together = [p for p in parts if p and not p[-1].isspace()]
        if together:
            self._align(together)
        for part in parts:
            if not part or part[-1].isspace():
                self._align([part])

    def _align(self, parts: list[str]) -> None:
        whole = "".join([f" {p}" for p in parts])
        a = self.coder.encode_ordinary(whole)
        b = [ids or [self.space] for ids in self.pieces.encode(parts, num_threads=1)]
        b = list(chain.from_iterable(b))
        in_bytes = whole.encode()
        same = all(
            b"".join([held[i] for i in ids]) == in_bytes
            for held, ids in ((self.a_bytes, a), (self.b_bytes, b))
        )
        if not same and len(parts) > 1:
            for half in (parts[: len(parts) // 2], parts[len(parts) // 2 :]):
                self._align(half)
            return
        if not same:
            a, b = [], []
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        # No token of a text is empty, so no two tokens of a side end together.
        a_ends, b_ends = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        at = np.searchsorted(b_ends, a_ends)
        linked = b_ends[at] == a_ends if len(a) else np.zeros(0, bool)
        link_a, link_b = np.flatnonzero(linked), at[linked]
        n_a, n_b, n_links = (
            np.bincount(np.searchsorted(ends, x), minlength=len(parts))
            for x in (a_ends, b_ends, a_ends[linked])
        )
        self.number |= zip(parts, range(len(self.number), len(self.number) + len(parts)), strict=True)
        self.letters += len(whole)
        self.n_a = np.concatenate([self.n_a, n_a])
        self.n_b = np.concatenate([self.n_b, n_b])
        self.n_links = np.concatenate([self.n_links, n_links])
        self.lost = np.concatenate([self.lost, np.full(len(parts), not same)])
        pairs = a[link_a].astype(np.uint64) << B_BITS | b[link_b].astype(np.uint64)
        self.pairs = np.concatenate([self.pairs, pairs])
        if self.with_groups:
            texts = list(_groups(a.tolist(), b.tolist(), link_a.tolist(), link_b.tolist()))
            first = np.concatenate([[0], np.cumsum(n_links)]).tolist()
            self.groups += [";".join(texts[i:j]) for i, j in pairwise(first)]


def _groups(a: list[int], b: list[int], link_a: list[int], link_b: list[int]) -> Iterator[str]:
    """The ids of each group, ``a1,a2|b1``."""
    i = j = 0
    for last_a, last_b in zip(link_a, link_b, strict=True):
        if i == last_a and j == last_b:
            yield f"{a[i]}|{b[j]}"
        else:
            own_a, own_b = a[i : last_a + 1], b[j : last_b + 1]
            yield f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}"
        i, j = last_a + 1, last_b + 1


@lru_cache(maxsize=1)
def aligner(folder: str | None) -> Aligner:
    return Aligner(folder)


def by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """doc_id and text in pieces of ALIGNED_BYTES or a row more."""
    ids, texts, size = [], [], 0
    for rows in batches:
        for doc_id, text in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= ALIGNED_BYTES:
                yield pa.array(ids, pa.int64()), texts
                ids, texts, size = [], [], 0
    if ids:
        yield pa.array(ids, pa.int64()), texts


def shard_of(pairs: np.ndarray) -> np.ndarray:
    """All pairs of a B id are in one shard."""
    return (mixed(pairs & B_MASK, MIX_OF_SHARDS) % np.uint64(SHARDS)).astype(np.int64)


MIX_OF_SHARDS = 1000


# ---------------------------------------------------------------------------
# Counting
# ---------------------------------------------------------------------------


def _sorted_by_shard(pairs: np.ndarray, *columns: np.ndarray):
    """(shard, pairs, columns...) of every shard that occurs."""
    shards = shard_of(pairs)
    order = np.argsort(shards, kind="stable")
    bounds = np.searchsorted(shards[order], np.arange(SHARDS + 1))
    for shard in np.unique(shards).tolist():
        own = order[bounds[shard] : bounds[shard + 1]]
        yield shard, pairs[own], *(c[own] for c in columns)


def partial_counts(docs: DataFrame, folder: str | None) -> DataFrame:
    """task, shard, and packed pairs with counts: the distinct pairs of each task."""

    def run(batches):
        own, task = aligner(folder), TaskContext.get().partitionId()
        own.forget()
        pairs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        times = np.zeros(0, np.int64)  # of each part that is known

        def merged():
            every = np.concatenate([pairs, own.pairs])
            distinct, at = np.unique(every, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, at, np.concatenate([counts, np.repeat(times, own.n_links)]))
            used = total > 0  # parts that only a lost text has are known and not counted
            return distinct[used], total[used]

        def rows():
            for shard, own_pairs, own_counts in _sorted_by_shard(pairs, counts):
                yield batch(
                    task=pa.array([task], pa.int32()),
                    shard=pa.array([shard], pa.int32()),
                    pairs=pa.array([own_pairs.astype("<u8").tobytes()], pa.binary()),
                    counts=pa.array([own_counts.astype("<i8").tobytes()], pa.binary()),
                )

        for _, texts in by_bytes(batches):
            if own.is_full():
                pairs, counts = merged()
                own.forget()
                times = times[:0]
                if len(pairs) >= HELD_PAIRS:
                    yield from rows()
                    pairs, counts = pairs[:0], counts[:0]
            numbers, _ = own.numbers(texts)
            found = np.bincount(numbers, minlength=len(own.number))
            found[: len(times)] += times
            times = found
        pairs, counts = merged()
        yield from rows()

    return map_arrow(
        docs.select(F.col("doc_id").cast("bigint"), "text"),
        run,
        "task int, shard int, pairs binary, counts binary",
    )


def hashes_of(partials: DataFrame) -> DataFrame:
    """shard, the perfect hash of its distinct pairs, and the pairs by slot."""

    def unpack(batches):
        for rows in batches:
            shards = rows.column("shard").to_pylist()
            for shard, packed in zip(shards, rows.column("pairs").to_pylist(), strict=True):
                pairs = np.frombuffer(packed, "<i8")
                yield batch(
                    shard=pa.array(np.full(len(pairs), shard, np.int32)), pair=pa.array(pairs)
                )

    distinct = map_arrow(partials.select("shard", "pairs"), unpack, "shard int, pair long").distinct()

    def build(rows: pa.Table) -> pa.Table:
        pairs = np.sort(rows.column("pair").to_numpy()).view(np.uint64)
        made = PerfectHash.of(pairs)
        by_slot = np.empty_like(pairs)
        by_slot[made.slots(pairs)] = pairs
        return pa.table(
            {
                "shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()),
                "sizes": pa.array([made.sizes], pa.list_(pa.int64())),
                "bits": pa.array([made.words.astype("<u8").tobytes()], pa.binary()),
                "pairs": pa.array([by_slot.astype("<u8").tobytes()], pa.binary()),
            }
        )

    return distinct.groupBy("shard").applyInArrow(
        build, "shard int, sizes array<bigint>, bits binary, pairs binary"
    )


def _hash_of(row: dict) -> PerfectHash:
    return PerfectHash(list(row["sizes"]), np.frombuffer(row["bits"], "<u8").astype(np.uint64))


def summed_vectors(partials: DataFrame, hashes: DataFrame) -> DataFrame:
    """shard and the dense vector of its pairs' counts by slot."""

    def dense(rows: pa.Table, own: pa.Table) -> pa.Table:
        one = own.to_pylist()[0]
        made, total = _hash_of(one), np.zeros(len(one["pairs"]) // 8, np.int64)
        for pairs, counts in zip(rows.column("pairs"), rows.column("counts"), strict=True):
            at = made.slots(np.frombuffer(pairs.as_py(), "<u8"))
            np.add.at(total, at, np.frombuffer(counts.as_py(), "<i8"))
        return _vector(one["of_shard"], one["of_leaf"], total)

    def added(rows: pa.Table) -> pa.Table:
        first, *rest = rows.column("vector")
        total = np.frombuffer(first.as_py(), "<i8").copy()
        for other in rest:
            total += np.frombuffer(other.as_py(), "<i8")
        parent = rows.column("leaf")[0].as_py() // FAN
        return _vector(rows.column("shard")[0].as_py(), parent, total)

    def _vector(shard: int, leaf: int, total: np.ndarray) -> pa.Table:
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "leaf": pa.array([leaf], pa.int32()),
                "vector": pa.array([total.astype("<i8").tobytes()], pa.binary()),
            }
        )

    schema = "shard int, leaf int, vector binary"
    leaf = F.floor(F.col("task") / LEAF_TASKS).cast("int").alias("leaf")
    leaves = partials.select("shard", leaf, "pairs", "counts")
    taken = leaves.select("shard", F.col("leaf").alias("of_leaf")).distinct()
    asked = hashes.join(taken, "shard").withColumnRenamed("shard", "of_shard")
    vectors = (
        leaves.groupBy("shard", "leaf")
        .cogroup(asked.groupBy("of_shard", "of_leaf"))
        .applyInArrow(dense, schema)
    )
    left = partials.agg(F.coalesce(F.max(leaf), F.lit(0))).first()[0] + 1
    while left > 1:
        vectors = vectors.groupBy("shard", F.floor(F.col("leaf") / FAN)).applyInArrow(added, schema)
        left = -(-left // FAN)
    return vectors.select("shard", "vector")


@dataclass(frozen=True)
class PairTable:
    """Counts of all linked pairs. ``path`` has a folder ``shard=N`` for each shard with pairs."""

    path: str

    def rows(self, spark: SparkSession) -> DataFrame:
        """a, b, n and best (no pair of b is linked more often) of every pair."""

        def unpack(batches):
            for rows in batches:
                for row in rows.to_pylist():
                    pairs = np.frombuffer(row["pairs"], "<u8")
                    yield batch(
                        a=pa.array((pairs >> B_BITS).astype(np.int64)),
                        b=pa.array((pairs & B_MASK).astype(np.int64)),
                        n=pa.array(np.frombuffer(row["counts"], "<i8")),
                        best=pa.array(np.frombuffer(row["best"], np.bool_)),
                    )

        found = spark.read.schema(SHARD_SCHEMA).parquet(self.path)
        return map_arrow(found, unpack, "a long, b long, n long, best boolean")


SHARD_SCHEMA = "sizes array<bigint>, bits binary, pairs binary, counts binary, best binary, shard int"


def count_pairs(docs: DataFrame, folder: str | None = None) -> PairTable:
    """How often each pair of ids is linked in all texts of ``docs``."""
    spark = docs.sparkSession
    partials = stored(partial_counts(docs, folder), "pair-partials")
    hashes = stored(hashes_of(partials), "pair-hashes")
    vectors = summed_vectors(partials, hashes)

    def most_linked(batches):
        """Marks the pairs whose count no other pair of their B id exceeds."""
        for rows in batches:
            for row in rows.to_pylist():
                b = np.frombuffer(row["pairs"], "<u8") & B_MASK
                counts = np.frombuffer(row["vector"], "<i8")
                _, of = np.unique(b, return_inverse=True)
                most = np.zeros(of.max() + 1, np.int64)
                np.maximum.at(most, of, counts)
                yield batch(
                    sizes=pa.array([row["sizes"]], pa.list_(pa.int64())),
                    bits=pa.array([row["bits"]], pa.binary()),
                    pairs=pa.array([row["pairs"]], pa.binary()),
                    counts=pa.array([row["vector"]], pa.binary()),
                    best=pa.array([(counts == most[of]).tobytes()], pa.binary()),
                    shard=pa.array([row["shard"]], pa.int32()),
                )

    path = fresh_path(spark, "llm-pair-table")
    marked = map_arrow(hashes.join(vectors, "shard"), most_linked, SHARD_SCHEMA)
    marked.write.partitionBy("shard").parquet(path)
    return PairTable(path)


# ---------------------------------------------------------------------------
# Looking up
# ---------------------------------------------------------------------------


class Shards:
    """Shards of a table as a task reads them; the ones used last stay, up to HELD_BYTES."""

    def __init__(self, path: str):
        self.path, self.held, self.size = path, OrderedDict(), 0
        system, at = located(path)
        found = system.get_file_info(fs.FileSelector(at))
        self.present = {int(f.base_name[6:]) for f in found if f.base_name.startswith("shard=")}

    def shard(self, k: int):
        if k in self.held:
            self.held.move_to_end(k)
            return self.held[k]
        folder = f"{self.path}/shard={k}"
        system = located(folder)[0]
        [file] = parquet_files(folder)
        with system.open_input_file(file) as opened:
            [row] = pq.ParquetFile(opened).read().to_pylist()
        found = (
            _hash_of(row),
            np.frombuffer(row["pairs"], "<u8"),
            np.frombuffer(row["counts"], "<i8"),
            np.frombuffer(row["best"], np.bool_),
        )
        self.held[k] = found
        self.size += 24 * len(found[1])
        while self.size > HELD_BYTES and len(self.held) > 1:
            self.size -= 24 * len(self.held.popitem(last=False)[1][1])
        return found

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and best of every pair; 0 and False of a pair that was not counted."""
        distinct, of = np.unique(pairs, return_inverse=True)
        counts, best = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        for k, own, at in _sorted_by_shard(distinct, np.arange(len(distinct))):
            if k not in self.present:
                continue
            made, by_slot, count, is_best = self.shard(k)
            slots = made.slots(own)
            known = (slots >= 0) & (by_slot[slots] == own)
            counts[at[known]], best[at[known]] = count[slots[known]], is_best[slots[known]]
        return counts[of], best[of]

    def of_parts(self, pairs: np.ndarray, n_links: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each part, how many of its pairs are best, the sum of their counts, and how many were
        not counted."""
        counts, best = self.look_up(pairs)
        end = np.concatenate([[0], np.cumsum(n_links)])

        def total(of_pair):
            before = np.concatenate([[0], np.cumsum(of_pair)])
            return before[end[1:]] - before[end[:-1]]

        return total(best), total(counts), total(counts == 0)


@lru_cache(maxsize=1)
def shards(path: str) -> Shards:
    return Shards(path)


def align(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row of ``docs``.

    ``groups`` lists the ids, ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and texts that a tokenizer
    doesn't give back byte by byte, have zeros and an empty list, and count for nothing. Repeated rows
    count each, and rows without doc_id as others do. An empty table gives no rows.
    """
    table = count_pairs(docs, folder)

    def run(batches):
        own, known = aligner(folder), shards(table.path)
        own.forget(with_groups=True)
        n_best = count_sum = unknown = np.zeros(0, np.int64)
        for ids, texts in by_bytes(batches):
            if own.is_full():
                own.forget(with_groups=True)
                n_best = count_sum = unknown = n_best[:0]
            numbers, sizes = own.numbers(texts)
            before = int(own.n_links[: len(n_best)].sum())
            new = known.of_parts(own.pairs[before:], own.n_links[len(n_best) :])
            n_best, count_sum, unknown = map(np.append, (n_best, count_sum, unknown), new)
            # Only parts of texts that lose bytes elsewhere can have pairs that were not counted.
            if unknown[numbers].any():
                raise KeyError("a pair of ids that was not counted; the documents have changed")
            first = np.concatenate([[0], np.cumsum(sizes)])

            def total(of_part):
                before = np.concatenate([[0], np.cumsum(of_part[numbers])])
                return pa.array(before[first[1:]] - before[first[:-1]])

            links, order = total(own.n_links), numbers.tolist()
            groups = [
                ";".join([own.groups[i] for i in order[start:end]])
                for start, end in pairwise(first.tolist())
            ]
            yield batch(
                doc_id=ids,
                n_a=total(own.n_a),
                n_b=total(own.n_b),
                n_groups=links,  # each link ends a group
                n_links=links,
                n_best=total(n_best),
                count_sum=total(count_sum),
                groups=pa.array(groups, pa.string()),
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("bigint"), "text"),
        run,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups string",
    )
