"""Exact Jaccard join of documents on word shingles, by prefixes of token combinations.

The tokens of a document are its distinct shingles, in one order for all documents: by the
count of their slot in a table of counts of fixed size, then by hash, so rare ones come
first. Two similar documents of different shingles share two tokens at least among the first
``prefix(n)`` of each. So they share a rare token there, which is indexed alone, or two
frequent ones, whose combination is indexed. A document with many frequent tokens in its
prefix ("heavy") would have too many combinations; its frequent tokens are indexed alone,
and those of light documents too, but there a pair counts only if one of it is heavy.

Copies collapse first: equal sets are one node. Similar documents share far more of their
prefixes than two tokens, so pairs that share too few go unverified. Where many nodes share a
key, each is first compared with a few of them, those that most such keys have; then only
pairs that this has not joined into one component are compared. So a large group of near copies costs a few comparisons for each member, and no
link between different components is missed.

Index entries travel as packed arrays, sorted with numpy where they arrive.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import (
    batch,
    discard,
    free_shuffles,
    intermediates,
    lower_words,
    map_arrow,
    outcome,
    stored,
)
from curbline.llm.components import components

SHINGLE = 5
# Similar: 4 * intersection >= 3 * union.
NUMERATOR, DENOMINATOR = 3, 4
SLOTS = 1 << 20
# Counts travel in blocks of so many slots, and are added up over so many lanes of tasks first.
SLOT_BLOCK, LANES = 1 << 14, 64
# A document with more frequent tokens in its prefix is heavy.
FEW = 12
# Nodes of a key that are compared pair by pair at once.
SMALL = 16
# Index entries of a partition, and those a task holds before it sends them on.
PARTITION_ENTRIES, HELD_ENTRIES = 500_000, 500_000
# Documents of a frequent token that meet in one place at first.
SALTED = 50_000
BLOOM_BITS = 1 << 23
# In each round every large key meets one more of its nodes, until the pairs that are left are so many
# a member of large keys at most, or a round has not left a quarter fewer.
OPEN_PAIRS, LEAST_GAIN = 4, 0.25
# Keys of a node that travel with each of its entries, at most.
LISTED = 256
MEMORY = 120_000
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes. Words are hashed once and remembered."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.hashes = np.zeros(MEMORY, np.uint64)

    def _new(self, word: bytes) -> int:
        at = len(self.place)
        self.place[word] = at
        self.hashes[at] = xxhash.xxh3_64_intdigest(word)
        return at

    def tokens(self, text: str | None) -> np.ndarray:
        own = lower_words(text)
        if len(self.place) + len(own) > len(self.hashes):
            self.place = {}
            if len(own) > len(self.hashes):
                self.hashes = np.zeros(2 * len(own), np.uint64)
        get, new = self.place.get, self._new
        at = [p if (p := get(w)) is not None else new(w) for w in own]
        h = self.hashes[np.array(at, np.int64)]
        if 0 < len(h) < SHINGLE:
            whole = (h * _ODD[: len(h)]).sum(dtype=np.uint64)
            return mixed(np.array([whole + np.uint64(len(h))], np.uint64))
        if not len(h):
            return h
        size = len(h) - SHINGLE + 1
        total = np.zeros(size, np.uint64)
        for k in range(SHINGLE):
            total += h[k : k + size] * _ODD[k]
        return np.unique(mixed(total))


_shinglers: dict[str, Shingler] = {}


def shingler() -> Shingler:
    """One for each worker process."""
    return _shinglers.setdefault("", Shingler())


def fingerprint(tokens: np.ndarray) -> int:
    """63 bits of a set: the node that all copies share."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little") >> 1


def slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens % np.uint64(SLOTS)).astype(np.int64)


def prefix(n: int) -> int:
    """Tokens of which similar documents share two."""
    least = -(-NUMERATOR * n // DENOMINATOR)
    return min(n, n - least + 2)


def least_common(n: Column, m: Column) -> Column:
    """Prefix tokens that similar documents of n and m tokens share at least.

    What one has and the other lacks is at most its size less the least intersection; all
    the rest of the prefix that ends first in the order of tokens is in the other as well.
    """

    def prefix_of(x: Column) -> Column:
        return F.least(x, x - F.ceil(NUMERATOR * x / DENOMINATOR) + 2)

    shared = F.ceil(NUMERATOR * (n + m) / (NUMERATOR + DENOMINATOR))
    return F.least(prefix_of(n) - (n - shared), prefix_of(m) - (m - shared))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return DENOMINATOR * shared >= NUMERATOR * (len(both) - shared)


def fits(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sizes between which there can be a link."""
    return DENOMINATOR * np.minimum(n, m) >= NUMERATOR * np.maximum(n, m)


# ---------------------------------------------------------------------------
# Sets of all documents and counts of all tokens
# ---------------------------------------------------------------------------


def summarised(docs: DataFrame) -> DataFrame:
    """A row for each document (doc_id, node, n), and rows of (lane, block, counts) of each task."""

    def run(batches):
        own, counts = shingler(), np.zeros(SLOTS, np.int32)
        lane = TaskContext.get().partitionId() % LANES
        for rows in batches:
            nodes, sizes, seen = [], [], [np.zeros(0, np.uint64)]
            for text in rows.column("text").to_pylist():
                tokens = own.tokens(text)
                sizes.append(len(tokens))
                nodes.append(fingerprint(tokens) if len(tokens) else None)
                seen.append(tokens)
            slots, n = np.unique(slot(np.concatenate(seen)), return_counts=True)
            counts[slots] += n.astype(np.int32)
            yield summary_rows(
                doc_id=rows.column("doc_id"),
                node=pa.array(nodes, pa.int64()),
                n=pa.array(sizes, pa.int64()),
            )
        blocks = counts.reshape(-1, SLOT_BLOCK)
        yield summary_rows(
            lane=pa.array(np.full(len(blocks), lane), pa.int32()),
            block=pa.array(np.arange(len(blocks)), pa.int32()),
            counts=pa.array([b.tobytes() for b in blocks], pa.binary()),
        )

    return map_arrow(docs, run, SUMMARY)


SUMMARY = "doc_id bigint, node bigint, n bigint, lane int, block int, counts binary"
SUMMARY_TYPES = {
    "doc_id": pa.int64(),
    "node": pa.int64(),
    "n": pa.int64(),
    "lane": pa.int32(),
    "block": pa.int32(),
    "counts": pa.binary(),
}


def summary_rows(**columns) -> pa.RecordBatch:
    """Rows of SUMMARY; what isn't given is null."""
    size = len(next(iter(columns.values())))
    return batch(
        **{name: columns.get(name, pa.nulls(size, t)) for name, t in SUMMARY_TYPES.items()}
    )


def token_counts(summary: DataFrame) -> np.ndarray:
    """The counts of all slots: a vector of fixed size, added up in two steps."""

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(SLOT_BLOCK, np.int64)
        for x in table.column("counts"):
            data = np.frombuffer(x.as_buffer(), np.int64 if len(x.as_buffer()) > 4 * SLOT_BLOCK else np.int32)
            total += data
        return pa.table({"block": table.column("block")[:1], "counts": [total.tobytes()]})

    schema = "block int, counts binary"
    rows = summary.where("block IS NOT NULL").select("lane", "block", "counts")
    by_lane = rows.groupBy("block", "lane").applyInArrow(added, schema)
    counts = np.zeros((SLOTS // SLOT_BLOCK, SLOT_BLOCK), np.int64)
    for r in by_lane.groupBy("block").applyInArrow(added, schema).collect():
        counts[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return counts.reshape(-1)


# ---------------------------------------------------------------------------
# The index
# ---------------------------------------------------------------------------

ENTRIES = "part bigint, keys binary, nodes binary, sizes binary, kinds binary, places binary"
RARE, LIGHT, HEAVY, PAIR = 0, 1, 2, 3


def index_entries(tokens: np.ndarray, counts: np.ndarray, frequent_from: float):
    """Keys of one document, their kinds and places in the prefix (in 256 parts, rounded down);
    for frequent tokens, the count of the slot as well."""
    count = counts[slot(tokens)]
    length = prefix(len(tokens))
    take = np.lexsort((tokens, count))[:length]
    tokens, count = tokens[take], count[take]
    place = np.arange(length) * 256 // max(1, length)
    often = count >= frequent_from
    first = place[often]
    rare, frequent = tokens[~often], tokens[often]
    heavy = len(frequent) > FEW
    keys = [rare, frequent]
    kinds = [np.full(len(rare), RARE), np.full(len(frequent), HEAVY if heavy else LIGHT)]
    weight = [np.zeros(len(rare), np.int64), count[often]]
    places = [place[~often], first]
    if not heavy and len(frequent) > 1:
        i, j = np.triu_indices(len(frequent), 1)
        pairs = np.sort(np.stack([frequent[i], frequent[j]]), axis=0)
        keys.append(mixed(pairs[0] * _ODD[0] + pairs[1] * _ODD[1]))
        kinds.append(np.full(len(i), PAIR))
        weight.append(np.minimum(count[often][i], count[often][j]))
        places.append(first[i])
    return tuple(np.concatenate(x) for x in (keys, kinds, weight, places))


def packed_index(docs: DataFrame, counts: np.ndarray, parts: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # SLOTS numbers
    mean = counts.sum() / SLOTS
    frequent_from = mean + 6 * np.sqrt(mean) + 64

    def run(batches):
        own, held, size = shingler(), [], 0

        def sent():
            *columns, part = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(part, kind="stable")
            bounds = np.flatnonzero(np.diff(part[order])) + 1
            for rows in np.split(order, bounds):
                yield int(part[rows[0]]), *(c[rows].tobytes() for c in columns)

        def batches_of(rows):
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["part", "keys", "nodes", "sizes", "kinds", "places"],
            )

        for rows in batches:
            for text in rows.column("text").to_pylist():
                tokens = own.tokens(text)
                if not len(tokens):
                    continue
                node = fingerprint(tokens)
                keys, kinds, weight, places = index_entries(tokens, shared.value, frequent_from)
                # A key of very many documents is spread; its parts meet in the second step.
                salts = np.maximum(1, -(-weight // SALTED))
                salt = (np.uint64(node) % salts.astype(np.uint64)) * _ODD[2]
                part = (mixed(keys + salt) % np.uint64(parts)).astype(np.int64)
                kinds = kinds + 4 * (salts > 1)
                held.append(
                    (
                        keys,
                        np.full(len(keys), node, np.int64),
                        np.full(len(keys), len(tokens), np.int32),
                        kinds.astype(np.uint8),
                        places.astype(np.uint8),
                        part,
                    )
                )
                size += len(keys)
            if size >= HELD_ENTRIES:
                yield from batches_of(sent())
                held, size = [], 0
        if held:
            yield from batches_of(sent())

    return map_arrow(docs.select("text"), run, ENTRIES)


FOUND = "big boolean, key bigint, a bigint, b bigint, n bigint"


def candidates_of_part(table: pa.Table) -> pa.Table:
    """Pairs that share a key of one partition of the index, and how many. Keys with more than SMALL
    nodes are marked ``big``: they yield their nodes, with kind and number of tokens after the
    key in ``b`` and the size in ``n``."""

    def column(name, kind):
        return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])

    keys, nodes = column("keys", np.uint64), column("nodes", np.int64)
    sizes, kinds = column("sizes", np.int32).astype(np.int64), column("kinds", np.uint8)
    # Tokens of a document that come after the key's, at most.
    n = sizes
    length = np.minimum(n, n - -(-NUMERATOR * n // DENOMINATOR) + 2)
    after = n - 1 - column("places", np.uint8) * length // 256
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    order = order[first]
    keys, nodes, sizes, kinds = keys[first], nodes[first], sizes[order], kinds[order]
    after = after[order]
    _, at, count = np.unique(keys, return_index=True, return_counts=True)
    many = np.repeat(count, count)
    spread = (kinds & 4) > 0
    kinds = kinds & 3
    # Keys of one node, or of light nodes only, yield nothing.
    paired = np.repeat(np.add.reduceat(kinds != LIGHT, at), count) > 0 if len(at) else many > 1
    use = ((many > 1) & paired) | spread
    keys, nodes, sizes, kinds, after = keys[use], nodes[use], sizes[use], kinds[use], after[use]
    big = (many > SMALL)[use] | spread[use]
    pairs = []

    def note(i, j):
        fit = fits(sizes[i], sizes[j])
        ends = np.sort(np.stack([nodes[i[fit]], nodes[j[fit]]], 1), axis=1)
        pairs.append(np.unique(ends, axis=0, return_counts=True))

    few = np.flatnonzero(~big)
    for step in range(1, SMALL):
        same = np.flatnonzero(keys[few[step:]] == keys[few[:-step]]) if len(few) > step else []
        if not len(same):
            break
        note(few[same], few[same + step])
    large = np.flatnonzero(big)
    found = np.concatenate([np.zeros((0, 2), np.int64), *(p[0] for p in pairs)])
    shared = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in pairs)])
    return pa.table(
        {
            "big": np.repeat([False, True], [len(found), len(large)]),
            "key": np.concatenate([np.zeros(len(found), np.int64), keys[large].view(np.int64)]),
            "a": np.concatenate([found[:, 0], nodes[large]]),
            "b": np.concatenate([found[:, 1], kinds[large] + 4 * after[large]]),
            "n": np.concatenate([shared, sizes[large]]),
        }
    )


# ---------------------------------------------------------------------------
# Verification
# ---------------------------------------------------------------------------


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """node and tokens (packed) of the documents in ``ids`` (doc_id, node). A Bloom filter of fixed
    size spares most other texts the work and the shuffle."""
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BLOOM_BITS))
    masks = ids.select((place / 64).cast("int").alias("at"), (place % 64).cast("int").alias("bit"))
    masks = masks.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    bits = np.zeros(BLOOM_BITS // 64, np.int64)
    for r in masks.collect():  # BLOOM_BITS / 64 numbers at most
        bits[r["at"]] = r["mask"]
    shared = spark.sparkContext.broadcast(bits)

    def run(batches):
        own, bits = shingler(), shared.value
        for rows in batches:
            at = rows.column("place").to_numpy()
            kept = np.flatnonzero((bits[at >> 6] >> (at & 63)) & 1)
            texts = rows.column("text").take(pa.array(kept)).to_pylist()
            yield batch(
                doc_id=rows.column("doc_id").take(pa.array(kept)),
                tokens=pa.array([own.tokens(t).tobytes() for t in texts], pa.binary()),
            )

    wanted = map_arrow(docs.select("doc_id", "text", place.alias("place")), run, "doc_id bigint, tokens binary")
    return stored(wanted.join(ids, "doc_id").select("node", "tokens"), "token-sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar."""

    def run(batches):
        for rows in batches:
            kept, last, left = [], None, None
            columns = [rows.column(c) for c in ("a", "tokens_a", "tokens_b")]
            for i in range(rows.num_rows):
                if (a := columns[0][i].as_py()) != last:
                    last, left = a, np.frombuffer(columns[1][i].as_buffer(), np.uint64)
                right = np.frombuffer(columns[2][i].as_buffer(), np.uint64)
                if similar(left, right):
                    kept.append(i)
            taken = rows.take(pa.array(kept, pa.int64()))
            yield batch(a=taken.column("a"), b=taken.column("b"))

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b"))
    return map_arrow(pairs.join(left, "a").join(right, "b"), run, "a bigint, b bigint")


def labelled_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` of large keys with their component so far, of keys that have several."""
    labelled = members.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    keys = labelled.groupBy("key").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.max(F.col("kind") != LIGHT).alias("pairs"),
    )
    keys = keys.where("low <> high AND pairs").select("key")
    return stored(labelled.join(keys, "key", "left_semi"), "large-keys")


def pivot_pairs(labelled: DataFrame, used: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each large key, its nodes with one of them: the one that most large keys have, as a text
    with few changes is in most of its copies' keys. ``used`` are the pivots of earlier rounds."""
    free = labelled.join(used, "node", "left_anti")
    best = free.groupBy("key").agg(
        F.max(F.struct("degree", "node", F.col("n").alias("m"), "component")).alias("pivot")
    )
    both = labelled.join(best.select("key", "pivot.*").toDF("key", "d", "p", "m", "c"), "key")
    sizes = DENOMINATOR * F.least("n", "m") >= NUMERATOR * F.greatest("n", "m")
    pairs = both.where((F.col("component") != F.col("c")) & sizes)
    pairs = pairs.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"))
    pivots = best.select(F.col("pivot.node").alias("node"))
    return stored(pairs.distinct(), "pivot-pairs"), pivots.distinct()


def open_pairs(labelled: DataFrame) -> tuple[int, int]:
    """Members of large keys, and the pairs of a member and one outside its key's core."""
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("size"))
    keys = parts.groupBy("key").agg(F.sum("size").alias("members"), F.max("size").alias("core"))
    pairs = F.col("members").cast("decimal(38,0)") * (F.col("members") - F.col("core"))
    found = keys.agg(F.sum("members"), F.sum(pairs)).first()
    return found[0] or 0, int(found[1] or 0)


def unjoined_pairs(labelled: DataFrame) -> DataFrame:
    """Pairs of nodes of large keys that are still in different components.

    The component with most nodes of a key is its core; a pair has at least one node outside it.
    A pair is met at each large key that it shares, and taken at the first of these in the order of
    tokens only. There, what follows the key must suffice, and with all that they share else, the
    two must have enough keys in common. Nodes bring the list of their keys along for that, unless
    it is very long; pairs of such nodes are taken at every key at which what follows suffices.
    """
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("size"))
    core = F.max(F.struct("size", "component"))["component"].alias("core")
    # A combination comes before its first token alone.
    ordered = F.sort_array(F.collect_list(F.struct(-F.col("after"), -F.col("kind"), "key")))
    keys = F.transform(ordered, lambda x: x["key"])
    lists = labelled.groupBy("node").agg(F.when(F.count("*") <= LISTED, keys).alias("keys"))
    open_ = labelled.join(parts.groupBy("key").agg(core), "key").join(lists, "node")
    open_ = stored(open_, "open-members")
    mine = ["node", "n", "kind", "after", "component", "degree", "keys"]
    outside = open_.where("component <> core").select(
        "key", *(F.col(c).alias(f"o_{c}") for c in mine)
    )
    once = (F.col("component") == F.col("core")) | (F.col("node") < F.col("o_node"))
    sizes = DENOMINATOR * F.least("n", "o_n") >= NUMERATOR * F.greatest("n", "o_n")
    needed = F.ceil(NUMERATOR * (F.col("n") + F.col("o_n")) / (NUMERATOR + DENOMINATOR))
    enough = 1 + F.least("after", "o_after") >= needed
    kinds = (F.col("kind") != LIGHT) | (F.col("o_kind") != LIGHT)
    shared = F.array_intersect("keys", "o_keys")
    others = F.least(_others("n", "degree"), _others("o_n", "o_degree"))
    many = F.size(shared) + others >= least_common(F.col("n"), F.col("o_n")) - FEW
    listed = F.col("keys").isNotNull() & F.col("o_keys").isNotNull()
    first = ~listed | ((F.get(shared, F.lit(0)) == F.col("key")) & many)
    both = open_.join(outside, "key").where(
        (F.col("component") != F.col("o_component")) & once & sizes & enough & kinds & first
    )
    ends = F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")
    return both.select(*ends).distinct()


def _others(n: str, degree: str) -> Column:
    """Prefix tokens of a node that are no large key, at most."""
    size = F.col(n)
    whole = F.least(size, size - F.ceil(NUMERATOR * size / DENOMINATOR) + 2)
    return F.greatest(whole - F.col(degree), F.lit(0))


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links reach) of every document.

    Null and empty texts have no shingles and are alone, as are rows without doc_id. Rows with
    one doc_id are one place in a component. An empty table gives no rows; columns besides
    doc_id and text are not read.
    """
    with intermediates(docs.sparkSession):
        return outcome(_joined(docs), "document-components")


def _joined(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    summary = stored(summarised(docs), "shingle-sets")
    sets = summary.where("block IS NULL").select("doc_id", "node", "n")
    counts = token_counts(summary)
    nodes = sets.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
    nodes = stored(nodes.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "nodes")

    entries = int(counts.sum()) * (DENOMINATOR - NUMERATOR) // DENOMINATOR
    parts = max(8, -(-entries // PARTITION_ENTRIES))
    index = packed_index(docs.where("doc_id IS NOT NULL"), counts, parts)
    found = stored(index.groupBy("part").applyInArrow(candidates_of_part, FOUND), "candidates")
    free_shuffles(spark)
    large = found.where("big").select(
        "key",
        F.col("a").alias("node"),
        "n",
        (F.col("b") % 4).alias("kind"),
        F.floor(F.col("b") / 4).alias("after"),
    )
    degree = F.count_if(F.col("kind") != PAIR).alias("degree")
    degrees = stored(large.groupBy("node").agg(degree), "degrees")
    large = stored(large.join(degrees, "node"), "large-members")

    # Pairs of small keys, unless they share too few, even with all large keys of either.
    counted = found.where("NOT big").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    described = nodes.select("node", "n").join(degrees, "node", "left").select(
        "node", "n", F.coalesce("degree", F.lit(0)).alias("degree")
    )
    for end in "ab":
        counted = counted.join(described.toDF(end, f"n_{end}", f"degree_{end}"), end)
    least = least_common(F.col("n_a"), F.col("n_b")) - FEW
    most = F.col("shared") + F.least("degree_a", "degree_b")
    pairs = stored(counted.where(most >= least).select("a", "b"), "pairs")
    # Stored tables go once nothing reads them any more.
    for done in (found, degrees):
        discard(done)

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(large.select("node"))
    ids = stored(nodes.join(wanted.distinct(), "node", "left_semi"), "wanted")
    tokens = sets_of(docs, ids.select("doc_id", "node"))
    discard(ids)
    free_shuffles(spark)
    links = stored(verified(pairs, tokens), "links")
    discard(pairs)
    free_shuffles(spark)
    joined = components(links)
    used, last, labelled = None, None, None
    while True:
        before, labelled = labelled, labelled_members(large, joined)
        if before is not None:
            discard(before)
        members, left = open_pairs(labelled)
        if left <= OPEN_PAIRS * members or last and left > (1 - LEAST_GAIN) * last:
            break
        last = left
        pairs, pivots = pivot_pairs(labelled, used or spark.createDataFrame([], "node bigint"))
        before, used = used, stored((pivots if used is None else used.unionByName(pivots)).distinct(), "pivots")
        if before is not None:
            discard(before)
        before, links = links, stored(links.unionByName(verified(pairs, tokens)), "links")
        for done in (before, pairs):
            discard(done)
        joined = components(links)
        free_shuffles(spark)
    more = stored(unjoined_pairs(labelled), "more-pairs")
    for done in (labelled, large, *([used] if used is not None else [])):
        discard(done)
    if not more.isEmpty():
        extra = stored(verified(more, tokens), "more-links")
        joined = components(links.unionByName(extra))
        discard(extra)
    for done in (more, tokens, links):
        discard(done)
    # Nodes are named by their smallest document; a component by that of all its nodes.
    named = joined.join(nodes.select("node", "doc_id"), "node")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = joined.join(smallest, "component").select("node", "component_id")
    own = nodes.select("node", F.col("doc_id").alias("own")).join(named, "node", "left")
    own = own.select("node", F.coalesce("component_id", "own").alias("component_id"))
    return sets.join(own, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
