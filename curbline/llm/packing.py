"""Mixture-controlled packing of documents into windows of a fixed number of tokens.

Every source has a queue of tokens. A deficit round robin fills each window: a source's
credit grows by its share of the window, it gives as many whole tokens as it has credit
for, and what the shares leave open goes to the largest credits, which may turn negative.
Credits are carried from window to window. Shares are multiples of 2**-20, so all credits
are zero again after a fixed number of windows; the schedule of that many windows is
computed once, and the place of any token of a queue follows from its position by
arithmetic. So the round robin needs no pass over the windows, and it runs across all
partitions: a document needs only the number of tokens that its queue has before it.

When a queue runs dry its share goes to the others and a new schedule begins. Documents are
cut wherever a window ends; only the last window can be padded.

Sources without a queue of their own in that schedule are any number. They are the leaves of
a binary tree and give their tokens in rounds of the size that all of them have in a window: of
the first p tokens below a node, floor(p * left / all) come from its left side. So every source
keeps its proportion of each round, to a token for a level of the tree, and the place of a token
follows from the sizes along its path.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, stored
from curbline.llm.vocabularies import vocabulary

BYTE_BPE = "byte_bpe_50k"
WINDOW = 2048
END = 1
# Shares of the mixture are multiples of 1 / (PERIOD * WINDOW).
PERIOD = 512
# Queues of the schedule when there are no target shares: the largest sources, and the tree of the rest.
QUEUES = 64
# Sources, in bits, whose part of the tree one task makes.
CHUNK_BITS = 12
MEMORY = 120_000


class ByteTokenizer:
    """Ids of the byte-level BPE. Words are remembered; a text is cut at single spaces, which
    no token crosses to the left, unless white space stands before one."""

    def __init__(self, folder: str | None):
        import tiktoken
        from tokenizers import Tokenizer

        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        with open(vocabulary(f"{BYTE_BPE}.tiktoken", folder), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.coder = tiktoken.Encoding(
            BYTE_BPE, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        library = Tokenizer.from_file(vocabulary(f"{BYTE_BPE}.json", folder))
        # Special tokens in a text are single ids, as the library has it by default.
        self.special = {
            t.content: i for i, t in library.get_added_tokens_decoder().items() if t.special
        }
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.coder.encode_ordinary(text), "<u2").tobytes()

    def _word(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self._ids(f" {word}")
        if len(word) < 64:
            if len(self.new) >= MEMORY:
                self.old, self.new = self.new, {}
            self.new[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 16-bit numbers."""
        for special, i in self.special.items():
            if special in text:
                mark = np.asarray([i], "<u2").tobytes()
                return mark.join(map(self.encode, text.split(special)))
        first, *rest = text.split(" ")
        for part in (first, *rest[:-1]):
            if not part or part[-1].isspace():
                if part or text[:1] != " " or "  " in text:
                    return self._ids(text)
        get, word = self.new.get, self._word
        return self._ids(first) + b"".join([get(w) or word(w) for w in rest])


@lru_cache(maxsize=1)
def byte_tokenizer(folder: str | None) -> ByteTokenizer:
    return ByteTokenizer(folder)


# ---------------------------------------------------------------------------
# The schedule
# ---------------------------------------------------------------------------


def whole_units(shares: list[float], units: int) -> list[int]:
    """Shares as whole units that add up; a positive share gets one at least."""
    if sum(s > 0 for s in shares) > units:
        raise ValueError(f"more than {units} sources with a target share")
    total = sum(shares)
    exact = [s / total * units for s in shares]
    out = [max(1, int(x)) if x > 0 else 0 for x in exact]
    order = sorted(range(len(out)), key=lambda i: (int(exact[i]) - exact[i], i))
    i = 0
    while (left := units - sum(out)) != 0:
        k = order[i % len(order)] if left > 0 else max(range(len(out)), key=out.__getitem__)
        if exact[k] > 0:
            out[k] += 1 if left > 0 else left if out[k] + left >= 1 else -1
        i += 1
    return out


@lru_cache(maxsize=QUEUES + 1)
def round_robin(units: tuple[int, ...], window: int, period: int) -> np.ndarray:
    """Tokens that each queue has given before window 0, 1, ..., ``period``."""
    credit = np.zeros(len(units), np.int64)
    given = np.zeros((period + 1, len(units)), np.int64)
    each = np.asarray(units, np.int64)
    for k in range(period):
        credit += each
        take = credit // period
        credit -= take * period
        extra = np.lexsort((np.arange(len(units)), -credit))[: window - int(take.sum())]
        take[extra] += 1
        credit[extra] -= period
        given[k + 1] = given[k] + take
    return given


@dataclass(frozen=True, eq=False)
class Segment:
    """Windows in a row with one schedule; ``before`` is what each queue has given so far."""

    first: int
    windows: int
    before: tuple[int, ...]
    units: tuple[int, ...] | None  # None: one window that takes ``take``
    take: tuple[int, ...] = ()

    def given(self, window: int, period: int) -> np.ndarray:
        if self.units is None:
            return np.asarray([[0] * len(self.take), self.take], np.int64)
        return round_robin(self.units, window, period)


def schedule(
    totals: list[int], shares: list[float], window: int = WINDOW, period: int = PERIOD
) -> list[Segment]:
    """Segments that empty all queues. At most two for each queue that runs dry."""
    left, at, out = np.asarray(totals, np.int64), 0, []
    start = left.copy()
    while left.sum() > 0:
        wanted = [s if n > 0 else 0.0 for s, n in zip(shares, left, strict=True)]
        if sum(wanted) <= 0:
            wanted = [float(n) for n in left]
        units = tuple(whole_units(wanted, window * period))
        given = round_robin(units, window, period)
        runs = [
            int(n) // u * period + int(np.searchsorted(given[:, i], int(n) % u, "right")) - 1
            for i, (n, u) in enumerate(zip(left, units, strict=True))
            if u
        ]
        if (n := min(runs)) > 0:
            out.append(Segment(at, n, tuple(map(int, start - left)), units))
            left = left - (n // period * given[period] + given[n % period])
            at += n
        if left.sum() == 0:
            break
        k = n % period
        take = np.minimum(given[k + 1] - given[k], left)
        while (open_ := min(window - int(take.sum()), int((left - take).sum()))) > 0:
            most = np.where(left - take > 0, np.asarray(units) + 1, 0)
            i = int(most.argmax())
            take[i] += min(open_, int(left[i] - take[i]))
        out.append(Segment(at, 1, tuple(map(int, start - left)), None, tuple(map(int, take))))
        left = left - take
        at += 1
    return out


def pieces_of(
    segments: list[Segment], queue: int, start: int, stop: int, window: int, period: int
) -> Iterator[tuple[int, int, int]]:
    """(window, offset in it, length) of each piece of a queue's tokens ``start`` to ``stop``."""
    begins = _begins(tuple(segments), queue)
    while start < stop:
        s = segments[bisect_right(begins, start) - 1]
        given, offsets, own = _tables(s, queue, window, period)
        at = start - s.before[queue]
        rounds, at = divmod(at, own[-1]) if s.units else (0, at)
        k = bisect_right(own, at) - 1
        used = at - own[k]
        n = min(own[k + 1] - at, stop - start)
        yield s.first + rounds * (len(own) - 1) + k, offsets[k] + used, n
        start += n


@lru_cache(maxsize=16 * QUEUES)
def _begins(segments: tuple[Segment, ...], queue: int) -> list[int]:
    return [s.before[queue] for s in segments]


@lru_cache(maxsize=16 * QUEUES)
def _tables(s: Segment, queue: int, window: int, period: int):
    given = s.given(window, period)
    return given, np.diff(given, axis=0)[:, :queue].sum(1).tolist(), given[:, queue].tolist()


# ---------------------------------------------------------------------------
# The tree
# ---------------------------------------------------------------------------


def tree_paths(sizes: list[int]) -> list[list[int]]:
    """For each leaf, from the root down: the tokens on the left of a node, negative where the path
    goes right, and all tokens of the node."""
    ends = [0, *accumulate(sizes)]
    out: list[list[int]] = [[] for _ in sizes]
    nodes = [(0, len(sizes))]
    while nodes:
        low, high = nodes.pop()
        if high - low > 1:
            mid = (low + high) // 2
            left, both = ends[mid] - ends[low], ends[high] - ends[low]
            for i in range(low, high):
                out[i] += [left if i < mid else -left, both]
            nodes += [(low, mid), (mid, high)]
    return out


def given_by(path: list[int], p: int) -> tuple[int, int]:
    """Of the first ``p`` tokens of the tree: those of leaves further left, and those of this leaf."""
    before = 0
    for left, both in zip(path[::2], path[1::2], strict=True):
        if left > 0:
            p = p * left // both
        else:
            other = p * -left // both
            before += other
            p -= other
    return before, p


def tree_pieces(
    path: list[int], total: int, size: int, start: int, stop: int
) -> Iterator[tuple[int, int]]:
    """(position among all tokens of the tree, length) of each piece of a leaf's tokens ``start`` to
    ``stop``. Rounds are ``size`` tokens; in a round the leaves stand from left to right."""
    if not path:
        yield start, stop - start
        return
    own, rounds = given_by(path, total)[1], -(-total // size)
    # A leaf is within a token for each level of its exact proportion.
    slack = len(path) // 2 + 1
    k, after = -1, (0, 0)
    while start < stop:
        if k >= 0 and k + 1 < rounds:
            k, now = k + 1, after
            after = given_by(path, min((k + 1) * size, total))
        if k < 0 or not now[1] <= start < after[1]:
            low = max(0, (start - slack) * total // (own * size) - 1)
            high = min(rounds, (start + 1 + slack) * total // (own * size) + 2)
            k = low - 1 + bisect_right(
                range(low, high), start, key=lambda r: given_by(path, r * size)[1]
            )
            now, after = given_by(path, k * size), given_by(path, min((k + 1) * size, total))
        n = min(after[1], stop) - start
        yield k * size + after[0] - now[0] + start - now[1], n
        start += n


def source_paths(sizes: DataFrame) -> DataFrame:
    """queue and path of each source (queue, n) in one tree. The driver sees one total for each
    2**CHUNK_BITS sources."""
    chunk = F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS).alias("chunk")
    sizes = stored(sizes.select("queue", "n", chunk), "small-sources")
    totals = sizes.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy("chunk").collect()
    upper = tree_paths([r["n"] for r in totals])
    upper = {r["chunk"]: path for r, path in zip(totals, upper, strict=True)}

    def run(batches):
        for rows in batches:
            for chunk, own in zip(*(rows.column(c).to_pylist() for c in ("chunk", "own")), strict=True):
                paths = tree_paths([x["n"] for x in own])
                yield batch(
                    queue=pa.array([x["queue"] for x in own], pa.string()),
                    path=pa.array([upper[chunk] + x for x in paths], pa.list_(pa.int64())),
                )

    own = F.sort_array(F.collect_list(F.struct("queue", "n"))).alias("own")
    return map_arrow(sizes.groupBy("chunk").agg(own), run, "queue string, path array<bigint>")


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------

TOKENS = "doc_id bigint, queue string, part int, local bigint, n bigint, ids binary"
PIECES = """doc_id bigint, source string, start bigint, length bigint, ids binary,
  doc_tokens bigint, sequence_id bigint, offset bigint"""


def tokenized(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Ids of every document with END after them, its scan task, and the tokens of its source
    before it in that task. Stored: the tokens are computed once, and the tasks that use
    them see one numbering."""

    def run(batches):
        coder, part = byte_tokenizer(folder), TaskContext.get().partitionId()
        before: dict[str, int] = {}
        end = np.asarray([END], "<u2").tobytes()
        for rows in batches:
            ids = [coder.encode(t or "") + end for t in rows.column("text").to_pylist()]
            counts = [len(x) // 2 for x in ids]
            queues = rows.column("queue").to_pylist()
            local = []
            for q, n in zip(queues, counts, strict=True):
                local.append(before.get(q, 0))
                before[q] = local[-1] + n
            yield batch(
                doc_id=rows.column("doc_id"),
                queue=rows.column("queue"),
                part=pa.array([part] * len(ids), pa.int32()),
                local=pa.array(local, pa.int64()),
                n=pa.array(counts, pa.int64()),
                ids=pa.array(ids, pa.binary()),
            )

    queue = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("queue")
    return stored(
        map_arrow(docs.select(F.col("doc_id").cast("bigint"), "text", queue), run, TOKENS), "tokens"
    )


def pack(
    docs: DataFrame,
    shares: Mapping[str, float] | None = None,
    window: int = WINDOW,
    folder: str | None = None,
) -> DataFrame:
    """Pieces of all documents: which tokens (``ids``, 32-bit little-endian), from where in the
    document, and where in which sequence.

    ``shares`` are the target proportions by source (a null source is ""). Each source in it has a
    queue with its target; the others come when those are empty, in proportion to their tokens.
    Without ``shares``, each source has its share of all tokens, so that the mixture holds to the
    last window. Null and empty texts are the END id alone. Repeated rows are packed as often as
    they come. An empty table gives no pieces.
    """
    spark = docs.sparkSession
    tokens = tokenized(docs, folder)
    sizes = tokens.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    sizes = stored(sizes, "queue-sizes")
    by_source = sizes.groupBy("queue").agg(F.sum("n").alias("n"))
    first = by_source.orderBy(F.desc("n"), "queue")
    if shares is None:
        first = first.limit(QUEUES - 1).collect()
    else:
        first = first.where(F.col("queue").isin([q for q, s in shares.items() if s > 0])).collect()
    names = [r["queue"] for r in first]
    totals = [r["n"] for r in first]
    everything = sizes.agg(F.sum("n")).first()[0] or 0
    rest = everything - sum(totals)
    if rest:
        totals.append(rest)
    if shares is None:
        target = [float(n) for n in totals]
        size = max(1, window * rest // max(1, everything))
    else:
        target = [float(shares[name]) for name in names] + [0.0] * bool(rest)
        size = window
    plan = schedule(totals, target, window)

    # A small array of names; sources without a place in it are leaves of the tree.
    place = F.array_position(F.array(*map(F.lit, names)), F.col("queue")) if names else F.lit(0)
    place = F.when(place > 0, place - 1).otherwise(len(names)).cast("int")
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    bases = sizes.select("queue", "part", place.alias("place"), base)
    if rest:
        paths = source_paths(by_source.where(~F.col("queue").isin(names)))
        bases = bases.join(paths, "queue", "left")
    else:
        bases = bases.withColumn("path", F.lit(None).cast("array<bigint>"))
    bases = stored(bases, "queue-bases")
    placed = tokens.join(bases, ["queue", "part"]).select(
        "doc_id",
        F.when(F.col("queue") != "", F.col("queue")).alias("source"),
        "place",
        "path",
        (F.col("base") + F.col("local")).alias("begin"),
        "n",
        "ids",
    )

    def places(queue: int, path: list[int] | None, start: int, stop: int):
        if path is None:
            yield from pieces_of(plan, queue, start, stop, window, PERIOD)
        else:
            for at, length in tree_pieces(path, rest, size, start, stop):
                yield from pieces_of(plan, queue, at, at + length, window, PERIOD)

    def run(batches):
        for rows in batches:
            out: list[tuple] = []
            names = ("doc_id", "source", "place", "path", "begin", "n", "ids")
            for row in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
                doc_id, source, queue, path, begin, n, ids = row
                ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                done = 0
                for sequence, offset, length in places(queue, path, begin, begin + n):
                    own = ids[4 * done : 4 * (done + length)]
                    out.append((doc_id, source, done, length, own, n, sequence, offset))
                    done += length
            for i in range(0, len(out), 20_000):
                columns = list(zip(*out[i : i + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, PIECE_TYPES, strict=True)], PIECE_NAMES
                )

    return map_arrow(placed, run, PIECES) if plan else spark.createDataFrame([], PIECES)


PIECE_NAMES = [c.split()[0] for c in PIECES.split(",")]
PIECE_TYPES = [
    {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]
    for c in PIECES.split(",")
]
