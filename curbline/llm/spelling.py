"""Grouping of spelling variants: words one edit apart, each led to its most frequent form.

Near words are found by pivotal grams. The bigrams of a word are ordered by rarity. Its prefix are
its three rarest, with all their occurrences; among any three bigrams two don't overlap, and one
edit spoils one of those two at most. A dynamic programme takes the two disjoint bigrams of the
prefix that are rarest together: the pivots. If words are near, the one whose prefix ends first in
the order of bigrams has a pivot in the prefix of the other, shifted by one place at most. So only
prefixes are indexed, by bigram, place and length of the word, and only pivots search in them. A
pair that meets is verified by its edit distance.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = 26 + 64
LEAST_LENGTH, LEAST_COUNT = 6, 5
# A word is a variant of one that occurs so many times as often.
TIMES = 5
# One occurrence in so many loses a letter; 0: none.
NOISE = 199
GRAM, EDITS = 2, 1
PREFIX = GRAM * EDITS + 1
# How place and length can change from a word to a near one: replaced, inserted, deleted.
SHIFTS = ((0, 0), (0, 1), (1, 1), (0, -1), (-1, -1))
# Words of up to so many letters travel with their keys.
CARRIED = 64
HELD_WORDS = 300_000
# Forms grow by TIMES at each step, so a chain of them is short and so is its doubling.
MOST_ROUNDS = 12


def runs_of(doc_id: int | None, text: str | None, noise: int = NOISE) -> Counter:
    """Words of a text and how often they occur, those with a letter taken out among them.

    A letter goes where ``noise`` divides the CRC-32 of ``<doc_id>:<run>``; never without doc_id.
    """
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found = Counter(x for x in RUN.findall(lowered) if len(x) >= LEAST_LENGTH)
    if doc_id is None or not noise:
        return found
    start = crc32(f"{doc_id}:".encode())
    # Each occurrence loses a letter once: what a run becomes is not looked at again.
    kept: Counter = Counter()
    for run, n in found.items():
        h = crc32(run.encode(), start)
        if h % noise == 0:
            at = h % len(run)
            if len(run) > LEAST_LENGTH:
                kept[run[:at] + run[at + 1 :]] += n
        else:
            kept[run] += n
    return kept


def word_counts(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """word and n of the words that occur LEAST_COUNT times or more in all texts."""

    def rows(counts: Counter):
        return batch(
            word=pa.array(counts.keys(), pa.string()), n=pa.array(counts.values(), pa.int64())
        )

    def count(batches):
        counts: Counter = Counter()
        for part in batches:
            ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
            for doc_id, text in zip(ids, texts, strict=True):
                counts.update(runs_of(doc_id, text, noise))
            if len(counts) >= HELD_WORDS:
                yield rows(counts)
                counts.clear()
        yield rows(counts)

    found = map_arrow(
        docs.select(F.col("doc_id").cast("bigint"), "text"), count, "word string, n long"
    )
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Place in the order of rarity, and number, of every bigram: at most LETTERS ** 2."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, GRAM))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n")).collect()
    ranked = sorted((r["n"], r["gram"]) for r in counted)
    return {gram: (i, n) for i, (n, gram) in enumerate(ranked)}


def rarest_disjoint(grams: list[tuple[int, int]]) -> list[int]:
    """Of (place, weight) in the order of places, the places of EDITS + 1 that don't overlap and
    weigh least together."""
    # best[k]: for each number of grams looked at, the least weight of k disjoint ones, and which.
    best = [[(0, ())] * (len(grams) + 1)]
    for _ in range(EDITS + 1):
        row: list[tuple[float, tuple]] = [(float("inf"), ())]
        for j, (place, weight) in enumerate(grams):
            before = j
            while before and grams[before - 1][0] > place - GRAM:
                before -= 1
            total, chosen = best[-1][before]
            row.append(min(row[-1], (total + weight, (*chosen, place))))
        best.append(row)
    return list(best[-1][-1][1])


def signature(word: str, ranks: dict[str, tuple[int, int]]):
    """Rank at which the prefix ends, its (rank, place) and the (rank, place) of the pivots."""
    grams = [(ranks[word[i : i + GRAM]], i) for i in range(len(word) - GRAM + 1)]
    last = sorted(rank for (rank, _), _ in grams)[PREFIX - 1]
    prefix = [(rank, n, i) for (rank, n), i in grams if rank <= last]
    rank_at = {i: rank for rank, _, i in prefix}
    pivots = rarest_disjoint([(i, n) for _, n, i in prefix])
    return last, [(rank, i) for rank, _, i in prefix], [(rank_at[i], i) for i in pivots]


def key(rank: int, place: int, length: int) -> int:
    return (rank << 24 | place) << 24 | length


def indexed(words: DataFrame, ranks: dict[str, tuple[int, int]], pivots: bool) -> DataFrame:
    """key, id, n, last and word: of prefixes, or of pivots at every place and length that a near word
    can have them. Very long words stay behind; their many keys have the id only."""

    def run(batches):
        for rows in batches:
            keys, at, lasts = [], [], []
            for k, word in enumerate(rows.column("word").to_pylist()):
                last, prefix, chosen = signature(word, ranks)
                if pivots:
                    own = [
                        key(rank, place + d, len(word) + e)
                        for rank, place in chosen
                        for d, e in SHIFTS
                        if place + d >= 0
                    ]
                else:
                    own = [key(rank, place, len(word)) for rank, place in prefix]
                keys += own
                at += [k] * len(own)
                lasts += [last] * len(own)
            taken = pa.array(at, pa.int64())
            yield batch(
                key=pa.array(keys, pa.int64()),
                id=rows.column("id").take(taken),
                n=rows.column("n").take(taken),
                last=pa.array(lasts, pa.int32()),
                word=rows.column("carried").take(taken),
            )

    carried = F.when(F.length("word") <= CARRIED, F.col("word")).alias("carried")
    own = words.select("word", F.xxhash64("word").alias("id"), "n", carried)
    return map_arrow(own, run, "key long, id long, n long, last int, word string")


def near_pairs(words: DataFrame) -> DataFrame:
    """a < b, a_n and b_n of the words that differ by exactly one letter put in, out or in place."""
    ranks = gram_ranks(words)
    index, search = (indexed(words, ranks, p) for p in (False, True))
    index = index.select("key", *(F.col(c).alias(f"other_{c}") for c in ("id", "n", "last", "word")))
    near = F.levenshtein("word", "other_word", EDITS) == EDITS
    met = search.join(index, "key").where(
        (F.col("last") <= F.col("other_last"))
        & ~((F.col("id") == F.col("other_id")) & F.col("word").eqNullSafe(F.col("other_word")))
        & F.coalesce(near, F.lit(True))
    )
    met = stored(met.drop("key", "last", "other_last").distinct(), "near-words")
    texts = words.where(F.length("word") >= CARRIED).select(F.xxhash64("word").alias("id"), F.col("word").alias("text"))
    others = texts.select(F.col("id").alias("other_id"), F.col("text").alias("other_text"))
    # The ids of long words lead to their texts, which are compared like the others.
    unsure = met.where("word IS NULL OR other_word IS NULL").drop("word", "other_word")
    unsure = unsure.join(texts, "id").join(others, "other_id").select(
        "id", "n", "other_id", "other_n", F.col("text").alias("word"), F.col("other_text").alias("other_word")
    )
    sure = met.where("word IS NOT NULL AND other_word IS NOT NULL")
    found = sure.unionByName(unsure.where(near))
    own, other = F.struct("word", "n"), F.struct(F.col("other_word").alias("word"), F.col("other_n").alias("n"))
    pair = found.select(F.least(own, other).alias("x"), F.greatest(own, other).alias("y")).distinct()
    return pair.select(
        F.col("x.word").alias("a"), F.col("x.n").alias("a_n"), F.col("y.word").alias("b"), F.col("y.n").alias("b_n")
    )


def forms(pairs: DataFrame) -> DataFrame:
    """word, n_near, form and form_n of every word with a near one."""
    links = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
            )
        )
    )
    # Strings are ordered by their bytes, which is the order of code points.
    first = F.min(F.struct(-F.col("near_n"), F.col("near").alias("form"), F.col("near_n").alias("form_n")))
    found = links.groupBy("word", "n").agg(F.count("*").alias("n_near"), first.alias("first"))
    enough = F.col("first.form_n") >= TIMES * F.col("n")
    return found.select(
        "word",
        "n_near",
        F.when(enough, F.col("first.form")).alias("form"),
        F.when(enough, F.col("first.form_n")).alias("form_n"),
    )


def roots(found: DataFrame) -> DataFrame:
    """word and root of the words that have a form: pointers doubled until none moves."""
    pointers = stored(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    for _ in range(MOST_ROUNDS):
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = pointers.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(moved, "roots")
        pointers = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return pointers
    raise RuntimeError(f"forms form a chain of more than 2 ** {MOST_ROUNDS} words")


def variants(docs: DataFrame, noise: int = NOISE) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of all texts of ``docs``.

    Words are runs of letters with A-Z in lower case, of at least LEAST_LENGTH letters and LEAST_COUNT
    occurrences. Null and empty texts have none; repeated rows count each; rows without doc_id lose no
    letters to ``noise``. A text may be one word of any length. An empty table gives no rows.
    """
    words = stored(word_counts(docs, noise), "spelling-words")
    found = stored(forms(near_pairs(words)), "spelling-forms")
    ends = roots(found)
    return (
        words.join(found, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            "form_n",
        )
    )
