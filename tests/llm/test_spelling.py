"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from curbline.llm import queries, spelling
from tests.llm.corpora import SCHEMA, clashing, frame, odd_texts


def one_edit(a, b):
    """By definition: one letter replaced, put in or taken out."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, noise=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % noise == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if c >= 5 and len(w) >= 6}
    short = sorted(n, key=len)
    near = {w: [] for w in n}
    for i, a in enumerate(short):
        for b in short[i + 1 :]:
            if len(b) > len(a) + 1:
                break
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), c, len(near[w]), n.get(form.get(w))) for w, c in n.items())


def rows_of(frame_):
    return sorted(tuple(r) for r in frame_.collect())


def misspelt(seed, roots=12, letters="abcdeé"):
    """Words of few letters, so that bigrams repeat, and their variants in several steps."""
    rng = random.Random(seed)
    out = []
    for _ in range(roots):
        word, n = "".join(rng.choice(letters) for _ in range(rng.randint(6, 12))), 800
        while n >= 1:
            out += [word] * n
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            letter = rng.choice(letters)
            word = word[:at] + (letter if kind else "") + word[at + (kind != 2) :]
            n //= rng.choice((2, 5, 6))
    rng.shuffle(out)
    return [" ".join(out[i : i + 40]) for i in range(0, len(out), 40)]


@pytest.mark.parametrize("seed", range(3))
def test_variants_equal_all_pairs(spark, seed):
    texts = misspelt(seed)
    docs = clashing(frame(spark, texts)).repartition(3)
    found = rows_of(spelling.variants(docs))
    assert found == by_hand(enumerate(texts))
    assert sum(r[1] is not None for r in found) > 5
    assert any(r[1] != r[2] for r in found if r[1]) or seed


def test_odd_texts_and_repeated_letters(spark):
    texts = [*odd_texts(), *["x" * 30_000] * 5, *[f"{'y' * 30_000} {'y' * 30_001}"] * 6, *["ÀÉîõüÿ Straße×÷ ſtraße"] * 9]
    texts += ["aaaaaa aaaaaaa aaaaab abaaaa"] * 7
    found = rows_of(spelling.variants(frame(spark, texts)))
    assert found == by_hand(enumerate(texts))
    assert {"x" * 30_000, "y" * 30_000, "y" * 30_001} <= {r[0] for r in found}


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "variants of words"), (7, "variants of words")] * 4
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert rows_of(spelling.variants(docs)) == by_hand(rows)
    assert rows_of(spelling.variants(docs.limit(0))) == []


def test_noise_takes_letters_out():
    texts = [(i, "letters vanish sometimes") for i in range(600)]
    own = Counter()
    for doc_id, text in texts:
        own.update(spelling.runs_of(doc_id, text))
    assert sum(own.values()) < 1800 and own["letters"] < 600
    assert {w: n for w, n in own.items() if n >= 5} == {r[0]: r[3] for r in by_hand(texts)}
    assert spelling.runs_of(1, "letters", noise=0) == Counter(letters=1)


def test_a_shortened_run_loses_no_second_letter():
    """In document 588 both runs lose a letter; "letterso" becomes "letters", which stays whole."""
    rows = [(588, "letterso letters " * 5)]
    assert spelling.runs_of(*rows[0]) == Counter(letters=5, lettrs=5)
    assert {r[0]: r[3] for r in by_hand(rows)} == {"letters": 5, "lettrs": 5}


@pytest.mark.parametrize("seed", range(30))
def test_pivots_are_the_rarest_disjoint_pair(seed):
    rng = random.Random(seed)
    places = sorted(rng.sample(range(12), rng.randint(3, 9)))
    grams = [(i, rng.randint(1, 9)) for i in places]
    pairs = [(a[1] + b[1], (a[0], b[0])) for i, a in enumerate(grams) for b in grams[i + 1 :] if b[0] - a[0] >= 2]
    chosen = spelling.rarest_disjoint(grams)
    assert sum(dict(grams)[i] for i in chosen) == min(pairs)[0] and chosen[1] - chosen[0] >= 2


def test_pivots_search_a_small_part_of_the_pairs(spark):
    """What meets in the index is far less than all pairs of words."""
    rng = random.Random(9)
    made = {"".join(rng.choice("abcdefghijklmnopqrst") for _ in range(8)) for _ in range(2000)}
    words = spark.createDataFrame([(w, 5) for w in sorted(made)], "word string, n long")
    ranks = spelling.gram_ranks(words)
    index, search = (spelling.indexed(words, ranks, p).select("key") for p in (False, True))
    assert search.join(index, "key").count() < len(made) ** 2 / 200


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op12_spelling_variants(spark, folder)) == by_hand(docs)
