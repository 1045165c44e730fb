"""Small corpora for the tests, and brute-force versions of what operators compute."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, first=0):
    rows = [
        (first + i, t, "en" if i % 2 else "fr", f"src{i % 3}", len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    """The same table with columns named like those that operators make."""
    names = ["node", "n", "part", "queue", "place", "key", "line_no", "_removed_of", "component"]
    names += ["words", "lines", "held_out", "score", "label", "ids", "grp", "n_words", "local"]
    return docs.select("*", *(F.lit(7).alias(name) for name in names))


def odd_texts():
    """Nulls, empty and blank texts, one word, a very long word and text, ties and repeats."""
    long_text = " ".join(f"w{i % 700}" for i in range(9000))
    return [
        None,
        "",
        " \n\t ",
        "word",
        "one two",
        "x" * 30_000,
        long_text,
        long_text,
        "same text twice over here now",
        "same text twice over here now",
        "Größe ñandú 日本語 \U0001f600 <|endoftext|>",
        "a b c\u0085d",
    ]


def near_copies(seed=1, groups=3, copies=40, length=60, edits=2):
    """Texts of invented words: groups of copies with a few words changed, and loners."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "el", "or", "ist", "ung", "ar")]
    vocabulary += [f"{a}{b}" for a in vocabulary[:20] for b in vocabulary[:20]]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(length)] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(length)) for _ in range(30)]
    rng.shuffle(texts)
    return texts


def shingles(text):
    own = (text or "").encode().lower().split()
    if not own:
        return set()
    if len(own) < 5:
        return {tuple(own)}
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def smallest_reachable(ids, linked):
    """For each place, the smallest id that links reach."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    least = {}
    for i, own in enumerate(ids):
        least[root(i)] = min(own, least.get(root(i), own))
    return [least[root(i)] for i in range(len(ids))]
