"""Alignment of two tokenizers against the libraries, pair by pair."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, pre_tokenizers

from curbline.llm import alignment, queries
from curbline.llm.perfect_hash import PerfectHash
from curbline.llm.vocabularies import vocabulary
from tests.llm.corpora import SCHEMA, clashing, frame, near_copies, odd_texts


def byte_alphabet():
    """Characters that the byte-level library writes for bytes."""
    alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in printable]
    shown |= dict(zip((c for c in alphabet if c not in shown), others, strict=True))
    return shown


def by_library(rows):
    """(n_a, n_b, links, groups) of each text, and counts of linked pairs."""
    a_library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a_library.encode_special_tokens = True
    b_library = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    shown, counts, out = byte_alphabet(), Counter(), []

    def piece(i):
        name = b_library.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if b_library.is_byte(i) else name.replace("▁", " ").encode()

    for text in rows:
        whole = f" {text}".encode() if text else b""
        a = a_library.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_library.encode(text) if text else []
        a_bytes = [bytes(shown[c] for c in a_library.id_to_token(i)) for i in a]
        b_bytes = [piece(i) for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_end = dict(zip(np.cumsum([len(x) for x in a_bytes]).tolist(), range(len(a)), strict=True))
        b_end = dict(zip(np.cumsum([len(x) for x in b_bytes]).tolist(), range(len(b)), strict=True))
        links = [(a_end[e], b_end[e]) for e in sorted(a_end.keys() & b_end.keys())]
        groups, i, j = [], 0, 0
        for p, q in links:
            groups.append(",".join(map(str, a[i : p + 1])) + "|" + ",".join(map(str, b[j : q + 1])))
            i, j = p + 1, q + 1
        pairs = [(a[p], b[q]) for p, q in links]
        counts.update(pairs)
        out.append((len(a), len(b), pairs, ";".join(groups)))
    return out, counts


def wanted(rows):
    out, counts = by_library(rows)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, len(p), len(p), sum(counts[x] == most[x[1]] for x in p), sum(counts[x] for x in p), g)
        for n_a, n_b, p, g in out
    ], counts


def texts():
    rng = random.Random(4)
    odd = [" ", " ", "  ", "\n", " \n", "\n  ", "\t", "\u00a0", "\x1c", "\u3000", "'s", "'", "Word", "word", "12", "é", "日本", "--", "<s>", "▁"]
    more = ["".join(rng.choices(odd, k=rng.randint(1, 14))) for _ in range(400)]
    more += ["trailing ", " leading", "a \n b", "x\n  y", "tab \tz", "end\n", "a▁b", "tab\tand\nline  two", "<s>x</s><unk>", "\u0000nul", "نص عربي", "\U0001f468‍\U0001f469", "é" * 500]
    return [*odd_texts(), *more, *near_copies(groups=1, copies=5)]


@pytest.fixture
def small_parts(monkeypatch):
    """Tiny batches and trees, in this process and in the workers, who read it from the closure."""
    monkeypatch.setattr(alignment, "LEAF_TASKS", 1)
    monkeypatch.setattr(alignment, "FAN", 2)


def test_alignment_equals_the_libraries(spark, small_parts):
    docs = clashing(frame(spark, texts())).repartition(7)
    found = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs).collect()}
    rows, _ = wanted(texts())
    assert [found[i] for i in range(len(rows))] == rows
    assert found[0] == found[1] == (0, 0, 0, 0, 0, 0, "")
    assert found[texts().index("a▁b")][0] == 0  # B gives a space for the mark


def test_repeated_rows_and_rows_without_id_count(spark):
    docs = frame(spark, ["same text", "same text", None]).selectExpr("IF(doc_id = 0, NULL, doc_id) doc_id", "text")
    docs = docs.unionByName(docs)
    found = alignment.align(docs).collect()
    rows, _ = wanted(["same text", "same text", None] * 2)
    assert sorted(tuple(r)[1:] for r in found) == sorted(rows)
    assert sum(r.doc_id is None for r in found) == 2


def test_pair_table_lists_all_pairs(spark):
    docs = frame(spark, texts())
    found = {(r.a, r.b): (r.n, r.best) for r in alignment.count_pairs(docs).rows(spark).collect()}
    _, counts = wanted(texts())
    assert {k: n for k, (n, _) in found.items()} == dict(counts)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    assert all(best == (n == most[b]) for (_, b), (n, best) in found.items())


def test_no_documents(spark):
    empty = clashing(spark.createDataFrame([], SCHEMA))
    assert alignment.align(empty).count() == 0
    assert alignment.align(frame(spark, [None, ""])).collect()[0].n_links == 0


def test_shards_are_read_anew_beyond_their_bound(spark, monkeypatch):
    table = alignment.count_pairs(frame(spark, texts()))
    rows = table.rows(spark).collect()
    monkeypatch.setattr(alignment, "HELD_BYTES", 100)
    known = alignment.Shards(table.path)
    pairs = np.array([(r.a << 32) | r.b for r in rows], np.uint64)
    counts, best = known.look_up(pairs)
    assert counts.tolist() == [r.n for r in rows] and best.tolist() == [r.best for r in rows]
    assert known.size <= 100 or len(known.held) == 1
    counts, best = known.look_up(np.array([(60_000 << 32) | 3], np.uint64))
    assert (counts[0], best[0]) == (0, False)


def test_documents_that_change_between_the_passes_are_noticed(spark, tmp_path):
    table = alignment.count_pairs(frame(spark, ["known words"]))
    own, known = alignment.aligner(None), alignment.Shards(table.path)
    own.forget()
    own.numbers(["known other"])
    assert known.of_parts(own.pairs, own.n_links)[2].tolist().count(0) == 1


def test_parts_of_lost_texts_count_for_nothing_there(spark):
    """A word that only a lost text has, and one that a later text has as well."""
    rows = ["a▁b lonely shared", "shared word", "shared"]
    found = {r.doc_id: tuple(r)[1:] for r in alignment.align(frame(spark, rows).coalesce(1)).collect()}
    assert [found[i] for i in range(3)] == wanted(rows)[0]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.uint64)
    made = PerfectHash.of(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(n))
    if n == 5000:
        assert made.words.nbytes * 8 < 5 * n


def test_perfect_hash_refuses_repeats():
    with pytest.raises(ValueError):
        PerfectHash.of(np.array([7, 7], np.uint64))


def test_query_gives_the_digest_of_the_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows, _ = wanted([r.text for r in docs])
    found = {r.doc_id: r for r in queries.op11_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    for doc, row in zip(docs, rows, strict=True):
        own = found[doc.doc_id]
        assert tuple(own)[1:7] == row[:6]
        assert own.groups_sha256 == (hashlib.sha256(row[6].encode()).hexdigest() if row[6] else "")
