"""Every operator on small tables, odd rows included, against brute force."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curbline.llm import (
    components,
    cover_tree,
    jaccard_join,
    language,
    lattice,
    line_dedup,
    packing,
    quality,
    queries,
    rules,
    toxicity,
    transducer,
)
from curbline.llm.vocabularies import vocabulary
from tests.llm.corpora import SCHEMA, clashing, frame, near_copies, odd_texts, shingles, smallest_reachable


@pytest.fixture(scope="module")
def odd(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    return clashing(frame(spark, odd_texts())).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return clashing(spark.createDataFrame([], SCHEMA))


def held(doc_id, folds, remainder):
    return zlib.crc32(str(doc_id).encode()) % folds == remainder


# ---------------------------------------------------------------------------
# 1: lines
# ---------------------------------------------------------------------------


def removed_by_hand(documents):
    """(doc_id, line) of lines that are 0.9 alike to an earlier one, pair by pair."""
    lines = []
    for doc_id, text in sorted(documents):
        for at, line in enumerate((text or "").split("\n")):
            own = set(line.encode().split())
            if own:
                lines.append((doc_id, at, own))
    return {
        (doc_id, at)
        for i, (doc_id, at, own) in enumerate(lines)
        if any(10 * len(own & o) >= 9 * len(own | o) for _, _, o in lines[:i])
    }


def lines_corpus():
    texts = near_copies(seed=5, groups=2, copies=25, length=40, edits=3)
    documents = ["\n".join(texts[i : i + 4]) for i in range(0, len(texts), 4)]
    return [*documents, *odd_texts(), "\n\nfew words\n" + texts[0] + "\n" + texts[0]]


def test_line_dedup_equals_pairs_by_hand(spark):
    texts = lines_corpus()
    docs = clashing(frame(spark, texts))
    wanted = removed_by_hand(list(enumerate(texts)))
    found = line_dedup.removed_lines(docs).collect()
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted) > 20
    by_doc = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    assert len(by_doc) == len(texts)
    for i, text in enumerate(texts):
        gone = sorted(at for doc, at in wanted if doc == i)
        assert by_doc[i].removed_lines == ",".join(map(str, gone))
        assert by_doc[i].n_removed == len(gone)
        assert by_doc[i].n_lines == sum(bool(x.encode().split()) for x in (text or "").split("\n"))
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert line_dedup.dedup_lines(docs).columns == docs.columns
    for i, text in enumerate(texts):
        left = [x for at, x in enumerate((text or "").split("\n")) if (i, at) not in wanted]
        if len(left) == len((text or "").split("\n")):
            assert kept[i] == text
        elif any(x.encode().split() for x in left):
            assert kept[i] == "\n".join(left)
        else:
            assert i not in kept


def test_line_dedup_of_prefixes_beyond_the_list(spark, monkeypatch):
    """Entries without the rest of their prefix are compared by whole prefixes."""
    texts = lines_corpus()
    docs = frame(spark, texts)
    monkeypatch.setattr(line_dedup, "LISTED", 2)
    assert {tuple(r) for r in line_dedup.removed_lines(docs).collect()} == removed_by_hand(
        list(enumerate(texts))
    )


def test_short_lines_are_deduplicated(spark):
    """Repeats of lines of few distinct words go, near copies of nine and ten words as well."""
    ten = "a b c d e f g h i j"
    texts = [
        "read more\nfirst\nbuy now buy now\n" + ten[:-2],
        "read more\nsecond\nmore read\nread\n" + ten,
        "now buy\nread more",
        "one two three four five six seven eight\none two three four five six seven",
    ]
    docs = clashing(frame(spark, texts))
    wanted = {(1, 0), (1, 2), (1, 4), (2, 0), (2, 1)}
    assert {tuple(r) for r in line_dedup.removed_lines(docs).collect()} == wanted
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert kept == {0: texts[0], 1: "second\nread", 3: texts[3]}
    assert {tuple(r) for r in line_dedup.removed_lines(docs, 5).collect()} == {(1, 4)}


def test_line_dedup_keeps_only_what_it_still_reads(spark, monkeypatch):
    """Pairs are removed once their lines are compared; what is left is read by the result."""
    live = {}
    store, drop = line_dedup.stored, line_dedup.discard

    def stored(rows, name):
        found = store(rows, name)
        live[found.stored_at] = name
        return found

    def discard(rows):
        live.pop(rows.stored_at, None)
        drop(rows)

    monkeypatch.setattr(line_dedup, "stored", stored)
    monkeypatch.setattr(line_dedup, "discard", discard)
    texts = lines_corpus()
    with line_dedup.intermediates(spark):
        found = line_dedup.removed_lines(frame(spark, texts))
        assert set(live.values()) <= {"line-classes", "line-places", "similar-lines", "found-lines"}
        assert {tuple(r) for r in found.collect()} == removed_by_hand(list(enumerate(texts)))


# ---------------------------------------------------------------------------
# 2: packing
# ---------------------------------------------------------------------------


def test_packing_gives_every_token_a_place(spark, odd):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = packing.pack(odd, window=128).collect()
    texts = odd_texts()
    wanted = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    places: dict[int, list] = {}
    found: dict[int, list] = {i: [] for i in wanted}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length and r.doc_tokens == len(wanted[r.doc_id])
        assert ids == wanted[r.doc_id][r.start : r.start + r.length]
        found[r.doc_id].append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in wanted.items():
        end = 0
        for start, length in sorted(found[i]):
            assert start == end
            end += length
        assert end == len(ids)
    assert sorted(places) == list(range(len(places)))
    for sequence, own in places.items():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end == 128 or sequence == max(places)


def test_packing_keeps_the_mixture_in_every_window(spark):
    texts = [" ".join(f"token{i % 50}" for i in range(300)) for _ in range(30)]
    rows = packing.pack(frame(spark, texts), {"src0": 0.5, "src1": 0.25, "src2": 0.25}, window=256)
    share = Counter()
    for r in rows.where("sequence_id < 20").collect():
        share[r.sequence_id, r.source] += r.length
    assert {share[w, "src0"] for w in range(20)} == {128}


def by_window(rows):
    share, last = Counter(), 0
    for r in rows.collect():
        share[r.sequence_id, r.source] += r.length
        last = max(last, r.sequence_id)
    return share, last


def with_sources(spark, words_of):
    rows = [
        (i, " ".join(f"token{k % 50}" for k in range(n)), "en", source, 0)
        for i, (source, n) in enumerate(words_of)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_packing_keeps_the_mixture_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_BITS", 2)
    docs = with_sources(spark, [(f"s{i}", 100) for i in range(100) for _ in range(2)])
    share, last = by_window(packing.pack(docs, window=1000))
    assert sum(share.values()) > 20_000 and last > 20
    for w in range(last):
        own = [share[w, f"s{i}"] for i in range(100)]
        assert sum(own) == 1000 and min(own) >= 5 and max(own) <= 15


def test_packing_keeps_the_shares_of_many_sources(spark):
    """Small sources have their targets; sources without one come last, and shares of sources that
    are not there go to the others in proportion."""
    sizes = [(f"s{i}", 300) for i in range(69)] + [("small", 200)] + [(f"no{i}", 250) for i in range(9)]
    shares = {f"s{i}": 1.0 for i in range(69)} | {"small": 23.0, "absent": 50.0}
    share, last = by_window(packing.pack(with_sources(spark, sizes), shares, window=368))
    # 92 units of 4 tokens: 4 for each, 92 for the small one.
    assert [share[w, "small"] for w in range(2)] == [92, 92]
    assert {share[w, f"s{i}"] for w in range(2) for i in range(69)} == {4}
    ends = max(w for w, source in share if source.startswith("s"))
    assert min(w for w, source in share if source.startswith("no")) >= ends
    # The last round of the tree is short, and reaches into the last window but one.
    for w in range(ends + 1, last - 1):
        own = [share[w, f"no{i}"] for i in range(9)]
        assert sum(own) == 368 and min(own) >= 30 and max(own) <= 52


# ---------------------------------------------------------------------------
# 3: encoding
# ---------------------------------------------------------------------------


def test_transcoding_equals_the_library(odd):
    library = Tokenizer.from_file(vocabulary(transducer.WORD_BPE))
    rows = {r.doc_id: r for r in transducer.transcode(odd).collect()}
    for i, text in enumerate(odd_texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids == " ".join(map(str, ids))
        assert rows[i].decoded == library.decode(ids, skip_special_tokens=False)


# ---------------------------------------------------------------------------
# 4, 5, 9: classifiers
# ---------------------------------------------------------------------------


def test_classifiers_accept_odd_rows_and_extra_columns(spark, odd, none):
    labels = spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(99, None, None), (3, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.train(odd, labels)
    good = quality.score(odd, model).collect()
    assert len(good) == 12 and all(0 <= r.score <= 1 for r in good)
    bad = toxicity.score(odd, toxicity.train(odd, labels)).collect()
    assert len(bad) == 12 and all(0 <= r.score <= 1 for r in bad)
    found = {r.doc_id: r for r in language.predict(odd, language.train(odd)).collect()}
    assert found[0].lang_pred == found[1].lang_pred == found[2].lang_pred == "und"
    assert {found[i].lang_pred for i in range(3, 12)} <= {"en", "fr"}
    assert found[6].score == found[7].score and 0 <= found[6].score <= 1
    # Nothing to learn from, and nothing to score.
    assert quality.score(odd, quality.train(none, labels.limit(0))).count() == 12
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0
    unknown = language.predict(odd, language.train(odd.withColumn("lang", F.lit(None).cast("string"))))
    assert {tuple(r)[1:] for r in unknown.collect()} == {("und", 0.0)}


# ---------------------------------------------------------------------------
# 6: rules
# ---------------------------------------------------------------------------


def statistics_by_hand(text):
    own = [w.decode() for w in (text or "").encode().split()]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rule_statistics_equal_those_by_hand(spark, odd):
    texts = [*odd_texts(), "a b c d e a b c d e", "a a a a a a a", "x | y\nx | y\n \nz", "p q r s t u\nv p q r s t"]
    docs = clashing(frame(spark, texts))
    rows = {r.doc_id: r for r in rules.judge(docs).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        by_hand = statistics_by_hand(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == by_hand
        assert r.base_failed == (by_hand[0] < 10 or 100 * by_hand[4] > 20 * by_hand[0])
        assert not (r.base_failed and r.kept)


def test_rules_run_by_rejections_per_cost():
    made = [rules.Rule(n, None) for n in ("dear", "cheap", "idle")]
    measures = [(made[0], 9.0, 0.9), (made[1], 1.0, 0.3), (made[2], 1.0, 0.0)]
    assert [r.name for r in rules.ordered(measures)] == ["cheap", "dear", "idle"]


def test_the_order_of_rules_changes_no_verdict(spark):
    docs = spark.range(50).withColumn("x", F.col("id") % 7)
    own = [rules.Rule("a", F.col("x") > 4), rules.Rule("b", F.col("id") < 9), rules.Rule("c", F.lit(None).cast("boolean"))]
    there, back = (docs.where(rules.passes(r)).count() for r in (own, own[::-1]))
    assert there == back == docs.where("x <= 4 AND id >= 9").count()


def test_rules_are_tried_on_what_others_let_through(spark):
    """A rule that fails on every text that it is tried on, behind one that rejects most of them."""
    docs = frame(spark, ["short of words"] * 3 + ["some nine or more words are in this text here now"])
    tried = rules.Rule("tried", F.when(F.col("text") != "", F.raise_error(F.col("text"))).cast("boolean"))
    rejecting = rules.Rule("rejecting", F.col("text").contains("short"))
    rows = rules.with_statistics(docs)
    kept = rows.where("text LIKE 'short%'").select(rules.passes([rejecting, tried]).alias("kept"))
    assert [r.kept for r in kept.collect()] == [False] * 3
    with pytest.raises(Exception, match="some nine"):
        rows.select(rules.passes([rejecting, tried])).collect()
    with pytest.raises(Exception, match="short of words"):
        rows.where("text LIKE 'short%'").select(rules.passes([tried, rejecting])).collect()


def test_rules_with_costs_of_their_own(spark):
    good = "a text of some ordinary words that nobody would want to reject at all"
    texts = {
        "digits": "12345678901234567890 " * 12,
        "open_brackets": "several words ((((( " * 12,
        "endless_word": good + " " + "qwertz" * 200,
        "few_characters": "ab ba aab bab bba aba abb baa abab baba",
        "shouting": "no!! way!! stop!! now!! go!! away!! be!! off!! run!! hide!!",
        None: good,
    }
    rows = rules.with_statistics(frame(spark, list(texts.values())))
    checks = rows.select("doc_id", *(F.coalesce(r.rejects, F.lit(False)).alias(r.name) for r in rules.default_rules()))
    for row in checks.collect():
        name = list(texts)[row.doc_id]
        assert [n for n in texts if n and row[n]] == ([name] if name else [])


def test_cost_is_a_rules_own(spark):
    """Comparing statistics costs less than reading the text again and again."""
    docs = frame(spark, [f"{i} " + "many words of a text " * 400 for i in range(300)])
    rows = rules.stored(rules.with_statistics(docs), "rule-test").coalesce(1)
    dear = F.lit(0)
    for k in range(12):
        dear = dear + F.regexp_count("text", F.lit(f"[a-z]{{{k + 2}}} "))
    found = {r.name: cost for r, cost, _ in rules.measured(rows, [rules.Rule("dear", dear < 0), rules.Rule("cheap", F.col("n_words") < 3)])}
    assert found["dear"] > 3 * found["cheap"]


# ---------------------------------------------------------------------------
# 7: embeddings
# ---------------------------------------------------------------------------


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(5, 6))
    x = centers[rng.integers(0, 5, 700)] + rng.normal(0, 0.06, (700, 6)) * rng.integers(0, 2, (700, 1))
    rows = [(i, [float(np.float32(v)) for v in r], int(i % 3), i) for i, r in enumerate(x)]
    odd = [[], None, [0.0] * 6, [1.0, None, 2.0, 3.0, 4.0, 5.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    rows += [(1000 + i, v, 1, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], None, 0)]
    rows += [(3000 + i, rows[7][1], rows[7][2], 0) for i in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep long")
    found = {r.vec_id: r for r in cover_tree.near_duplicates(vectors.repartition(4)).collect()}
    assert len(found) == len(rows)

    def usable(v):
        return bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    use = [r for r in rows if usable(r[1]) and r[2] is not None and len(r[1]) == 6]
    y = np.array([r[1] for r in use])
    label = np.array([r[2] for r in use])
    close = (y @ y.T) / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1)) >= 0.98
    close &= label[:, None] == label
    np.fill_diagonal(close, False)
    least = smallest_reachable([r[0] for r in use], lambda i, j: close[i, j])
    wanted = {r[0]: (int(n), c) for r, n, c in zip(use, close.sum(1), least, strict=True)}
    for vec_id, r in found.items():
        assert (r.n_links, r.component_id) == wanted.get(vec_id, (0, vec_id))
        assert r.kept == (r.component_id == vec_id)
    assert cover_tree.near_duplicates(vectors.limit(0)).count() == 0


# ---------------------------------------------------------------------------
# 8: near copies
# ---------------------------------------------------------------------------


def test_jaccard_join_equals_brute_force(spark):
    texts = [*odd_texts(), *near_copies(seed=2), *near_copies(seed=3, groups=1, copies=60, edits=1)]
    docs = clashing(frame(spark, texts, first=5)).repartition(5)
    sets = [shingles(t) for t in texts]
    least = smallest_reachable(
        [i + 5 for i in range(len(texts))],
        lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]),
    )
    rows = {r.doc_id: r for r in jaccard_join.join(docs).collect()}
    assert len(rows) == len(texts)
    for i, (own, component) in enumerate(zip(sets, least, strict=True)):
        assert (rows[i + 5].n_shingles, rows[i + 5].component_id) == (len(own), component)
    assert jaccard_join.join(docs.limit(0)).count() == 0


def test_jaccard_join_keeps_only_what_it_still_reads(spark, monkeypatch):
    """Candidates, pairs, token sets and links go once read; what is left is read by the result."""
    live = {}
    store, drop = jaccard_join.stored, jaccard_join.discard

    def stored(rows, name):
        found = store(rows, name)
        live[found.stored_at] = name
        return found

    def discard(rows):
        live.pop(rows.stored_at, None)
        drop(rows)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    monkeypatch.setattr(jaccard_join, "discard", discard)
    texts = [*odd_texts(), *near_copies(seed=2), *near_copies(seed=3, groups=1, copies=60, edits=1)]
    sets = [shingles(t) for t in texts]
    least = smallest_reachable(
        list(range(len(texts))),
        lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]),
    )
    with jaccard_join.intermediates(spark):
        found = jaccard_join._joined(frame(spark, texts).repartition(5))
        assert set(live.values()) <= {"shingle-sets", "nodes", "open-members"}
        assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(least))


def test_frequent_tokens_are_combined():
    """Light documents index pairs of frequent tokens; the others stay as they are."""
    counts = np.zeros(jaccard_join.SLOTS, np.int64)
    tokens = np.unique(jaccard_join.mixed(np.arange(40, dtype=np.uint64)))
    counts[jaccard_join.slot(tokens[:3])] = 10**6
    n = jaccard_join.prefix(len(tokens))
    counts[jaccard_join.slot(tokens[3:])] += np.arange(37) * 2 + 2 * 10**6 * (np.arange(37) >= n - 3)
    keys, kinds, weight, places = jaccard_join.index_entries(tokens, counts, 10**5)
    assert len(keys) == n + 3 and (kinds == jaccard_join.LIGHT).sum() == 3
    assert (weight[kinds == jaccard_join.LIGHT] == 10**6).all() and len(places) == len(keys)


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)]
    links += [(200, 201), (201, 202), (202, 200), (7, 7), (300, 301), (301, 300)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in range(100, 160)} == {100}
    assert {found[i] for i in (200, 201, 202)} == {200} and found[301] == 300
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0


# ---------------------------------------------------------------------------
# 10: scores
# ---------------------------------------------------------------------------


def test_scores_equal_counts_by_hand(spark, odd):
    texts = odd_texts()
    rows = {r.doc_id: r for r in lattice.score(odd).collect()}
    tokens = {i: (t or "").encode().lower().split() for i, t in enumerate(texts)}
    training = [i for i in tokens if not held(i, 7, 2)]
    counts = Counter(w for i in training for w in [*tokens[i], None])
    n, v = sum(counts.values()), len(counts)
    for i, own in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*own, None])
        assert rows[i].base_score == pytest.approx(base, rel=1e-9)
        assert rows[i].n_tokens == len(own) + 1
        assert rows[i].n_known == sum(w in counts for w in [*own, None])
        assert (rows[i].train_tokens, rows[i].held_out) == (n, held(i, 7, 2))
        assert rows[i].score < 0 and math.isfinite(rows[i].score)
    assert rows[6].score == pytest.approx(rows[7].score)


def test_rows_without_id_are_scored_and_counted(spark):
    docs = frame(spark, ["known words here", "other words"]).selectExpr("IF(doc_id = 1, NULL, doc_id) doc_id", "text")
    rows = sorted(lattice.score(docs).collect(), key=str)
    assert {r.doc_id for r in rows} == {0, None}
    assert all(r.train_tokens == 7 and not r.held_out and r.n_known == r.n_tokens for r in rows)


def test_a_words_probability_is_its_counts_arc_and_the_lattices():
    base, mixed = lattice.log_probabilities(np.array([3, 0]), np.log([0.01, 0.02]), 10, 4)
    assert base == pytest.approx(np.log10([4 / 15, 1 / 15]))
    assert 10**mixed == pytest.approx([(3 + 4 * 0.01) / 14, 4 * 0.02 / 14])


# ---------------------------------------------------------------------------
# Empty tables and digests
# ---------------------------------------------------------------------------


def test_empty_tables(none):
    assert line_dedup.report(none).count() == line_dedup.dedup_lines(none).count() == 0
    assert packing.pack(none).count() == transducer.transcode(none).count() == 0
    assert rules.judge(none).count() == lattice.score(none).count() == 0


def test_digests_of_the_queries(spark, tmp_path, odd):
    odd.select(*SCHEMA_NAMES).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(vocabulary(transducer.WORD_BPE))
    rows = {r.doc_id: r for r in queries.op3_bpe(spark, str(tmp_path)).collect()}
    for i, text in enumerate(odd_texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        plain = " ".join(map(str, ids)).encode()
        assert rows[i].ids_sha256 == hashlib.sha256(plain).hexdigest()
    ids = {}
    byte_library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for r in queries.op2_packing(spark, str(tmp_path)).collect():
        text = odd_texts()[r.doc_id] or ""
        own = ids.setdefault(r.doc_id, [*byte_library.encode(text, add_special_tokens=False).ids, 1])
        data = np.array(own[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(data)


SCHEMA_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
