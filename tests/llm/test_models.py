"""The parts of the operators that need no Spark, against brute force."""

from __future__ import annotations

import itertools
import math
import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbline.llm import cover_tree, jaccard_join, language, lattice, packing, quality, toxicity, transducer
from curbline.llm.common import lower_words, words
from curbline.llm.vocabularies import vocabulary

TEXTS = st.text(
    st.sampled_from("abethinoSΣσſİé ñßä日\U0001f600́\x1c\x85  \n\t'.,!?0123|<>"),
    max_size=80,
) | st.lists(
    st.sampled_from(["the", " ", "ing", "'s", "<|endoftext|>", "<|startoftext|>", "  ", "\n", "x" * 90])
).map("".join)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(vocabulary(transducer.WORD_BPE))


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_word_ids_and_decoded_text_are_the_librarys(word_library, text):
    own = transducer.tokenizer(vocabulary(transducer.WORD_BPE))
    ids = word_library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == word_library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["etaoinshrdlu", "ab", "a", "the ing"])
def test_long_words_are_streamed_to_the_same_tokens(word_library, letters):
    rng = random.Random(3)
    word = "".join(rng.choice(letters.replace(" ", "")) for _ in range(9000))
    own = transducer.tokenizer(vocabulary(transducer.WORD_BPE))
    assert own.encode(word) == word_library.encode(word, add_special_tokens=False).ids


def test_stream_holds_a_bounded_window_and_emits_early():
    own = transducer.tokenizer(vocabulary(transducer.WORD_BPE)).merges
    taken = 0

    def symbols():
        nonlocal taken
        for _ in range(50_000):
            taken += 1
            yield "t"

    stream = own.stream(symbols())
    next(stream)
    assert taken <= 4 * own.lookahead


@given(data=st.binary(max_size=40), cuts=st.lists(st.integers(0, 40), max_size=6))
def test_byte_machine_does_not_depend_on_the_cuts(data, cuts):
    machine, out, at = transducer.ByteToText(), "", 0
    for cut in sorted(cuts):
        out += machine.feed(data[at:cut]) if cut > at else ""
        assert len(machine.pending) <= 3
        at = max(at, min(cut, len(data)))
    out += machine.feed(data[at:], last=True)
    assert out == data.decode("utf-8", "replace")


def test_plain_words_come_back():
    own = transducer.tokenizer(vocabulary(transducer.WORD_BPE))
    assert own.decode_words(own.encode("Größe, ñandú 日本語")) == "größe , ñandú 日本語 "


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_byte_ids_are_the_librarys(byte_library, text):
    ids = np.frombuffer(packing.byte_tokenizer(None).encode(text), "<u2").tolist()
    assert ids == byte_library.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(vocabulary(f"{packing.BYTE_BPE}.json"))


@pytest.mark.parametrize(
    ("totals", "shares"),
    [([5000, 100, 7], None), ([40000, 40000, 9], [0.2, 0.7, 0.1]), ([1], None), ([0, 5], None), ([900] * 20, None)],
)
def test_schedule_places_every_token_once(totals, shares):
    plan = packing.schedule(totals, shares or [float(n) for n in totals], window=64, period=16)
    places: dict[int, list] = {}
    for queue, n in enumerate(totals):
        for start in range(0, n, 77):
            for window, offset, length in packing.pieces_of(
                plan, queue, start, min(n, start + 77), 64, 16
            ):
                places.setdefault(window, []).append((offset, length))
    assert sorted(places) == list(range(-(-sum(totals) // 64)))
    for window, own in places.items():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end == 64 or window == max(places)


@pytest.mark.parametrize("sizes", [[5], [1, 1], [300, 1, 40, 7, 7], [20] * 90, list(range(1, 70))])
@pytest.mark.parametrize("size", [1, 16, 100])
def test_tree_places_every_token_once_and_in_proportion(sizes, size):
    total, found = sum(sizes), []
    for n, path in zip(sizes, packing.tree_paths(sizes), strict=True):
        assert packing.given_by(path, total)[1] == n
        depth = len(path) // 2
        for p in range(total + 1):
            assert abs(packing.given_by(path, p)[1] - p * n / total) <= depth
        own = []
        for start in range(0, n, 13):
            for at, length in packing.tree_pieces(path, total, size, start, min(n, start + 13)):
                own += range(at, at + length)
        assert len(own) == n and own == sorted(own)
        found += own
    assert sorted(found) == list(range(total))


def test_round_robin_carries_credits_and_comes_round():
    given_ = packing.round_robin(tuple(packing.whole_units([0.5, 0.3, 0.2], 64 * 16)), 64, 16)
    assert (np.diff(given_, axis=0).sum(1) == 64).all()
    exact = np.arange(17)[:, None] * 64 * np.array([0.5, 0.3, 0.2])
    assert np.abs(given_ - exact).max() < 2


def clustered(seed, n=90, dim=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    x = centers[rng.integers(0, 6, n)] + rng.normal(0, 0.12, (n, dim)) * rng.integers(0, 2, (n, 1))
    return x * rng.uniform(0.1, 9, (n, 1))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("same", [True, False])
def test_cover_trees_find_every_pair(seed, same):
    x = clustered(seed)
    y = x if same else np.concatenate([clustered(seed)[:40], clustered(seed + 50)])
    weight = np.random.default_rng(seed).integers(1, 4, len(x) + len(y))
    wx, wy = weight[: len(x)], weight[: len(y)] if same else weight[len(x) :]
    close = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) >= 0.98
    if same:
        np.fill_diagonal(close, False)
    to_x, to_y, roots = cover_tree.links_of_blocks(x, y, wx, wy, same)
    assert (to_x == close @ wy).all()
    if not same:
        assert (to_y == wx @ close).all()
    root = dict(roots)
    shift = 0 if same else len(x)
    for i, j in zip(*np.nonzero(close), strict=True):
        assert root.get(i, i) == root.get(j + shift, j + shift)


def test_cover_tree_levels_halve():
    tree = cover_tree.CoverTree((x := clustered(1, 200)) / np.linalg.norm(x, axis=1)[:, None])
    for k in range(len(tree.center)):
        rows = tree.order[tree.begin[k] : tree.end[k]]
        assert tree.center[k] in rows
        far = np.sqrt(np.maximum(0, 2 - 2 * tree.x[rows] @ tree.x[tree.center[k]]))
        assert far.max() <= tree.radius[k] + cover_tree.SLACK
        for c in range(tree.first[k], tree.first[k] + tree.count[k]):
            assert tree.radius[c] <= tree.radius[k] / 2 + cover_tree.SLACK


def test_lattice_sums_all_segmentations():
    own = lattice.lattice(vocabulary(lattice.PIECES))
    log = dict(zip(own.pieces, own.prior, strict=False))

    def brute(word):
        text = lattice.WORD_START + word

        @__import__("functools").cache
        def total(i):
            if i == len(text):
                return 1.0
            found = sum(math.exp(log[text[i:j]]) * total(j) for j in range(i + 1, len(text) + 1) if text[i:j] in log)
            if text[i] not in log:
                found += math.exp(len(text[i].encode()) * own.prior[-1]) * total(i + 1)
            return found

        return math.log(total(0))

    some = ["the", "thtion", "réêou", "x", "日本語", "über,", "\U00010348z", "aaaaaaaa"]
    counts = np.zeros(len(own.prior))
    assert own.masses(some, own.prior, counts) == pytest.approx([brute(w) for w in some])
    assert own.masses(["a" * 5000], own.prior)[0] < -1000  # no underflow
    assert counts.sum() >= len(some)


def test_squares_identity_equals_the_pairs():
    rng = np.random.default_rng(2)
    model = quality.Machine(np.zeros((1, 1)), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    places, values = np.array([1, 4, 7, 8]), np.array([0.5, 1.0, 2.0, 0.1])
    v = model.factors[places]
    pairs = sum(v[i] @ v[j] * values[i] * values[j] for i, j in itertools.combinations(range(4), 2))
    assert model.margin(places, values)[0] == pytest.approx(0.3 + model.linear[places] @ values + pairs)


def test_quality_machine_learns_an_interaction():
    rng = random.Random(4)
    texts, labels = [], []
    for _ in range(300):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join((["left"] if a else []) + (["right"] if b else []) + ["and so on"]))
        labels.append(int(a != b))
    model = quality.fit(texts, labels)
    assert np.mean([(model.score(t) >= 0.5) == y for t, y in zip(texts, labels, strict=True)]) > 0.9
    assert 0 <= model.score(None) <= 1 and 0 <= model.score("") <= 1


def planted_votes(copies=0, n=4000, seed=3):
    """Votes of six voters on a hidden class, of which ``copies`` more repeat the worst."""
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.3
    hits, slips = (0.6, 0.5, 0.55, 0.7, 0.5, 0.35), (0.02, 0.03, 0.02, 0.05, 0.04, 0.2)
    fired = [rng.random(n) < np.where(truth, h, s) for h, s in zip(hits, slips, strict=True)]
    fired += [fired[5] ^ (rng.random(n) < 0.01) for _ in range(copies)]
    return truth, np.column_stack(fired), hits, slips


def test_label_model_finds_accuracies():
    truth, fired, hits, slips = planted_votes()
    model = toxicity.label_model(fired, 5)
    assert (model.parent == -1).sum() >= 5 and abs(model.prior - 0.3) < 0.05
    assert np.abs(model.fires[1, 0] - hits).max() < 0.1
    assert np.abs(model.fires[0, 0] - slips).max() < 0.05
    assert ((model.posterior(fired) > 0.5) == truth).mean() > 0.95


def test_label_model_fits_planted_correlations():
    """Seven copies of a bad voter are linked in the tree, and count about once."""
    truth, fired, *_ = planted_votes(copies=7)
    model = toxicity.label_model(fired, 5)
    copies = range(5, 13)
    assert sum(model.parent[j] in copies for j in copies) == 7
    assert all(model.parent[j] == -1 for j in range(5))
    for j in copies:
        if model.parent[j] >= 0:  # whether a copy fires says nothing once its parent is known
            assert abs(np.log(model.fires[1, 1, j] / model.fires[0, 1, j])) < 0.05
    alone = toxicity.label_model(fired[:, :6], 5).posterior(fired[:, :6])
    assert np.abs(model.posterior(fired) - alone).mean() < 0.03
    # Without the tree, they would outvote the others.
    naive = toxicity.LabelModel(model.prior, np.full(13, -1), np.clip(
        np.stack([np.stack([fired[truth == y].mean(0)] * 2) for y in (0, 1)]), 1e-4, 1))
    assert ((model.posterior(fired) > 0.5) == truth).mean() > ((naive.posterior(fired) > 0.5) == truth).mean() + 0.005


def test_toxicity_classifier_learns_stems():
    rng = random.Random(6)
    bland = [f"{a}{b}" for a in ("lo", "mi", "ta", "ne") for b in ("ra", "so", "ki", "bu", "de")]
    rows = []
    for i in range(600):
        own = [rng.choice(bland) for _ in range(20)]
        if i % 4 == 0:
            own.insert(3, rng.choice(["grumpo", "grumpi", "grumpa"]))
        label = int(i % 4 == 0) if i < 300 else None  # half of them without label
        rows.append(toxicity.packed(" ".join(own)) | {"label": label})
    sample = toxicity.Sample.of(rows)
    names = {toxicity.place_of(n): n for w in ("grumpo", "grumpi", "grumpa", *bland) for n in toxicity.names_of(w)}
    voters = toxicity.lexicons(toxicity.candidate_stems(sample), names)
    assert voters and all(v[0].startswith("gru") for v in voters)
    fired = toxicity.votes(sample, voters)
    posterior = toxicity.label_model(fired, len(voters)).posterior(fired)
    assert (posterior > 0.5).tolist() == [i % 4 == 0 for i in range(600)]
    model = toxicity.fit_classifier(sample, posterior, voters)
    assert model.score("lora grumpu miso") > 0.5 > model.score("lora miso taki")
    assert 0 <= model.score(None) == model.score("") <= 1


def test_language_model_is_sparse_and_calibrated():
    rng = random.Random(8)
    kinds = {"en": ["the", "with", "ing"], "de": ["der", "mit", "ung"]}
    rows, texts = [], []
    for i in range(200):
        lang = ("en", "de")[i % 2]
        text = " ".join(rng.choice(kinds[lang]) for _ in range(12))
        counts = language.n_gram_counts(text)
        places = np.flatnonzero(counts)
        rows.append((i % 2, places, counts[places]))
        texts.append((text, lang))
    idf = np.ones(1 << language.BITS)
    model = language.fit(rows, ["en", "de"], idf)
    assert all(model.predict(t)[0] == lang for t, lang in texts)
    assert (model.weights == 0).mean() > 0.9
    assert model.predict("123 !?") == model.predict(None) == (language.UNKNOWN, 0.0)
    assert model.predict("² ½ ① Ⅷ") == (language.UNKNOWN, 0.0)
    assert model.predict("² der mit ung")[0] == "de"


def test_n_grams_of_long_texts_do_not_depend_on_the_chunk(monkeypatch):
    text = "ab cde fghi jklmn " * 40
    whole = language.n_gram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 17)
    assert (language.n_gram_counts(text) == whole).all()


def test_temperature_restores_probabilities():
    rng = np.random.default_rng(1)
    margins = rng.normal(0, 1, (4000, 3))
    truth = np.array([rng.choice(3, p=p) for p in language.softmax(margins)])
    assert language.temperature(margins * 5, truth) == pytest.approx(5, rel=0.2)


@given(st.integers(1, 400), st.data())
@settings(deadline=None)
def test_prefixes_of_similar_sets_share_two_tokens(n, data):
    shared = data.draw(st.integers(-(-3 * n // 4), n))
    most = n if shared == n else shared * 4 // 3
    extra = data.draw(st.integers(0, max(0, min(most - shared, 40))))
    a = set(range(n))
    b = set(range(shared)) | set(range(1000, 1000 + extra))
    if a == b or 4 * len(a & b) < 3 * len(a | b):
        return
    order = data.draw(st.randoms(use_true_random=False))
    rank = list(a | b)
    order.shuffle(rank)
    place = {x: i for i, x in enumerate(rank)}
    first = [set(sorted(s, key=place.__getitem__)[: jaccard_join.prefix(len(s))]) for s in (a, b)]
    assert len(first[0] & first[1]) >= 2


def test_words_split_at_ascii_blanks_only():
    text = "A b\x1cc d\x85e F\tg\x0bh\x0ci\rj\nÄ"
    assert words(text) == ["A b\x1cc d\x85e", "F", "g", "h", "i", "j", "Ä"]
    assert [w.decode() for w in lower_words("ÄB Ça")] == ["Äb", "Ça"]
    assert words(None) == words("") == lower_words(None) == []


def test_long_runs_are_coded_in_constant_memory():
    """Beside copies of the text itself: neither its ids nor its tokens are held together."""
    coder = transducer.WordTokenizer(vocabulary(transducer.WORD_BPE))
    text = "".join(random.Random(2).choices("abcdefghij0123456789é", k=300_000))
    whole = Tokenizer.from_file(vocabulary(transducer.WORD_BPE)).encode(text, add_special_tokens=False)
    tracemalloc.start()
    count, digest = 0, hashlib.sha256()
    for n, ids, decoded in coder.pieces(text):
        assert n <= transducer.PART_IDS and len(decoded) < 100_000
        digest.update((" " if count else "").encode() + ids.encode())
        count += n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == len(whole.ids)
    assert digest.hexdigest() == hashlib.sha256(" ".join(map(str, whole.ids)).encode()).hexdigest()
    assert peak < 16 * len(text)


def test_tokens_are_decoded_one_by_one(monkeypatch):
    fed, feed = [], transducer.ByteToText.feed
    monkeypatch.setattr(transducer.ByteToText, "feed", lambda self, data, last=False: fed.append(data) or feed(self, data, last))
    coder = transducer.WordTokenizer(vocabulary(transducer.WORD_BPE))
    ids = coder.encode("several words here")
    fed.clear()
    assert coder.decode(ids) == Tokenizer.from_file(vocabulary(transducer.WORD_BPE)).decode(ids, skip_special_tokens=False)
    assert len(fed) == len(ids) + 1
