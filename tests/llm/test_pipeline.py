"""The pipeline against a plain Python version of its five stages."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from curbline.llm import language, packing, quality
from curbline.llm.common import table
from curbline.llm.vocabularies import vocabulary
from tests.llm.corpora import SCHEMA, near_copies, shingles, smallest_reachable
from tests.llm.test_operators import removed_by_hand

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest documents, near copies, a row that comes twice, and one without id."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*(c.split()[0] for c in SCHEMA.split(", ")))
    texts = near_copies(groups=2, copies=6)
    rows = [(9000 + i, t, "en", "made", len(t)) for i, t in enumerate(texts)]
    rows += [(9001, texts[1], "en", "made", len(texts[1])), (None, texts[2], "en", "made", len(texts[2]))]
    docs.unionByName(spark.createDataFrame(rows, SCHEMA)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def by_hand(spark, folder):
    """doc_id and text of what is left before packing."""
    docs = table(spark, folder, "documents")
    machine = quality.train(docs, table(spark, folder, "labels"))
    rows = [r for r in docs.collect() if machine.score(r.text) >= quality.KEPT_FROM]
    # The next model learns from what the first has left.
    kept = spark.createDataFrame(rows, docs.schema)
    model = language.train(kept)
    found = [(r, model.predict(r.text)) for r in rows]
    rows = [
        (r.doc_id, r.text)
        for r, (lang, score) in found
        if lang != language.UNKNOWN and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE
    ]
    gone = removed_by_hand(sorted({r for r in rows if r[0] is not None}))
    left = []
    for doc_id, text in rows:
        lines = text.split("\n")
        own = [x for at, x in enumerate(lines) if doc_id is None or (doc_id, at) not in gone]
        if len(own) == len(lines) or any(x.encode().split() for x in own):
            left.append((doc_id, "\n".join(own)))
    known = sorted({r for r in left if r[0] is not None})
    sets = [shingles(text) for _, text in known]

    def linked(i, j):
        shared = len(sets[i] & sets[j])
        return bool(sets[i]) and 4 * shared >= 3 * (len(sets[i]) + len(sets[j]) - shared)

    ids = [doc_id for doc_id, _ in known]
    component = dict(zip(ids, smallest_reachable(ids, linked), strict=True))
    return [r for r in known if component[r[0]] == r[0]] + [r for r in left if r[0] is None]


def test_pipeline_equals_plain_python(spark, folder):
    wanted = by_hand(spark, folder)
    pieces = sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda r: (str(r.doc_id), r.start))
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    assert 100 < len(wanted) < 230
    tokens = {doc_id: [*library.encode(text, add_special_tokens=False).ids, 1] for doc_id, text in wanted}
    found: dict = {}
    for piece in pieces:
        own = tokens[piece.doc_id][piece.start : piece.start + piece.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == zlib.crc32(bytes(piece.ids))
        assert piece.start == found.get(piece.doc_id, 0)
        found[piece.doc_id] = piece.start + piece.length
    assert found == {doc_id: len(ids) for doc_id, ids in tokens.items()}
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    for (sequence, offset, length), (following, start, _) in zip(places, places[1:], strict=False):
        assert (following, start) == (sequence, offset + length) or (following > sequence and start == 0)
    assert all(offset + length <= packing.WINDOW for _, offset, length in places)
    assert sum(doc_id is None for doc_id in tokens) == 1


def test_a_run_leaves_its_outcome_only(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr("curbline.session.shared_folder", lambda _: str(tmp_path))
    assert corpus_pipeline.run(spark, folder).count() > 0
    left = [p.name.rpartition("-")[0] for p in (tmp_path / "curbline").iterdir()]
    assert left == ["llm-stage-packing"]
