from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import table_dir
from tests.llm.test_packing import reference_ids
from tests.llm.test_pii import plain
from tests.llm.test_toxicity import BAD, corpus
from tidewatch.llm.pii import base_spans

PASSAGE = " ".join(f"passage{i}" for i in range(60))


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Every stage's rows on a corpus with planted cases."""
    texts, toxic = corpus(450)
    base = " ".join(f"page{i}" for i in range(80))
    clean = [base, base, base.replace("page40", "other"), base + " mail ann@host.example.org ip 10.1.2.3",
             "first words here " + PASSAGE + " and an ending", "quite another start ü with words of its own kind, not so few " + PASSAGE + " then the rest, which goes on for a while so that the two differ ß",
             None, "", "a", "   ", "call +1 (555) 555-0123 or 555-555-0123 now " + "plain text goes on " * 5]
    rows = [(i, t, "en", "s", len(t or ""), "extra") for i, t in enumerate(texts + clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    sf = table_dir(tmp_path_factory.mktemp("pipe"), documents=docs, labels=labels)
    cur, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / f"{k}.parquet")
        got = stage(spark, cur, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert got.schema.simpleString() == cur.schema.simpleString()
        got.write.parquet(path)
        cur = spark.read.parquet(path)
        out.append({"name": name, "rows": cur.collect()})
    run = corpus_pipeline.run(spark, sf).collect()
    return texts, toxic, clean, out, run


def texts_of(stage):
    return {r.doc_id: r.text for r in stage["rows"]}


def test_toxic_documents_go(results):
    texts, toxic, clean, out, _ = results
    left = texts_of(out[0])
    assert sum(d in left for d, t in enumerate(toxic) if t) <= 0.02 * sum(toxic)
    assert sum(d not in left for d, t in enumerate(toxic) if not t) <= 0.01 * len(toxic)
    assert all(len(texts) + i in left for i in range(len(clean)))


def test_one_document_of_each_group_stays(results):
    texts, _, clean, out, _ = results
    n = len(texts)
    before, left = texts_of(out[0]), texts_of(out[1])
    assert n in left and n + 1 not in left and n + 2 not in left and n + 3 not in left
    sets = {d: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for d, t in before.items() if t}
    for d in set(before) - set(left):  # what went is linked, through others, to what stayed
        assert any(e < d and len(sets[d] & sets[e]) >= 0.8 * len(sets[d] | sets[e]) for e in sets)
    kept = [d for d in left if sets.get(d)]
    assert not any(a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a in kept for b in kept)
    assert all(left[d] == before[d] for d in left)


def test_passages_of_earlier_documents_go(results):
    texts, _, _, out, _ = results
    n = len(texts)
    before, left = texts_of(out[1]), texts_of(out[2])
    assert left[n + 4] == before[n + 4]
    assert "passage30" not in left[n + 5] and left[n + 5].startswith("quite another start ü") and left[n + 5].endswith("the two differ ß")
    raw = {d: (t or "").encode() for d, t in before.items()}
    seen = {}
    for d in sorted(raw):
        for i in range(len(raw[d]) - 99):
            seen.setdefault(raw[d][i:i + 100], d)
    for d, t in before.items():
        repeated = any(seen[raw[d][i:i + 100]] < d for i in range(len(raw[d]) - 99))
        if not repeated:
            assert left[d] == t
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out[2]["rows"])


def test_personal_data_is_masked(results):
    texts, _, _, out, _ = results
    before, left = texts_of(out[2]), texts_of(out[3])
    assert set(before) == set(left)
    for d, t in before.items():
        if t and plain(t):
            assert left[d] != t and not base_spans(left[d])
        elif t is None or not any(c.isdigit() or c == "@" for c in t):
            assert left[d] == t
    assert left[len(texts) + 10].startswith("call [PHONE] or")


def test_packing_holds_all_that_is_left(results):
    _, _, _, out, run = results
    left = texts_of(out[3])
    pieces = {}
    for r in out[4]["rows"]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(left)
    for d, own in pieces.items():
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in sorted(own, key=lambda r: r.start)), "<u4").tolist()
        assert ids == reference_ids(left[d])
    assert len(BAD) and {r.doc_id for r in run} == set(left)
    assert sum(r.length for r in run) == sum(r.length for r in out[4]["rows"])
