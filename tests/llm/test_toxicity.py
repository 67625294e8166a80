from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, table_dir
from tidewatch.llm.toxicity import op7_toxicity, train, with_score

BAD = ["zorgblat", "krumphead", "snivelfink"]


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ba", "ti", "lo", "ren", "sun", "mer", "dof"]) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        texts.append(" ".join(w))
        toxic.append(int(bad))
    return texts, toxic


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    texts, toxic = corpus()
    extra = [None, "", "...", "ti lo zorgblatt ren krumphaed sun snivelfinks dof", "ti lo ren sun dof mer", "zorgblat " * 20000]
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(3, 0, None), (10**6, 0, 1), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    sf = table_dir(tmp_path_factory.mktemp("tox"), documents=documents(spark, texts + extra), labels=labels)
    return {r.doc_id: r for r in op7_toxicity(spark, sf).collect()}, toxic


def test_held_out_accuracy(scored):
    rows, toxic = scored
    held = [i for i in range(len(toxic)) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i].held_out for i in held)
    assert sum(rows[i].predicted == toxic[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_misspellings_and_empty_texts(scored):
    rows, toxic = scored
    n = len(toxic)
    assert rows[n].score == rows[n + 1].score == rows[n + 2].score
    assert rows[n + 3].predicted == 1 and rows[n + 4].predicted == 0 and rows[n + 5].predicted == 1


def test_tables_without_examples(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert train(docs, none, F.lit(True)) is None
    assert {r.score for r in with_score(docs, None).collect()} == {0.0}
    one = spark.createDataFrame([(1, 0, 1), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert train(docs, one, F.lit(True)) is None


def test_long_tailed_vocabulary(spark, tmp_path):
    rng = random.Random(9)
    common, rare, insults = (["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(6, 10))) for _ in range(n)]
                             for n in (150, 400, 240))
    texts, toxic = [], []
    for i in range(1200):
        bad = i % 3 == 0
        w = [rng.choice(common) for _ in range(rng.randint(15, 30))] + rng.sample(rare, 4) + rng.sample(insults if bad else rare, 4)
        rng.shuffle(w)
        texts.append(" ".join(w))
        toxic.append(int(bad))
    learned = [set(t.split()) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sum(sum(w in t for t in learned) < 0.01 * len(learned) for w in insults) >= 200
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    rows = op7_toxicity(spark, table_dir(tmp_path, documents=documents(spark, texts), labels=labels)).filter("held_out").collect()
    bad = [r.predicted for r in rows if toxic[r.doc_id]]
    good = [r.predicted for r in rows if not toxic[r.doc_id]]
    assert sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.01 * len(good)
