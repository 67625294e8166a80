from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import documents, table_dir
from tidewatch.llm.common import fold
from tidewatch.llm.langid import Hyperspace, op4_langid, predict, train


def test_vectors_match_plain_binding():
    space = Hyperspace(dimensions=64, seed=3)
    texts = ["Abc, déf!  g", "", "1 2 3", "x", "日本 и"]
    got = space.vectors(texts)
    for text, row in zip(texts, got):
        symbols = [0]
        for c in text.lower() + " ":
            s = int(space.symbol[ord(c)])
            if s or symbols[-1]:
                symbols.append(s)
        want = np.zeros(64)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            want += np.roll(space.last[a], 2) * np.roll(space.last[b], 1) * space.last[c]
        assert np.array_equal(row, want)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op4_langid(spark, sf).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [d for d in rows if rows[d].held_out]
    assert sum(rows[d].lang_pred == truth[d] for d in held) >= 0.97 * len(held)


def test_odd_rows(spark, tmp_path):
    texts = ["the cat and the dog", "der Hund und die Katze"] * 6 + [None, "", "123 !?", "der Hund", "der Hund", "word " * 30000]
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    rows = {r.doc_id: r for r in op4_langid(spark, table_dir(tmp_path, documents=docs)).collect()}
    assert [rows[i].lang_pred for i in (12, 13, 14)] == ["und"] * 3 and rows[12].score == 0.0
    assert rows[15].lang_pred == rows[16].lang_pred == "de"
    empty = docs.limit(0)
    langs, prototypes = train(empty, fold() != 1)
    assert langs == [] and predict(empty, langs, prototypes).count() == 0
    assert {r.lang_pred for r in predict(docs, langs, prototypes).collect()} == {"und"}


def test_rare_languages_of_a_large_table_are_learned(spark):
    rare = F.col("id") < 6
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(rare, F.concat(F.lit("l"), "id")).otherwise("en").alias("lang"),
                                      F.when(rare, F.lit("zq xv kj")).otherwise("the cat").alias("text"))
    assert train(docs, F.lit(True))[0] == ["en", *(f"l{i}" for i in range(6))]


def test_blocks_bound_memory_and_change_nothing(monkeypatch):
    import random
    import tracemalloc

    from tidewatch.llm import langid

    rng = random.Random(5)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(400)) for _ in range(2_500)] + ["", "123"]
    space = langid.hyperspace(langid.DIMENSIONS, langid.SEED)
    tracemalloc.start()
    whole = space.vectors(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
    monkeypatch.setattr(langid, "CELLS", 100_000)
    assert np.array_equal(space.vectors(texts[:40] + texts[-2:]), np.concatenate([whole[:40], whole[-2:]]))


def test_repeated_rows_and_more_columns(spark):
    docs = spark.createDataFrame([(0, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"), (3, None, "en")],
                                 "doc_id long, text string, lang string").withColumn("score", F.lit(7)).withColumn("bundle", F.lit("x"))
    langs, prototypes = train(docs.union(docs), F.lit(True))
    assert langs == ["de", "en"]
    once = sorted(map(tuple, predict(docs, langs, prototypes).collect()))
    assert sorted(map(tuple, predict(docs.union(docs), langs, prototypes).collect())) == sorted(once + once)
    assert [r[2] for r in once] == ["en", "de", "und"]
