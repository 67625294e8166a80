from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import documents, table_dir
from tidewatch.llm.packing import ChunkEncoder, RankEncoder, op5_packing, pack, public_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_hold_every_id_once(spark, tmp_path):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = [r.asDict() for r in op5_packing(spark, table_dir(tmp_path, documents=docs)).collect()]
    for d, text in texts.items():
        ids = reference_ids(text)
        own = sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["start"])
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert sum(r["length"] for r in own) == len(ids)
        for r in own:
            piece = np.asarray(ids[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(piece)
            assert r["doc_tokens"] == len(ids)
            assert r["boundary"] == (len(own) > 1)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s, parts in by.items():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts])[:-1])
        assert sum(p[1] for p in parts) == 1024 or s == max(by)


def test_chunk_cuts_do_not_change_ids():
    texts = ["a  b", "  a", "a \n b", " \n", "x  \t y  ", "it's  we'll 12 3 ", "<|endoftext|> a <|endoftext|>b", "a <b   c", "", " "]
    encoder = ChunkEncoder(PATH, cache_chunks=3)
    for _ in range(3):
        for t, raw in zip(texts, encoder.encode_many(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == reference_ids(t)[:-1]


def test_both_encoders_agree():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    texts += ["a  b", " \n", "it's  we'll 12 3 ", "<|endoftext|> a", "日本 и x", "", "x" * 3000, "\u00a0 \u2003 a\u0085b"]
    own = RankEncoder(PATH, *public_vocabulary()[4])
    for t, raw in zip(texts, own.encode_many(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == reference_ids(t)[:-1]


def test_empty_table_and_repeated_rows(spark):
    assert pack(documents(spark, []), PATH).count() == 0
    twice = pack(documents(spark, ["same text", "same text"], [5, 5]), PATH, window=2)
    assert twice.count() >= 4
    assert {r.doc_id for r in twice.collect()} == {5}
    missing = pack(documents(spark, ["a b", "c"], [None, 1]), PATH).collect()
    assert {r.doc_id for r in missing} == {None, 1}


@pytest.mark.parametrize("window", [1, 7, 64])
def test_sequences_are_gapless(spark, window):
    got = pack(documents(spark), PATH, window=window).collect()
    total = sum(r.length for r in got)
    assert max(r.sequence_id for r in got) == (total - 1) // window
