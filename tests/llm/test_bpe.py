from __future__ import annotations

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tests.llm.helpers import TEXTS, documents, table_dir
from tidewatch.llm.bpe import BytePairCodec, Merger, RankQueue, encode, op10_bpe, read_ranks

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_query_matches_the_library(spark, tmp_path, library):
    texts = TEXTS + ["aaaaaaa " + "ab" * 3000, "0" * 4000, "!?" * 999, " \n \n\t  x", "ﬀ ǆ ½ x²", "it's we'll I'd"]
    rows = op10_bpe(spark, table_dir(tmp_path, documents=documents(spark, texts))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_real_texts_match(library):
    import pyarrow.parquet as pq

    own = BytePairCodec(PATH, P.PATTERN, cache_chunks=50)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    for text, ids, digest in zip(texts, own.encode_many(texts), own.digest_many(texts)):
        assert ids == library.encode_ordinary(text)
        assert digest[0] == len(ids)


def test_merges_with_ranks_in_any_order():
    """Ranks whose merges may open a smaller rank: same as plain repeated search."""
    rng = random.Random(5)
    for _ in range(300):
        words = {bytes([c]): 9000 + c for c in b"abc"}
        for _ in range(12):
            words.setdefault(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))), rng.randrange(9000))
        if len(set(words.values())) < len(words):
            continue
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 20))) for _ in range(5)]
        want = []
        for raw in pieces:
            parts = [raw[i:i + 1] for i in range(len(raw))]
            while raw not in words:
                best = min(((words.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 30, 0))
                if best[0] == 1 << 30:
                    break
                parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            want.append([words[raw]] if raw in words else [words[p] for p in parts])
        assert Merger(words).ids(pieces) == want
        assert Merger(words).one_by_one(pieces) == want


def test_queue_gives_least_rank_and_leftmost_place():
    q = RankQueue()
    for rank, at in [(70000, [1]), (3, [9, 2]), (64, [5]), (4097, [0])]:
        q.push(rank, at)
    out = []
    while q.first() >= 0:
        r = q.first()
        out.append((r, q.take(r)))
    assert out == [(3, [9, 2]), (64, [5]), (4097, [0]), (70000, [1])]


def test_small_tables(spark):
    assert encode(documents(spark, []), PATH, P.PATTERN).count() == 0
    rows = encode(documents(spark, [None, "", "same", "same"], [None, 1, 2, 2]), PATH, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in rows) == [(0, b""), (1, b""), (2, b"same"), (2, b"same")]
