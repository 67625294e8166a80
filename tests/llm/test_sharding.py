from __future__ import annotations

import zlib

import pytest

from tests.llm.helpers import documents, table_dir
from tidewatch.llm.sharding import op3_sharding, shard


def check(rows, texts, n=8):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))
    assert len(rows) == len(texts)


def test_slots_sizes_checksums(spark, tmp_path):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op3_sharding(spark, table_dir(tmp_path, documents=docs)).collect()
    check(rows, texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert (r.law, r.grown_shard) == ("bytes", None)


@pytest.mark.parametrize("copies", [0, 1500, 3000])
def test_near_equal_bytes_with_a_hot_text(spark, copies):
    texts = [f"text number {i} " * (1 + i % 7) for i in range(3000)] + ["the same text again and again"] * copies
    rows = shard(documents(spark, texts)).collect()
    check(rows, texts)
    size = [0] * 8
    where = {}
    for r in rows:
        size[r.shard] += r.size
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    mean = sum(size) / 8
    assert max(size) < 1.03 * mean and min(size) > 0.97 * mean
    assert sum(len(s) > 1 for s in where.values()) <= 8


def test_repeated_rows_and_empty_table(spark):
    assert shard(documents(spark, [])).count() == 0
    rows = shard(documents(spark, ["x"] * 40, [None] * 40)).collect()
    check(rows, ["x"] * 40)
    assert {sum(r.shard == s for r in rows) for s in range(8)} == {5}


def test_copies_stay_together_in_overfull_ranges(spark):
    texts = [f"text number {i} " * (1 + i % 3) for i in range(1500)] * 2 + ["the same text again and again"] * 600
    rows = shard(documents(spark, texts), sample_size=4).collect()
    check(rows, texts)
    size, where = [0] * 8, {}
    for r in rows:
        size[r.shard] += r.size
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert max(size) < 1.03 * sum(size) / 8 and min(size) > 0.97 * sum(size) / 8
    assert all(len(s) == 1 for t, s in where.items() if t != texts[-1])
    assert len(where[texts[-1]]) <= 3
