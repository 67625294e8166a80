from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import TEXTS, documents, table_dir
from tidewatch.llm import fingerprint as fp


def edited_texts(rows):
    """Brute force: the last third replaced by the head of the next text, ids descending."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        out[d] = t[:len(t) - k] + nxt[:k]
    return out


@pytest.mark.parametrize("per_bucket", [1, 2, 500])
def test_edits_follow_descending_ids(spark, tmp_path, monkeypatch, per_bucket):
    monkeypatch.setattr(fp, "ROWS_PER_BUCKET", per_bucket)
    ids = [3 * i - 7 for i in range(len(TEXTS))]
    rows = fp.op1_fingerprint(spark, table_dir(tmp_path, documents=documents(spark, TEXTS, ids))).collect()
    want = edited_texts(list(zip(ids, TEXTS)))
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        assert r.n_chars == len(TEXTS[ids.index(r.doc_id)] or "")
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by = {}
    for r in rows:
        by.setdefault(TEXTS[ids.index(r.doc_id)] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())


def test_estimates_are_near_the_true_values(spark):
    a = [f"w{i}" for i in range(4000)]
    b = a[:3000] + [f"v{i}" for i in range(1000)]
    c = a[100:400]

    def shingles(w):
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    sa, sb, sc = shingles(a), shingles(b), shingles(c)
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(c))], "a string, b string, c string")
    for x in "abc":
        df = fp.with_sketch(df, x, f"s{x}")
    df = fp.with_likeness(df, "sa", "sb", "ab", "a_in_b")
    df = fp.with_likeness(df, "sc", "sa", "ca", "c_in_a")
    df = df.withColumn("m", fp.merge(F.col("sa"), F.col("sb")))
    df = fp.with_sketch(df.withColumn("u", F.lit(" ".join(a))), "u", "su")
    r = df.first()
    assert abs(r.ab - len(sa & sb) / len(sa | sb)) < 0.06
    assert abs(r.c_in_a - len(sc & sa) / len(sc)) < 0.05
    assert sorted(set(r.sa) | set(r.sb)) == r.m and r.su == r.sa


def test_small_tables(spark):
    assert fp.fingerprints(documents(spark, [])).count() == 0
    one = fp.fingerprints(documents(spark, ["only one text here now"])).first()
    assert one.near_next == 1.0
    rows = fp.fingerprints(documents(spark, ["p q r", None, "", "p q r"], [None, 4, 4, 4])).collect()
    assert len(rows) == 4
