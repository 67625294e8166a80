from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import TEXTS, documents, table_dir
from tidewatch.llm.pii import KINDS, base_spans, find, keyed_values, masked, nodes, op2_pii, train


def plain(text):
    """The contract's patterns as they stand."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        s = sum(sum(divmod(x * 2, 10)) if i % 2 else x for i, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    alphabet = "ab1290.@@+-() é\n255"
    for _ in range(20000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == plain(text)
    for text in ["a@b.c@d.e.f", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "300.1.1.1 000255.1.1.1", "x" * 50000, "1" * 50000,
                 "+1 (555) 555-0199 x +1 2", "9" * 5000 + "@" + "é@a.b"]:
        assert base_spans(text) == plain(text)


def test_query_on_odd_texts(spark, tmp_path):
    rows = op2_pii(spark, table_dir(tmp_path, documents=documents(spark))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        base = plain(TEXTS[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(f"{KINDS[k]}:{s}:{e}" for s, k, e in base) <= set(r.spans.split(","))


def test_repeated_mentions_get_one_label(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = train(docs)
    text = "call +1 (988) 555-2485 now, she said. " + "filler words here " * 20 + "again 988-555-2485 or 988 555 2485 today; order 20240117 shipped"
    got = field.spans(text, base_spans(text))
    found = {text[s:e]: KINDS[k] for s, k, e in got}
    assert found["+1 (988) 555-2485"] == "phone"
    assert found.get("988-555-2485") == "phone" and found.get("988 555 2485") == "phone"
    assert "20240117" not in found
    clean = "In 2024, 12345 people and 10,000 dogs saw version 1.2.3 of it"
    assert field.spans(clean, base_spans(clean)) == []


def test_masking_keeps_columns_and_empty_tables(spark):
    docs = documents(spark)
    field = train(docs.limit(0))
    out = masked(docs, field)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[3] is None and "bob.smith" not in texts[11] and "4111" not in texts[11]
    assert find(docs.limit(0), field).count() == 0


def test_nodes_are_linear_in_unbroken_runs():
    import time

    began = time.process_time()
    text = "x" * 1_000_000 + " 12345 " + "y" * 500_000 + "7"
    assert [text[a:b] for a, b, _ in nodes(text, [])] == ["12345"]
    assert time.process_time() - began < 1


def test_secrets_are_found_by_name_and_where_they_repeat(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = train(docs)
    secret = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    text = f'set token = "{secret}" once. ' + "filler words here " * 20 + f"then send {secret}, or the sum 1f0c27b54ad998e2b0c1d7a6f35e8842ab90cd17"
    found = [text[s:e] for s, k, e in field.spans(text, base_spans(text)) if KINDS[k] == "secret"]
    assert found == [secret, secret]
    for clean in ("the key: something.else.entirely.long", "token = 12345", "monkey = a1b2c3d4e5f6a7b8c9d0", "key = 4111 1111"):
        assert keyed_values(clean) == []
    assert [k for _, k, _ in keyed_values('API_KEY="Ab3_0123456789abcdef".')] == [KINDS.index("secret")]
    assert len(keyed_values("token=" + "a1" * 500_000)) == 1


def test_the_planted_kinds_are_caught(spark):
    """Every document of the table with a keyed value or a base span has a span, others with no sign have none."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = find(docs, train(docs)).join(docs.select("doc_id", "text"), "doc_id").collect()
    named = [r for r in out if re.search(r"(?i)token = \"[0-9a-f]{40}\"", r.text or "")]
    assert len(named) > 10 and all("secret:" in r.spans for r in named)
    assert all(r.n_spans == len([x for x in r.spans.split(",") if x]) for r in out)
    assert all(r.n_spans == 0 for r in out if not re.search("[0-9@]", r.text or ""))


def test_repeated_rows_and_more_columns(spark):
    docs = documents(spark)
    wide = docs.union(docs).withColumn("spans", F.lit("x")).withColumn("n_email", F.lit(9)).withColumn("value", F.lit(1))
    field = train(wide)
    once = sorted(map(tuple, find(docs, field).collect()), key=str)
    assert sorted(map(tuple, find(wide, field).collect()), key=str) == sorted(once + once, key=str)
    assert masked(wide, field).columns == wide.columns
