from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import TEXTS, documents, table_dir
from tidewatch.llm import spelling
from tidewatch.llm.spelling import Words, one_apart, op11_spelling


def plain_near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and plain_near(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), None if form[w] is None else words[form[w]]) for w, n in words.items())


def got(spark, tmp_path, texts, ids=None):
    out = op11_spelling(spark, table_dir(tmp_path, documents=documents(spark, texts, ids)))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def noisy_texts(n_docs=60):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéüÉ×ÿ"
    stems = ["".join(rng.choice(["th", "er", "an", "ing", "on", "ti", "é", "es"]) for _ in range(5)) for _ in range(60)]
    stems += ["aaaaaaaa", "abababab", "babababa"]
    texts = []
    for _ in range(n_docs):
        out = []
        for _ in range(300):
            w = rng.choice(stems[: 1 + int(len(stems) * rng.random() ** 3)])
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
            out.append(rng.choice([w, w, w.upper() if w.isascii() else w, w.capitalize() if w[0].isascii() else w]))
        texts.append(rng.choice([" ", ", ", "-", "1", "中"]).join(out))
    return texts


def test_matches_brute_force(spark, tmp_path):
    texts = noisy_texts() + TEXTS
    ids = [i * 7 for i in range(len(texts) - 2)] + [None, 7]
    assert got(spark, tmp_path, texts, ids) == brute(zip(ids, texts))


def test_small_keys_and_blocks_give_the_same(spark, tmp_path, monkeypatch):
    """Deeper keys, crowded keys in blocks, crowded leaves by halves."""
    texts = noisy_texts(30)
    expected = brute(enumerate(texts))
    monkeypatch.setattr(spelling, "KEY_WORDS", 3)
    monkeypatch.setattr(spelling, "KEY_LEVELS", range(3, 5))
    monkeypatch.setattr(spelling, "LEAF_PAIRS", 1)
    assert got(spark, tmp_path, texts) == expected


def test_chains_ties_and_long_words(spark, tmp_path):
    long = "q" * 3000
    words = ["threlyes"] * 2 + ["threlyer"] * 20 + ["threlyar"] * 250 + ["onharent"] * 2 + ["onharens"] * 20 + ["onharenz"] * 20
    words += [long] * 3 + [long + "q"] * 30 + [long[:-1] + "z"] * 2
    texts = [f"{w}" for w in words]
    expected = brute(enumerate(texts))
    assert got(spark, tmp_path, texts) == expected
    found = {r[0]: r[1:3] for r in expected}
    assert found["threlyes"] == ("threlyer", "threlyar")  # two links
    assert found["onharent"][0] == "onharens"  # a tie of n


@pytest.mark.parametrize("texts", [[], [None, "", " "], ["short words only", "1234567 89"]])
def test_no_words(spark, tmp_path, texts):
    assert got(spark, tmp_path, texts) == []


def test_verification():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(200)]
    arr = Words(pa.array([w.encode() for w in words], pa.binary()), np.zeros(256, np.uint8))
    q, m = (x.ravel() for x in np.meshgrid(np.arange(200), np.arange(200)))
    ok = (arr.length[m] - arr.length[q] >= 0) & (arr.length[m] - arr.length[q] <= 1)
    q, m = q[ok], m[ok]
    expected = [plain_near(words[i], words[j]) for i, j in zip(q, m)]
    assert spelling.verified(arr, arr, q, m).tolist() == expected
    assert [one_apart(words[i].encode(), words[j].encode()) for i, j in zip(q, m)] == expected
