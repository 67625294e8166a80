from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import TEXTS, documents, table_dir
from tidewatch.llm import jaccard_join as J
from tidewatch.llm.common import connected_components, id_bitmap, xxhash64_long
from tidewatch.llm.shingles import shingle_sets
from tidewatch.session import stage_table


def plain_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)])


def brute(ids, texts):
    """(n_shingles, component) of each row, from all pairs."""
    sets = [plain_set(t) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and ids[i] is not None and ids[j] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), len(s), str(None if d is None else least[find(i)])) for i, (d, s) in enumerate(zip(ids, sets)))


def near_copies(seed, n=260):
    """Originals of all lengths with copies that lose or swap a few words."""
    rng = random.Random(seed)
    texts = []
    while len(texts) < n:
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 10, 13, 17, 24, 33, 50, 90, 160, 400]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], [f"x{rng.randrange(99)}"], w[k:k + 1] * 2])
                w = w or ["a"]
            texts.append(" ".join(w))
    return texts


def rows_of(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    texts = near_copies(seed)
    ids = random.Random(seed).sample(range(10_000), len(texts))
    assert rows_of(J.join_groups(documents(spark, texts, ids))) == brute(ids, texts)


def test_hot_template_and_copies(spark, monkeypatch):
    """Copies of one page with edits that pass the threshold only now and then."""
    monkeypatch.setattr(J, "BLOCK", 16)
    monkeypatch.setattr(J, "SMALL", 8)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = ["short text of five words"] * 200
    for _ in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    assert rows_of(J.join_groups(documents(spark, texts, ids))) == brute(ids, texts)


def test_odd_rows_through_the_query(spark, tmp_path):
    texts = TEXTS + ["same", "SAME", "Été is", "été is"]
    ids = list(range(len(texts) - 1)) + [None]
    df = J.op9_jaccard_join(spark, table_dir(tmp_path, documents=documents(spark, texts, ids)))
    assert rows_of(df) == brute(ids, texts)
    assert J.join_groups(documents(spark, [])).count() == 0
    twice = documents(spark, ["a b c d e"] * 3 + [None] * 2, [7, 7, 3, 9, 9])
    assert rows_of(J.join_groups(twice)) == sorted([("7", 2, "3")] * 2 + [("3", 2, "3")] + [("9", 0, "9")] * 2)


def test_every_link_shares_a_signature():
    """Sets at the threshold of every size, in and across bands."""
    rng = np.random.default_rng(4)
    bands = J.Bands()
    for n in [*range(1, 80), 120, 333, 900, 2000]:
        for _ in range(4):
            a = np.unique(rng.integers(0, 1 << 62, size=n, dtype=np.uint64))
            b = a
            while True:  # take away and add elements as long as the pair stays linked
                c = np.unique(np.concatenate([np.delete(b, rng.integers(len(b))) if rng.random() < 0.6 and len(b) > 1 else b,
                                              rng.integers(0, 1 << 62, size=rng.integers(0, 2), dtype=np.uint64)]))
                if not J._linked(a, c, bands) or len(c) > 2 * n:
                    break
                b = c
            who, sig = J.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), bands)
            assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())
            x, y = (np.frombuffer(k, np.uint64)[None] for k in J.sketches(np.concatenate([a, b]), np.array([len(a), len(b)])))
            short = min(x.shape[1], y.shape[1])
            assert J._may_link(J._folded(x, short), J._folded(y, short), len(a), len(b), bands).all()


def test_shingles_match_plain_sets():
    rng = random.Random(1)
    texts = ["", "a", "A B", "a b c d", "x\x0by\x1fz q r", "  t "] + [" ".join(rng.choice("abcd") for _ in range(rng.randrange(30))) for _ in range(80)]
    values, sizes = shingle_sets(texts)
    sets = [set(v.tolist()) for v in np.split(values, np.cumsum(sizes)[:-1])]
    plain = [plain_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    assert all(len(sets[i] & sets[j]) == len(plain[i] & plain[j]) for i in range(len(texts)) for j in range(i))


def test_components_and_bitmap_helpers(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (2, 9), (20, 21), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, stage_table).collect()}
    assert {n: got.get(n, n) for n in (2, 3, 4, 5, 9, 20, 21, 7)} == {2: 2, 3: 2, 4: 2, 5: 2, 9: 2, 20: 20, 21: 20, 7: 7}
    ids = [0, -5, 3, 10**15]
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    assert [r[0] % (1 << 64) for r in df.select(F.xxhash64("x")).collect()] == xxhash64_long(np.array(ids)).tolist()
    assert id_bitmap(df, "x")(np.array(ids)).all()
    assert id_bitmap(df, "x")(np.arange(1000, 3000)).sum() < 20


def test_sketches_of_linked_sizes_are_compared_at_every_threshold():
    for numerator in (10, 30, 45, 50, 60, 80, 85, 100):
        bands = J.Bands(numerator, 100)
        small = np.arange(1, 50_000)
        ratio = J.sketch_words(small * 100 // numerator) / J.sketch_words(small)
        assert ratio.max() <= bands.reach < 4 * 100 / numerator
    assert J.Bands(85, 100).reach == J.Bands(80, 100).reach == 2


@pytest.mark.parametrize("same", [True, False])
def test_blocks_hold_every_pair_and_few_copies(spark, monkeypatch, same):
    monkeypatch.setattr(J, "BLOCK", 4)
    rng = np.random.default_rng(3)
    m, bands = 400, J.Bands(85, 100)
    base = rng.integers(0, 1 << 63, size=(2, 32), dtype=np.uint64)
    words = np.array([base[i % 2][:32 if i % 5 else 16] for i in range(m)], dtype=object)
    rows = [(i, 100 if i % 5 else 50, bytearray(np.asarray(w, dtype=np.uint64).tobytes())) for i, w in enumerate(words)]
    about = spark.createDataFrame(rows, "doc long, n long, sketch binary")
    large = spark.range(m).select(F.lit(7).cast("long").alias("sig"), F.col("id").alias("doc"), (F.lit(0) if same else F.col("id")).cast("long").alias("comp"))
    got = [tuple(r) for r in J._in_blocks(large, about, bands).collect()]
    expected = set()
    for a in range(1, m):  # the least document met the others as the centre of the first star
        x, nx = np.frombuffer(bytes(rows[a][2]), np.uint64), rows[a][1]
        for b in range(a + 1, m):
            y, ny = np.frombuffer(bytes(rows[b][2]), np.uint64), rows[b][1]
            if not same and max(len(x), len(y)) <= bands.reach * min(len(x), len(y)):
                k = min(len(x), len(y))
                if J._may_link(J._folded(x[None], k), J._folded(y[None], k), np.array([nx]), np.array([ny]), bands)[0]:
                    expected.add((a, b))
    assert set(got) == expected and (same or expected)


def test_copies_grow_by_the_root_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    copies = {}

    class Seen(Exception):
        pass

    def count(self, *_):
        copies["n"] = self._df.count()
        raise Seen

    from pyspark.sql.group import GroupedData
    monkeypatch.setattr(GroupedData, "applyInPandas", count)
    about = spark.range(1600).select(F.col("id").alias("doc"), F.lit(9).cast("long").alias("n"), F.lit(b"12345678").alias("sketch"))
    made = []
    for m in (400, 1600):
        large = spark.range(m).select(F.lit(7).cast("long").alias("sig"), F.col("id").alias("doc"), F.col("id").alias("comp"))
        with pytest.raises(Seen):
            J._in_blocks(large, about, J.Bands(85, 100))
        made.append(copies["n"])
    assert made == [399 * 10, 1599 * 20]


def test_rarest_elements_of_linked_sets_meet():
    """Whatever the levels say, and at any threshold: linked sets have a taken element in common."""
    rng = np.random.default_rng(8)
    for numerator in (30, 80, 85, 100):
        bands = J.Bands(numerator, 100)
        for n in [*range(1, 40), 100, 333, 1200]:
            a = np.unique(rng.integers(0, 1 << 62, size=n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[:max(1, -(-numerator * len(a) // 100))]], a[:0]]))
            assert J._linked(a, b, bands)
            values, sizes = np.concatenate([a, b]), np.array([len(a), len(b)])
            level = (values % np.uint64(7)).astype(np.uint8) * (rng.random() < 0.7)
            who, element = J.rarest(values, sizes, level, bands)
            first, second = set(element[who == 0].tolist()), set(element[who == 1].tolist())
            assert first & second and first <= set(a.tolist()) and second <= set(b.tolist())
            assert np.bincount(who).tolist() == [len(s) - -(-numerator * len(s) // 100) + 1 for s in (a, b)]
    left_out = J.rarest(np.array([1, 2, 3, 4], np.uint64), np.array([0, 4]), np.array([3, 0, 1, 0], np.uint8), J.Bands(75, 100))
    assert [x.tolist() for x in left_out] == [[1, 1], [2, 4]]


def test_common_lines_do_not_bring_documents_together(spark, monkeypatch):
    """Documents of which a third is a line that very many have: only near copies are compared in blocks."""
    monkeypatch.setattr(J, "SMALL", 2)
    rng = random.Random(5)
    lines = [" ".join(f"c{k}x{i}" for i in range(30)) for k in range(2)]
    texts = []
    for _ in range(500):
        own = [f"u{rng.randrange(10**7)}" for _ in range(60)]
        line = rng.choice(lines)
        for _ in range(rng.choice([1, 1, 1, 2, 5])):
            w = list(own)
            for _ in range(rng.choice([0, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"v{rng.randrange(10**7)}"
            texts.append(" ".join(w) + "\n" + line)
    texts += lines + [lines[0] + " " + lines[1]]
    ids = random.Random(2).sample(range(10_000), len(texts))
    blocks, met = J._in_blocks, []
    monkeypatch.setattr(J, "_in_blocks", lambda large, about, bands: (met.append(large.groupBy("sig").count().collect()), blocks(large, about, bands))[1])
    assert rows_of(J.join_groups(documents(spark, texts, ids))) == brute(ids, texts)
    assert max([0, *(r["count"] for r in met[0])]) <= 10


def test_chained_groups_meet_apart(spark, monkeypatch):
    """Groups that share a document each with the next one: no pairs of all of them."""
    bands, made = J.Bands(85, 100), {}
    rows = [(g, g * 9 + i, g * 9 + i) for g in range(60) for i in range(10)]
    large = spark.createDataFrame(rows, "sig long, doc long, comp long")
    about = spark.range(600).select(F.col("id").alias("doc"), F.lit(9).cast("long").alias("n"), F.expr("repeat('12345678', 16)").cast("binary").alias("sketch"))

    from pyspark.sql.group import GroupedData
    run = GroupedData.applyInPandas

    def count(self, *args):
        made["pairs"] = sum(r["count"] ** 2 for r in self._df.groupBy([c for c in ("whole", "component", "bi", "bj") if c in self._df.columns]).count().collect())
        return run(self, *args)

    monkeypatch.setattr(GroupedData, "applyInPandas", count)
    got = {tuple(r) for r in J._in_blocks(large, about, bands).collect()}
    assert made["pairs"] <= 60 * 10**2
    assert got >= {(x, y) for g in range(60) for x in range(g * 9 + 1, g * 9 + 10) for y in range(x + 1, g * 9 + 10)}
