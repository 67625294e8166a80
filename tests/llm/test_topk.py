from __future__ import annotations

import math

import numpy as np
import pytest

from tests.llm.helpers import table_dir
from tidewatch.llm import topk
from tidewatch.llm.topk import op8_topk


def brute(rows):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in kept if i % 100 == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q)[:10]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def got(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, label int, ring string")
    return sorted(tuple(r) for r in op8_topk(spark, table_dir(tmp_path, embeddings=df)).select("query_id", "rank", "vec_id", "score").collect())


def test_matches_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=16)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(400)]  # a hot vector
    rows += [(3000, None), (3001, [1.0, None]), (3100, [float("nan")] * 16), (3200, [float("inf")] * 16), (3300, []),
             (3400, [0.5, 0.25]), (100, rows[100][1]), (3500, [0.0] * 16), (None, [1.0])]
    assert got(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, [1.0]), (100, [2.0]), (5, [-3.0])], [(0, [1e6, 1e6]), (1, [1e6, -1.0])]])
def test_small_tables(spark, tmp_path, rows):
    assert got(spark, tmp_path, rows) == brute(rows)


def test_lifted_vectors_have_one_length():
    rng = np.random.default_rng(2)
    index = topk.Index(np.zeros((1, 3)), 4.0, np.zeros((1, 0)))
    p = index.lifted(rng.uniform(-1, 1, size=(50, 2)))
    assert np.allclose((p**2).sum(axis=1), 4.0)


def test_one_id_with_two_vectors_is_answered_for_each(spark, tmp_path):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 2.0]), (100, [1.0, 0.0])]
    assert got(spark, tmp_path, rows) == brute(rows) == sorted(
        [(100, 1, 1, 3 << 20), (100, 2, 2, 1 << 20), (100, 1, 2, 2 << 20), (100, 2, 1, 1 << 20)])


def test_ties_go_to_the_smaller_id_and_extra_columns_do_not_matter(spark, tmp_path):
    rows = [(i, [1.0]) for i in range(40)] + [(100, [1.0]), (200, [-1.0])]
    assert got(spark, tmp_path, rows) == brute(rows)
    df = spark.createDataFrame([(i, [1.0], 1, 2, 3) for i in (0, 7, 5)], "vec_id long, embedding array<float>, id int, v int, q int")
    found = op8_topk(spark, table_dir(tmp_path / "clashing", embeddings=df)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 5, 1 << 20), (0, 2, 7, 1 << 20)]


def test_scores_that_do_not_fit_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="long"):
        got(spark, tmp_path, [(0, [1e30]), (1, [1.0])])
