from __future__ import annotations

import math

import numpy as np
import pytest

from tests.llm.helpers import table_dir
from tidewatch.llm import whitening
from tidewatch.llm.whitening import bidiagonalise, op12_whitening


def got(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, label int, width string, rows int")
    return op12_whitening(spark, table_dir(tmp_path, embeddings=df)).toPandas()


def plain(rows):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    d = max(len(v) for _, v in kept)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in list(v) + [0.0] * (d - len(v))] for _, v in kept]
    n, sums = len(x), [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    c = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(32, int((e > 1e-18 * e[0]).sum()))
    return [i for i, _ in kept], n, deviation, c @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def same(out, rows):
    ids, n, deviation, white, explained = plain(rows)
    k = white.shape[1]
    assert len(out) == n * k and (out.n == n).all() and (out.identity_error < 1e-8).all()
    out = out.sort_values(["deviation", "vec_id", "component"], kind="stable")
    order = sorted(range(n), key=lambda r: (deviation[r], math.inf if ids[r] is None else ids[r]))
    assert out.deviation.to_numpy().reshape(n, k)[:, 0].tolist() == [deviation[r] for r in order]
    assert out.component.to_numpy().reshape(n, k).tolist() == [list(range(1, k + 1))] * n
    assert np.allclose(out.explained.to_numpy().reshape(n, k), explained, rtol=1e-9)
    a, b = out.whitened.to_numpy().reshape(n, k), white[order]
    sign = np.sign((a * b).sum(axis=0))
    assert np.abs(a * sign - b).max() < 1e-7


def test_matches_the_covariance(spark, tmp_path):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(40, 40)) * 0.9 ** np.arange(40)
    rows = [(i, (3 + rng.normal(size=40) @ mix).tolist()) for i in range(900)]
    rows += [(None, rows[5][1]), (5, rows[6][1]), (901, rows[7][1][:30]), (902, []), (903, None), (904, [1.0, None]), (905, [float("nan")]),
             (906, [float("inf")])]
    same(got(spark, tmp_path, rows), rows)


def test_few_dimensions_and_hot_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 16)  # many small blocks
    rng = np.random.default_rng(2)
    rows = [(i, [x, 5.0, -x + 0.1 * y]) for i, (x, y) in enumerate(rng.normal(size=(60, 2)))]  # the second entry never varies
    rows += [(100 + i, [0.5, 5.0, 0.25]) for i in range(40)]
    same(got(spark, tmp_path, rows), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3])
def test_nothing_varies(spark, tmp_path, rows):
    out = got(spark, tmp_path, rows)
    assert not len(out) and len(out.columns) == 7


def local(x):
    return lambda w: (float((x @ w) @ (x @ w)), x.T @ (x @ w)), lambda m: (x @ m).T @ (x @ m)


def test_repeated_and_tiny_singular_values():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(300, 50)))
    r, _ = np.linalg.qr(rng.normal(size=(50, 50)))
    values = np.array([5.0] * 4 + [3.0] * 4 + [1.0] * 20 + [1e-3] * 10 + [1e-4] * 5 + [1e-9] * 2 + [0.0] * 5)
    sigma, v = bidiagonalise(*local(q * values @ r), 50, 45)
    assert len(sigma) == 43 and np.allclose(sigma, values[:43], rtol=1e-9)
    assert np.allclose(v @ v.T, np.eye(43), atol=1e-12)


def test_stops_early_on_wide_vectors():
    rng = np.random.default_rng(4)
    steps = []
    x = rng.normal(size=(2000, 400)) * np.concatenate([0.8 ** np.arange(60), np.full(340, 1e-7)])

    def counted(w):
        steps.append(1)
        return local(x)[0](w)

    sigma, v = bidiagonalise(counted, local(x)[1], 400, 8)
    true, right = np.linalg.svd(x, full_matrices=False)[1:]
    assert len(steps) < 100 and np.allclose(sigma, true[:8], rtol=1e-12)
    assert np.allclose(np.abs((v * right[:8]).sum(axis=1)), 1, atol=1e-12)


def test_entries_too_large_raise(spark, tmp_path):
    with pytest.raises(Exception, match="2\\^53"):
        got(spark, tmp_path, [(1, [1e30]), (2, [1.0])])
