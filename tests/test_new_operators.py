"""Recent files with an early stop, exact small-sample KS, folds, lasso, tree splits and boosting."""

from __future__ import annotations

import os
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.stats import ks_exact
from tidewatch.schema import student_schema
from tidewatch.sources.files import open_newest, recent_files

from .fixtures import student_pandas
from .test_sources_registry_stream import _write_batches


# ---- recent files -------------------------------------------------------------

def test_newest_files_only_are_opened(spark, tmp_path):
    d = str(tmp_path / "batches")
    paths = _write_batches(d, [100] * 8)
    times = os.stat(paths[6])
    with open(paths[6], "a") as f:  # malformed: skipped whole
        f.write("GP,F,notanumber,U\n")
    os.utime(paths[6], (times.st_atime, times.st_mtime))
    os.chmod(paths[0], 0)
    opened = open_newest(spark, d, student_schema(), 250)
    names = [os.path.basename(o.path) for o in opened]
    # groups of 1, 2 and 4 files: the newest, two more (one of them malformed), then the rest that is needed
    assert names == [os.path.basename(p) for p in reversed(paths[1:])]
    assert [sum(o.rows.values()) for o in opened] == [100, 0, 100, 100, 100, 100, 100]
    assert [sum(o.rows.values()) for o in open_newest(spark, d, student_schema(), 100)] == [100]
    rows = recent_files(spark, d, student_schema(), 250)
    assert {r["G1"]: r["count"] for r in rows.groupBy("G1").count().collect()} == {7: 100, 5: 100, 4: 50}
    assert sorted(r["_pos"] for r in rows.select("_pos").collect()) == list(range(250))
    assert [r["age"] for r in rows.filter("G1 = 4").orderBy("_pos").collect()] == list(student_pandas(100, 5)["age"][:50])
    os.chmod(paths[0], 0o644)


def test_recent_files_edges(spark, tmp_path):
    assert recent_files(spark, str(tmp_path / "nope"), student_schema(), 10).count() == 0
    d = str(tmp_path / "few")
    paths = _write_batches(d, [5, 5, 5])
    for p in paths:  # equal times: the later path first
        os.utime(p, (1e9, 1e9))
    rows = recent_files(spark, d, student_schema(), 1000).orderBy("_pos").collect()
    assert [r["G1"] for r in rows] == [2] * 5 + [1] * 5 + [0] * 5
    assert recent_files(spark, d, student_schema(), 0).count() == 0
    with open(os.path.join(d, "empty.csv"), "w") as f:
        f.write(",".join(student_schema().fieldNames()) + "\n")
    assert recent_files(spark, d, student_schema(), 7).count() == 7


# ---- exact KS -----------------------------------------------------------------

@pytest.mark.parametrize("n,m", [(1, 1), (3, 2), (4, 4), (6, 3), (5, 7)])
def test_exact_ks_counts_all_orders(n, m):
    gaps = []
    for first in combinations(range(n + m), n):
        x = np.isin(np.arange(n + m), first)
        gaps.append(np.abs(np.cumsum(x) / n - np.cumsum(~x) / m).max())
    for d in sorted(set(np.round(gaps, 12))):
        assert ks_exact(d, n, m) == pytest.approx(np.mean(np.array(gaps) > d - 1e-9), abs=1e-12)
        assert ks_exact(d, m, n) == pytest.approx(ks_exact(d, n, m), abs=1e-12)


def test_exact_ks_in_the_report(spark):
    from tidewatch.config import DriftConfig
    from tidewatch.operators.drift import detect_drift

    ref = spark.createDataFrame([(float(i), float(i)) for i in range(5)], "x double, y double")
    cur = spark.createDataFrame([(float(i) + 3.5, float(i)) for i in range(5)], "x double, y double")
    for buckets in (None, 3):
        config = DriftConfig(mean_diff_threshold=1e9, ks_buckets=buckets)
        p = {r["feature"]: (round(r["p_value"], 4), r["drift_detected"]) for r in detect_drift(ref, cur, config).details.collect()}
        assert p["x"] == (0.0361, True)
        config = DriftConfig(mean_diff_threshold=1e9, ks_buckets=buckets, ks_exact_up_to=100)
        p = {r["feature"]: (round(r["p_value"], 4), r["drift_detected"]) for r in detect_drift(ref, cur, config).details.collect()}
        assert p == {"x": (0.0794, False), "y": (1.0, False)}  # the exact p decides the other way


def test_exact_ks_of_large_samples_is_near_the_series(spark):
    from tidewatch.operators.ks import ks_p

    df = spark.createDataFrame([(0.05, 1000, 1000), (0.03, 900, 1000), (None, 0, 5)], "d double, n long, m long")
    for r in df.select(ks_p(F.col("d"), F.col("n"), F.col("m"), 1000).alias("e"), ks_p(F.col("d"), F.col("n"), F.col("m")).alias("s")).collect():
        assert (r["e"] is None) == (r["s"] is None) and (r["e"] is None or abs(r["e"] - r["s"]) < 0.02)


# ---- folds --------------------------------------------------------------------

def test_folds_are_exact_and_do_not_depend_on_partitions(spark):
    from tidewatch.operators.split import bin_expr, quantile_edges, stratified_folds

    df = spark.range(3001).select("id", F.when(F.col("id") % 97 != 0, (F.xxhash64("id") % 500).cast("double")).alias("y"), F.lit("a").alias("fold_"))
    out = stratified_folds(df, "y", ["id"], 7)
    assert out.columns == ["id", "y", "fold_", "fold"] and out.count() == 3001 and out.select("id").distinct().count() == 3001
    binned = out.withColumn("bin", bin_expr(F.col("y"), quantile_edges(df, "y", 5)))
    sizes: dict = {}
    for r in binned.groupBy("bin", "fold").count().collect():
        sizes.setdefault(r["bin"], []).append(r["count"])
    assert all(len(v) == 7 and max(v) - min(v) <= 1 for v in sizes.values()) and len(sizes) == 6
    again = stratified_folds(df.repartition(13), "y", ["id"], 7)
    assert out.exceptAll(again).isEmpty()


def test_folds_with_repeated_keys_and_few_rows(spark):
    from tidewatch.operators.split import stratified_folds

    same = spark.range(50).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"), F.lit(2.0).alias("y"))
    sizes = {r["fold"]: r["count"] for r in stratified_folds(same, "y", ["k"], 4).groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3] and set(sizes.values()) <= {12, 13}
    two = stratified_folds(same.limit(2), "y", ["k"], 5)
    assert two.count() == 2 and stratified_folds(same.limit(0), "y", ["k"], 3).count() == 0
    assert {r["fold"] for r in stratified_folds(same, "y", ["k"], 1).collect()} == {0}


# ---- lasso --------------------------------------------------------------------

@pytest.mark.parametrize("alpha", [0.0, 0.1, 1.0, 1e6])
def test_lasso_meets_its_conditions(spark, alpha):
    from tidewatch.operators.models import lasso

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5))
    x[:, 4] = 3.0  # without variance
    y = x @ np.array([2.0, 0.0, -1.0, 0.3, 5.0]) + 7 + 0.1 * rng.normal(size=400)
    names = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0)], ", ".join(f"{n} double" for n in [*names, "label"]))
    beta, b0 = lasso(df, names, "label", alpha)
    b = np.array([beta[n] for n in names])
    resid = y - x @ b - b0
    assert abs(resid.mean()) < 1e-9 and b[4] == 0.0
    slope = (x - x.mean(axis=0)).T @ resid / len(y)
    assert np.all(np.abs(slope) <= alpha + 1e-6)
    assert np.allclose(slope[b != 0], alpha * np.sign(b[b != 0]), atol=1e-6)


def test_lasso_on_nothing(spark):
    from tidewatch.operators.models import lasso

    assert lasso(spark.createDataFrame([], "a double, label double"), ["a"]) == ({"a": 0.0}, 0.0)


# ---- tree splits and boosting -------------------------------------------------

def test_best_split_against_all_thresholds(spark):
    from tidewatch.operators.trees import best_splits

    rng = np.random.default_rng(2)
    x, z = rng.integers(0, 40, 500).astype(float), np.round(rng.normal(size=500), 1)
    y = np.where(x > 17, 5.0, 1.0) + z
    df = spark.createDataFrame([(float(a), float(b), 1.0, float(c)) for a, b, c in zip(x, z, y)] + [(None, float("nan"), 1.0, 9.0)], "x double, z double, one double, y double")
    got = {r["feature"]: r for r in best_splits(df, ["x", "z", "one"], F.col("y")).collect()}
    assert "one" not in got  # one value: no threshold
    for name, v in (("x", x), ("z", z)):
        best = max((y.var() - (sum(v <= t) * y[v <= t].var() + sum(v > t) * y[v > t].var()) / len(y), -t) for t in (np.unique(v)[1:] + np.unique(v)[:-1]) / 2)
        assert got[name]["gain"] == pytest.approx(best[0]) and got[name]["threshold"] == pytest.approx(-best[1])
        assert got[name]["n_left"] + got[name]["n_right"] == 500 and got[name]["mean_left"] == pytest.approx(y[v <= got[name]["threshold"]].mean())


def test_boosting_reduces_the_error_as_a_plain_loop_does(spark):
    from tidewatch.operators.trees import boost

    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, size=(300, 2)).astype(float)
    y = 2.0 * (x[:, 0] > 2) + 1.0 * (x[:, 1] > 3) + 0.1 * rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    model = boost(df, ["a", "b"], "y", rounds=6, rate=0.5)
    f = np.full(300, y.mean())
    for s in model.stumps:
        r, best = y - f, None
        for k, name in enumerate("ab"):
            for t in (np.unique(x[:, k])[1:] + np.unique(x[:, k])[:-1]) / 2:
                left = x[:, k] <= t
                gain = r.var() - (left.sum() * r[left].var() + (~left).sum() * r[~left].var()) / 300
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, name, t, 0.5 * r[left].mean(), 0.5 * r[~left].mean(), left)
        assert (s.feature, s.threshold) == best[1:3] and s.left == pytest.approx(best[3]) and s.right == pytest.approx(best[4])
        f = f + np.where(best[5], s.left, s.right)
    error = df.select(F.avg((F.col("y") - model.prediction()) ** 2)).first()[0]
    assert error == pytest.approx(((y - f) ** 2).mean()) and error < 0.1 * y.var()
    assert boost(df.limit(0), ["a", "b"], "y").stumps == ()
