"""Property tests: drift statistics against brute force on random small samples."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewatch.config import DriftConfig
from tidewatch.operators.drift import detect_drift

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.one_of(st.integers(-5, 5).map(float), st.none(), st.just(float("nan"))), min_size=1, max_size=40)


def brute_ks(a, b):
    a = sorted(x for x in a if x is not None and not math.isnan(x))
    b = sorted(x for x in b if x is not None and not math.isnan(x))
    if not a or not b:
        return None
    pts = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in pts)


@SETTINGS
@given(values, values)
def test_ks_matches_brute_force(spark, a, b):
    ref = spark.createDataFrame([(x,) for x in a], "x double")
    cur = spark.createDataFrame([(x,) for x in b], "x double")
    want = brute_ks(a, b)
    for cfg in (DriftConfig(stage=False), DriftConfig(stage=False, ks_buckets=3)):
        got = detect_drift(ref, cur, cfg).details.first()["statistic"]
        if want is None:
            assert got is None
        else:
            assert got == pytest.approx(want, abs=1e-12)


cats = st.lists(st.sampled_from(["a", "b", "c", "d", None]), min_size=1, max_size=40)


def brute_chi2(a, b):
    a = [x for x in a if x is not None]
    b = [x for x in b if x is not None]
    keys = sorted(set(a) | set(b))
    if not a or not b or len(keys) < 2:
        return 0.0
    n = len(a) + len(b)
    stat = 0.0
    for k in keys:
        col = a.count(k) + b.count(k)
        for obs, row in ((a.count(k), len(a)), (b.count(k), len(b))):
            e = row * col / n
            d = abs(obs - e)
            if len(keys) == 2:
                d = max(d - 0.5, 0.0)
            stat += d * d / e
    return stat


@SETTINGS
@given(cats, cats)
def test_chi2_matches_brute_force(spark, a, b):
    ref = spark.createDataFrame([(x,) for x in a], "x string")
    cur = spark.createDataFrame([(x,) for x in b], "x string")
    got = detect_drift(ref, cur, DriftConfig(stage=False)).details.first()
    assert got["statistic"] == pytest.approx(brute_chi2(a, b), rel=1e-9, abs=1e-12)
    assert 0.0 <= got["p_value"] <= 1.0
