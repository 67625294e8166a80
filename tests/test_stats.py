import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi2_sf, erfc_pos, ks_pvalue


@pytest.mark.parametrize("x,dof,p", [
    (3.24, 1, 0.0718606382), (6.1111111, 2, 0.0470965488), (1.829182443, 4, 0.7671391423),
    (0.16731004, 1, 0.6825136096), (3.841458821, 1, 0.05), (7.814727903, 3, 0.05), (11.07049769, 5, 0.05),
    (18.30703805, 10, 0.05), (22.36203249, 13, 0.05),
])
def test_chi2_tail_matches_tables(spark, x, dof, p):
    got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(dof)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=1e-8)


def test_chi2_edges(spark):
    r = spark.range(1).select(chi2_sf(F.lit(0.0), F.lit(3)).alias("a"), chi2_sf(F.lit(5.0), F.lit(0)).alias("b"),
                              chi2_sf(F.lit(5000.0), F.lit(3)).alias("c")).first()
    assert r["a"] == 1.0 and r["b"] == 1.0 and r["c"] == pytest.approx(0.0, abs=1e-300)


def test_erfc(spark):
    for z in [0.0, 0.1, 0.5, 1.0, 2.0, 3.5, 6.0]:
        got = spark.range(1).select(erfc_pos(F.lit(z)).alias("e")).first()["e"]
        assert got == pytest.approx(math.erfc(z), abs=1e-14)


@pytest.mark.parametrize("d,n,m,p", [
    (0.012955916603, 4985, 5015, 0.7929785608), (0.013545795960, 30903, 29097, 0.0080878580),
    (0.010542284749, 30903, 29097, 0.0710300190), (0.008619109022, 7902, 7098, 0.9430843522),
])
def test_ks_pvalue_fixture_values(spark, d, n, m, p):
    got = spark.range(1).select(ks_pvalue(F.lit(d), F.lit(n), F.lit(m)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=1e-9)
