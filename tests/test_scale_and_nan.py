"""Results that must not depend on table size, missing values as NaN, infinities."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi2_sf
from tidewatch.operators import profile as P
from tidewatch.operators.features import FeatureEncoder
from tidewatch.operators.ks import ks_from_counts
from tidewatch.operators.prefix import weighted_quantiles
from tidewatch.operators.registry import _read
from tidewatch.operators.split import boundaries_of_counts
from tests.conftest import SF01


def upper_tail(x, dof):
    """Poisson / half-integer sums with lgamma, term by term from the largest."""
    h = x / 2
    start, shift, total = (0, 0.0, 0.0) if dof % 2 == 0 else (1, -0.5, math.erfc(math.sqrt(h)))
    top = dof // 2 - 1 if dof % 2 == 0 else dof // 2
    for i in range(start, top + 1):
        total += math.exp((i + shift) * math.log(h) - h - math.lgamma(i + shift + 1))
    return min(1.0, total)


@pytest.mark.parametrize("dof", [1, 2, 3, 10, 11, 999, 2000, 100_000, 100_001])
def test_chi2_tail_small_and_large(spark, dof):
    for z in (-4.0, -1.0, 0.0, 0.5, 1.7, 3.0):
        x = max(0.2, dof + z * math.sqrt(2 * dof))
        got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(dof)).alias("p")).first().p
        assert got == pytest.approx(upper_tail(x, dof), rel=1e-6, abs=1e-12)


@pytest.mark.parametrize("dof", [10_000_000, 5_000_000_000])
def test_chi2_tail_follows_the_normal_limit(spark, dof):
    for z in (-2.0, 0.0, 2.0):
        # Wilson-Hilferty is exact to far below the tolerance here
        x = dof * (1 - 2 / (9 * dof) + z * math.sqrt(2 / (9 * dof))) ** 3
        got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(dof)).alias("p")).first().p
        assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-3)


@pytest.mark.parametrize("table,column", [("orders", "o_totalprice"), ("events", "value"), ("lineitem", "l_extendedprice")])
def test_quantiles_do_not_depend_on_the_path(spark, table, column):
    df = spark.read.parquet(f"{SF01}/{table}.parquet")
    cnt = df.groupBy(F.lit(0).alias("g"), F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n")).filter("v IS NOT NULL")
    probs = [i / 20 for i in range(21)]
    small = {r.prob: r.q for r in weighted_quantiles(cnt, ["g"], "v", "n", probs).collect()}
    large = {r.prob: r.q for r in weighted_quantiles(cnt, ["g"], "v", "n", probs, map_limit=1).collect()}
    assert small == large


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (float("nan"), 1.0)], "x double, y double")
    r = P.describe(df, ["x"]).first()
    assert (r["count"], r["mean"], r["std"], r["max"], r["p50"]) == (3, 2.0, 1.0, 3.0, 2.0)
    assert P.distinct_counts(df, ["x"]).first().n_distinct == 3
    assert P.target_shape(df, "x").first()["mean"] == 2.0
    assert P.correlations(df, "y").first()["corr"] == pytest.approx(1.0)
    enc = FeatureEncoder(ordinal={}, nominal=[], numerical=["x"], exclude=["y"]).fit(df)
    assert enc.fitted["scale"]["x"] == [2.0, pytest.approx(math.sqrt(2 / 3))]


def test_infinity_of_one_side_leaves_the_other_mean(spark):
    counts = spark.createDataFrame([(0, 1.0, None, 1, 1), (0, 2.0, None, 1, 0), (0, 3.0, None, 1, 0), (0, float("inf"), None, 0, 1)],
                                   "fid int, num double, cat string, r long, c long")
    r = ks_from_counts(counts).first()
    assert r.mean_ref == 2.0 and r.mean_cur == float("inf")


def test_quotas_of_a_trillion_rows(spark):
    rows = [(g, f"{b:04x}", 10**11 + g) for g in range(5) for b in (0, 0x4000, 0x8000)]
    got = {r["_g"]: (r["_hb"], r["_need"]) for r in boundaries_of_counts(spark.createDataFrame(rows, "_g int, _hb string, _n long"), 0.2)}
    total = sum(n for _, _, n in rows)
    want = math.ceil(0.2 * total)
    quota = {g: need + (0 if hb == "0000" else 10**11 + g) for g, (hb, need) in got.items()}
    assert sum(quota.values()) == want
    assert all(abs(q * total - want * 3 * (10**11 + g)) < total for g, q in quota.items())


def test_every_value_is_counted_and_columns_are_limited(spark):
    df = spark.createDataFrame([(str(i), "a", "b") for i in range(40)], "x string, y string, z string")
    got = P.value_counts(df, max_columns=2).collect()
    assert len(got) == 41 and {r.feature for r in got} == {"x", "y"}


def test_category_limit_is_per_column(spark):
    df = spark.createDataFrame([(str(i), "a") for i in range(30)], "x string, y string")
    with pytest.raises(ValueError, match="x"):
        FeatureEncoder(ordinal={}, nominal=["x", "y"], numerical=[], exclude=[], maxCategories=29).fit(df)
    FeatureEncoder(ordinal={}, nominal=["x", "y"], numerical=[], exclude=[], maxCategories=30).fit(df)


def test_only_a_missing_registry_is_empty(spark, tmp_path):
    assert _read(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        _read(spark, "nosuchscheme://store/table").count()


def test_ranges_stay_small_on_skewed_values(spark):
    """Range-partitioned running sums: every range near its size, sums equal to one plain window."""
    from pyspark.sql import Window

    from tidewatch.operators.prefix import in_ranges, running_sums

    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("fid"),
        F.exp(F.col("id") / 3000.0 + F.xxhash64("id") % 7 / 1e6).alias("value"), (F.col("id") % 5 + 1).alias("n")
    ).groupBy("fid", "value").agg(F.sum("n").alias("n"))
    per_range = 250
    got = running_sums(rows, ["fid"], "value", ["n"], with_next=True, rows_per_bucket=per_range)
    w = Window.partitionBy("fid").orderBy("value")
    plain = rows.select("*", F.sum("n").over(w).alias("cum_n"), F.lead("value").over(w).alias("next_value"))
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    n = rows.count()
    sizes = [r["count"] for r in in_ranges(rows, ["fid"], "value", -(-n // per_range)).groupBy("_part").count().collect()]
    assert len(sizes) > 200 and max(sizes) <= 2 * per_range
