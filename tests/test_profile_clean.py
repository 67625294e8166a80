import pytest
from pyspark.sql import functions as F

from tidewatch.functions.scalar import error_band, half_even_int, quoted_number, yes_to_int
from tidewatch.operators import profile as P
from tidewatch.operators.clean import clean_binary, fill_defaults, split_valid, validate_rows
from tidewatch.operators.split import with_quantile_bin
from tidewatch.schema import GRADE_BAND_EDGES


def test_skew_kurtosis_adjusted(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "x double")
    r = P.target_shape(df, "x").first()
    assert r["skewness"] == pytest.approx(1.6970562748, abs=1e-9)
    assert r["kurtosis"] == pytest.approx(3.152, abs=1e-9)
    assert r["median"] == 3.0


def test_quantile_bins_drop_duplicate_edges(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0, 0, 0, 5, 9])], "id int, y double")
    got = [r["bin"] for r in with_quantile_bin(df, "y", 5).orderBy("id").collect()]
    assert got == [0, 0, 0, 1, 2]


def test_fixed_bins_right_closed(spark):
    vals = [0, 5, 6, 10, 15, 16, 20, 21]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, g double")
    got = [r["b"] for r in df.select("id", P.right_closed_band(F.col("g"), GRADE_BAND_EDGES).alias("b")).orderBy("id").collect()]
    assert got == [0, 0, 1, 1, 2, 3, 3, None]


def test_describe_quantiles_match_linear_interpolation(spark):
    import numpy as np

    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.describe(df).first()
    assert r["p25"] == pytest.approx(np.quantile(vals, 0.25))
    assert r["p50"] == pytest.approx(np.quantile(vals, 0.5))
    assert r["p75"] == pytest.approx(np.quantile(vals, 0.75))
    assert r["std"] == pytest.approx(np.std(vals, ddof=1))


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (None, float("nan"))], "a int, b double")
    m = {r["feature"]: r["missing_count"] for r in P.missing_report(df).collect()}
    assert m == {"b": 3, "a": 1}
    assert P.duplicate_count(df).first()[0] == 1


def test_binary_clean_idempotent(spark):
    df = spark.createDataFrame([("yes",), ("No",), (" YES",), ("Yes",), (None,)], "paid string")
    once = clean_binary(df)
    assert [r[0] for r in once.collect()] == [1, 0, 0, 1, 0]
    assert [r[0] for r in clean_binary(once).collect()] == [1, 0, 0, 1, 0]


def test_half_even_and_bands(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.5,), (2.0,), (2.6,), (3.4,)], "x double")
    r = df.select(half_even_int(F.col("x")).alias("h"), error_band(F.col("x")).alias("b")).collect()
    assert [x["h"] for x in r] == [2, 4, 0, 2, 3, 3]
    assert [x["b"] for x in r] == ["Fair", "Poor", "Excellent", "Good", "Fair", "Poor"]


def test_quoted_numeric_is_ansi_safe(spark):
    df = spark.createDataFrame([('"7"',), ("x",), ('""12.5""',), (None,)], "s string")
    assert [r[0] for r in df.select(quoted_number(F.col("s"))).collect()] == [7.0, None, 12.5, None]


def test_validation_rejects_out_of_range_and_missing(spark, students):
    bad = spark.createDataFrame([("GP", 100)], "school string, age int")
    v = validate_rows(bad).first()
    assert v["is_valid"] is False and "age:out_of_range" in v["violations"] and "sex:missing" in v["violations"]
    good, quarantine = split_valid(students.drop("G3"))
    assert good.count() == students.count() and quarantine.count() == 0


def test_fill_defaults_adds_absent_columns(spark):
    df = spark.createDataFrame([("U", None)], "address string, Mjob string")
    r = fill_defaults(df).first()
    assert r["Mjob"] == "other" and r["famsize"] == "GT3" and r["address"] == "U"


def test_yes_to_int_null(spark):
    assert spark.range(1).select(yes_to_int(F.lit(None).cast("string"))).first()[0] == 0


def test_bucketed_quantiles_match_numpy(spark):
    """Force the scalable path (no percentile map) and compare with numpy."""
    import numpy as np

    from tidewatch.operators.longform import Feature, single_counts
    from tidewatch.operators.prefix import running_sums, exact_quantiles, weighted_quantiles

    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 3.0, 5000), 1)  # ties included
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    cnt = single_counts(df, [Feature(0, "x", "numerical")]).select("fid", F.col("num").alias("value"), "n")
    got = {r["prob"]: r["q"] for r in weighted_quantiles(cnt, ["fid"], "value", "n", probs, map_limit=0).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)
    # many buckets, same answer
    cum = running_sums(cnt, ["fid"], "value", ["n"], buckets=17)
    tot = cnt.groupBy("fid").agg(F.sum("n").alias("t"))
    got2 = {r["prob"]: r["q"] for r in exact_quantiles(cum, ["fid"], "value", "n", tot, "t", probs).collect()}
    assert got2 == pytest.approx(got)
    wide = P.quantiles_by_column(df, ["x"], probs, map_limit=0).collect()
    assert {r["prob"]: r["q"] for r in wide} == pytest.approx(got)
