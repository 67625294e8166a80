"""Drift detection: the reference's test intents, FIXTURES micro tables, invariants."""

import pytest
from pyspark.sql import functions as F

from tidewatch.config import DriftConfig
from tidewatch.operators.chi2 import chi2_from_counts
from tidewatch.operators.drift import REASON_EMPTY, REASON_KS, detect_drift
from tidewatch.operators.ks import ks_from_counts
from tidewatch.operators.longform import common_features, long_counts

from .conftest import SF01


def _one(spark, col, a, b, typ="double"):
    ref = spark.createDataFrame([(v,) for v in a], f"{col} {typ}")
    cur = spark.createDataFrame([(v,) for v in b], f"{col} {typ}")
    return ref, cur


def test_ks_with_ties(spark):
    ref, cur = _one(spark, "x", [1.0, 2.0, 2.0, 3.0], [2.0, 3.0, 3.0, 4.0])
    d = detect_drift(ref, cur).details.first()
    assert d["statistic"] == pytest.approx(0.5)


def _chi(spark, table):
    rows = []
    for side, counts in enumerate(table):
        for k, n in enumerate(counts):
            rows += [(f"c{k}",)] * n
    ref = spark.createDataFrame([r for r in rows[: sum(table[0])]], "x string")
    cur = spark.createDataFrame([r for r in rows[sum(table[0]):]], "x string")
    return detect_drift(ref, cur).details.first()


def test_chi2_yates_2x2(spark):
    d = _chi(spark, [[30, 20], [20, 30]])
    assert d["statistic"] == pytest.approx(3.24) and d["p_value"] == pytest.approx(0.0718606382, abs=1e-9)
    assert d["dof"] == 1


def test_chi2_zero_cell(spark):
    d = _chi(spark, [[10, 5, 0], [6, 4, 5]])
    assert d["statistic"] == pytest.approx(6.1111111, abs=1e-6)
    assert d["dof"] == 2 and d["p_value"] == pytest.approx(0.0470965488, abs=1e-8)


def test_constant_category_no_drift(spark):
    d = _chi(spark, [[5], [7]])
    assert d["statistic"] == 0.0 and d["p_value"] == 1.0 and not d["drift_detected"]


def test_identical_tables_no_drift(students):
    rep = detect_drift(students, students)
    s = rep.summary.first()
    assert s["drift_detected_overall"] is False and s["drifted_features_count"] == 0
    assert s["total_features_analyzed"] == len(students.columns)


def test_shifted_age_drifts(students):
    cur = students.withColumn("age", F.col("age") + 10)
    d = {r["feature"]: r for r in detect_drift(students, cur).details.collect()}
    assert d["age"]["drift_detected"] is True
    assert REASON_KS in d["age"]["reasons"]
    assert d["Medu"]["drift_detected"] is False


def test_string_column_does_not_crash(spark):
    df = spark.createDataFrame([("A",), ("B",), ("A",)], "cat_col string")
    rows = detect_drift(df, df).details.collect()
    assert rows[0]["type"] == "categorical" and rows[0]["drift_detected"] is False


def test_simulated_drift_exactly_four(students):
    """age +2, absences x1.5, studytime -1 (clipped at 1), G2 x0.9 -> exactly those drift."""
    cur = students.select(
        *[F.col(c) for c in students.columns if c not in ("age", "absences", "studytime", "G2")],
        (F.col("age") + 2).alias("age"), (F.col("absences") * 1.5 + 3).alias("absences"),
        F.greatest(F.col("studytime") - 1, F.lit(1)).alias("studytime"), (F.col("G2") * 0.9).alias("G2"),
    )
    d = detect_drift(students.drop("student_id"), cur.drop("student_id")).details
    drifted = {r["feature"] for r in d.filter("drift_detected").collect()}
    assert drifted == {"age", "absences", "studytime", "G2"}


def test_empty_numeric_side(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    cur = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    d = detect_drift(ref, cur).details.first()
    assert d["statistic"] is None and d["p_value"] is None and not d["drift_detected"]
    assert d["reasons"] == [REASON_EMPTY]


def test_zero_reference_mean(spark):
    ref, cur = _one(spark, "x", [-1.0, 1.0], [5.0, 5.0])
    d = detect_drift(ref, cur).details.first()
    assert d["mean_shift"] == 0.0


def test_no_common_columns(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([(1,)], "b int")
    with pytest.raises(ValueError):
        detect_drift(a, b)


def _lineitem_halves(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    return li.filter("l_shipdate < '1998-07-01'"), li.filter("l_shipdate >= '1998-07-01'")


def test_fixture_values_sf001(spark):
    ref, cur = _lineitem_halves(spark)
    d = {r["feature"]: r for r in detect_drift(ref, cur).details.collect()}
    assert d["l_quantity"]["statistic"] == pytest.approx(0.013545795960, abs=1e-11)
    assert d["l_quantity"]["p_value"] == pytest.approx(0.0080878580, abs=1e-9)
    assert d["l_quantity"]["drift_detected"] is True
    assert d["l_extendedprice"]["statistic"] == pytest.approx(0.010542284749, abs=1e-11)
    assert d["l_returnflag"]["statistic"] == pytest.approx(0.028383267, abs=1e-8)
    assert d["l_linestatus"]["statistic"] == pytest.approx(0.167310040, abs=1e-8)


def test_bucketed_ks_equals_single_window(spark):
    ref, cur = _lineitem_halves(spark)
    feats = common_features(ref.select("l_quantity", "l_extendedprice", "l_discount"), cur.select("l_quantity", "l_extendedprice", "l_discount"))
    counts = long_counts(ref, cur, feats)
    one = {r["fid"]: r["statistic"] for r in ks_from_counts(counts, buckets=1).collect()}
    many = {r["fid"]: r["statistic"] for r in ks_from_counts(counts, buckets=37).collect()}
    assert one == many


def test_ks_symmetric_and_monotone_invariant(spark):
    ref, cur = _lineitem_halves(spark)
    a = detect_drift(ref.select("l_extendedprice"), cur.select("l_extendedprice")).details.first()["statistic"]
    b = detect_drift(cur.select("l_extendedprice"), ref.select("l_extendedprice")).details.first()["statistic"]
    m = detect_drift(ref.select(F.log("l_extendedprice").alias("l_extendedprice")),
                     cur.select(F.log("l_extendedprice").alias("l_extendedprice"))).details.first()["statistic"]
    assert a == pytest.approx(b, abs=1e-15) and a == pytest.approx(m, abs=1e-15)


def test_ks_self_is_zero_and_repartition_invariant(spark):
    ref, cur = _lineitem_halves(spark)
    d0 = detect_drift(ref, ref, DriftConfig(stage=False)).details.filter("type = 'numerical'").agg(F.max("statistic")).first()[0]
    assert d0 == 0.0
    a = detect_drift(ref, cur).details.orderBy("ordinal").select("type", "statistic").collect()
    b = detect_drift(ref.repartition(13), cur.repartition(3)).details.orderBy("ordinal").select("type", "statistic").collect()
    for x, y in zip(a, b):
        if x["type"] == "numerical":  # integer running sums: bit-identical
            assert x["statistic"] == y["statistic"]
        else:  # float sums in a different order
            assert x["statistic"] == pytest.approx(y["statistic"], rel=1e-12)


def test_bh_and_bonferroni(spark):
    ref, cur = _lineitem_halves(spark)
    raw = {r["feature"]: r["p_value"] for r in detect_drift(ref, cur).details.collect()}
    bon = {r["feature"]: r["p_value"] for r in detect_drift(ref, cur, DriftConfig(correction="bonferroni")).details.collect()}
    bh = {r["feature"]: r["p_value"] for r in detect_drift(ref, cur, DriftConfig(correction="bh")).details.collect()}
    for k, p in raw.items():
        if p is None:
            continue
        assert bon[k] == pytest.approx(min(1.0, p * len(raw)))
        assert p - 1e-12 <= bh[k] <= bon[k] + 1e-12


def test_report_json_shape(spark):
    ref, cur = _lineitem_halves(spark)
    import json

    doc = json.loads(detect_drift(ref, cur).as_json().first()["report"])
    assert set(doc) == {"summary", "details"}
    assert doc["details"]["l_quantity"]["statistical_metrics"]["p_value"] < 0.05
    assert doc["summary"]["total_features_analyzed"] == 11


def test_chi2_and_ks_from_same_counts(spark):
    ref, cur = _lineitem_halves(spark)
    feats = common_features(ref, cur)
    counts = long_counts(ref, cur, feats)
    assert chi2_from_counts(counts).count() == 3
    assert ks_from_counts(counts).count() == 8


def test_fused_and_general_paths_agree(spark):
    """The single-window plan and the bucketed plan give the same report."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    from tidewatch.operators.drift import detect_drift_split

    cur = F.col("l_shipdate") >= F.lit("1998-07-01").cast("timestamp_ntz")
    a = {r["feature"]: r for r in detect_drift_split(li, cur).details.collect()}
    b = {r["feature"]: r for r in detect_drift_split(li, cur, DriftConfig(ks_buckets=5)).details.collect()}
    assert set(a) == set(b)
    for k in a:
        assert a[k]["drift_detected"] == b[k]["drift_detected"] and a[k]["reasons"] == b[k]["reasons"]
        assert a[k]["dof"] == b[k]["dof"] and a[k]["n_ref"] == b[k]["n_ref"]
        if a[k]["type"] == "numerical":
            assert a[k]["statistic"] == b[k]["statistic"]
            assert a[k]["mean_ref"] == pytest.approx(b[k]["mean_ref"], rel=1e-12)
        else:
            assert a[k]["statistic"] == pytest.approx(b[k]["statistic"], rel=1e-12)


def test_single_scan_equals_two_tables(spark):
    from tidewatch.operators.drift import detect_drift_split

    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    ref, cur = _lineitem_halves(spark)
    a = {r["feature"]: r["statistic"] for r in detect_drift(ref, cur).details.collect()}
    b = {r["feature"]: r["statistic"] for r in detect_drift_split(li, F.col("l_shipdate") >= F.lit("1998-07-01").cast("timestamp_ntz")).details.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12)


def test_stored_reference_profile(spark):
    from tidewatch import detect_drift_against, reference_profile, stage_table

    ref, cur = _lineitem_halves(spark)
    feats = common_features(ref, cur)
    prof = stage_table(reference_profile(ref, feats), "test-profile")
    a = {r["feature"]: (r["statistic"], r["drift_detected"]) for r in detect_drift(ref, cur).details.collect()}
    b = {r["feature"]: (r["statistic"], r["drift_detected"]) for r in detect_drift_against(prof, cur, feats).details.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == pytest.approx(b[k][0], rel=1e-12) and a[k][1] == b[k][1]
