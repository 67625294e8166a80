"""End-to-end jobs W1–W6 and X16 on the synthetic student table."""

import json
import os

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.clean import clean_binary
from tidewatch.operators.features import FeatureEncoder
from tidewatch.operators.models import cross_validate, forest
from tidewatch.operators.registry import _read, load_current
from tidewatch.operators.split import stratified_split
from tidewatch.plans import jobs
from tidewatch.schema import student_schema

from .fixtures import student_pandas


def test_drift_job_writes_report_and_log(spark, students, tmp_path):
    cur = students.withColumn("age", F.col("age") + 3)
    rep = jobs.drift_job(students, cur, str(tmp_path / "report"), str(tmp_path / "log"))
    doc = json.loads(spark.read.text(str(tmp_path / "report")).first()[0])
    assert doc["details"]["age"]["drift_detected"] is True
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 1 and log.first()["type"] == "drift_report"
    assert rep.summary.first()["drifted_features_count"] >= 1


def _batches(d, frames):
    os.makedirs(d, exist_ok=True)
    for i, pdf in enumerate(frames):
        p = os.path.join(d, f"batch_2024010{i}000000.csv")
        pdf.to_csv(p, index=False)
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))


def test_retraining_exits_and_promotion(spark, students, tmp_path):
    schema = student_schema()
    ref = students.drop("student_id")
    reg = str(tmp_path / "versions")
    lab, unl = str(tmp_path / "labeled"), str(tmp_path / "unlabeled")
    # 1: no reference
    assert jobs.retraining(spark, None, lab, unl, schema, reg).status == jobs.EXIT_NO_REFERENCE
    # 2: no new data
    assert jobs.retraining(spark, ref, lab, unl, schema, reg).status == jobs.EXIT_NO_NEW_DATA
    # 3: the files share no column with the reference
    other = str(tmp_path / "other-unlabeled")
    _batches(other, [pd.DataFrame({"elsewhere": [1, 2, 3]})])
    strange = T.StructType([T.StructField("elsewhere", T.IntegerType())])
    assert jobs.retraining(spark, ref, lab, other, strange, reg).status == jobs.EXIT_NO_COMMON_COLUMNS
    # 4: same distribution -> no drift
    same = student_pandas(395, 7)
    _batches(unl, [same.drop(columns=["G3"])])
    assert jobs.retraining(spark, ref, lab, unl, schema, reg).status == jobs.EXIT_NO_DRIFT
    # 5: drifted but no labels
    shifted = student_pandas(300, 11)
    shifted["age"] = shifted["age"] + 5
    _batches(unl, [same.drop(columns=["G3"]), shifted.drop(columns=["G3"])])
    assert jobs.retraining(spark, ref, lab, unl, schema, reg).status == jobs.EXIT_NO_LABELS
    # promoted: labels arrive, no champion -> version 1
    _batches(lab, [shifted])
    out = jobs.retraining(spark, ref, lab, unl, schema, reg)
    assert out.status == jobs.PROMOTED and out.version == 1
    assert _read(spark, reg).count() == 1
    # the registry row leads to the saved model, which is the next champion
    saved = load_current(spark, reg)
    assert saved.transform(clean_binary(ref)).count() == 395

    def predicting(expr):
        return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({expr} AS DOUBLE) AS prediction FROM __THIS__")])

    # a champion that is always right stays; one that is always far off goes
    log = str(tmp_path / "log")
    kept = jobs.retraining(spark, ref, lab, unl, schema, reg, champion=predicting("G3"), log_path=log)
    assert kept.status == jobs.KEPT and kept.champion_mae == 0.0 and _read(spark, reg).count() == 1
    baseline = str(tmp_path / "baseline")
    predicting("100").write().overwrite().save(baseline)
    other = str(tmp_path / "other")
    beaten = jobs.retraining(spark, ref, lab, unl, schema, other, baseline_path=baseline, log_path=log)
    assert beaten.status == jobs.PROMOTED and beaten.version == 1 and beaten.champion_mae > 50
    assert spark.read.parquet(log).count() == 2


def test_bootstrap_registers_version_one(spark, students, tmp_path):
    model, met, v = jobs.bootstrap(spark, students, ["student_id"], str(tmp_path / "reg"))
    assert v == 1 and met.first()["n"] == 50


def test_baseline_training_and_scoring(spark, students):
    data = clean_binary(students).withColumn("label", F.col("G3").cast("double"))
    s = stratified_split(data, "G3", ["student_id"])
    enc = FeatureEncoder(exclude=["G3", "label", "split", "student_id"]).fit(s.filter("split = 'train'"))
    tr, va, te = (enc.transform(s.filter(f"split = '{x}'")) for x in ("train", "val", "test"))
    out = jobs.baseline_training(tr, va, names=enc.feature_names)
    cmp = {r["model"]: r for r in out["comparison"].collect()}
    assert set(cmp) == {"random_forest", "ridge"} and sum(r["is_best"] for r in cmp.values()) == 1
    assert out["importance"].count() == 15
    assert out["gates"].first()["mae_gate"] in ("EXCELLENT", "GOOD", "FAIR")
    sc = jobs.batch_scoring(out["rf"], te)
    assert sc["scored"].count() == 79 and sc["metrics"].first()["n"] == 79
    assert set(r[0] for r in sc["scored"].select("status").distinct().collect()) <= {"Excellent", "Good", "Fair", "Poor"}


def test_cross_validation_grid(spark, students):
    data = clean_binary(students).withColumn("label", F.col("G3").cast("double"))
    enc = FeatureEncoder(exclude=["G3", "label", "student_id"])
    cvm = cross_validate(data, enc, forest(numTrees=5), {"maxDepth": [2, 4]}, ["student_id"], folds=3)
    assert len(cvm.avgMetrics) == 2


def test_backfill_and_append_batch(spark, students, tmp_path):
    from tidewatch.sinks.tables import append_batch

    lab, unl = str(tmp_path / "lab"), str(tmp_path / "unl")
    _batches(lab, [student_pandas(40, 3)])
    append_batch(spark.createDataFrame(student_pandas(25, 4).drop(columns=["G3"])), unl)
    counts = {r[0]: r[1] for r in jobs.backfill(spark, students.drop("student_id"), lab, unl, student_schema(),
                                                  str(tmp_path / "raw")).collect()}
    assert counts == {"training_historical": 395, "incoming_labeled": 40, "incoming_unlabeled": 25}


def test_side_by_side_scores_original_rows(spark, students):
    from tidewatch.operators.models import fit_pipeline, side_by_side

    data = clean_binary(students).withColumn("label", F.col("G3").cast("double"))
    enc = FeatureEncoder(exclude=["G3", "label", "student_id"])
    m = fit_pipeline(data, enc, forest(numTrees=5, maxDepth=4))
    both = side_by_side({"a": m, "b": m}, data, ["student_id", "label"])
    direct = {r["student_id"]: r["prediction"] for r in m.transform(data).select("student_id", "prediction").collect()}
    rows = both.collect()
    assert len(rows) == 395
    for r in rows:
        assert r["a"] == r["b"] == direct[r["student_id"]]
