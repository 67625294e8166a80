"""End-to-end jobs (W1–W6), each a short driver program of DataFrame plans.

Actions are few and named: the drift report, the model fit, the metric
comparison, the registry append.  Data never passes through the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DriftConfig, SplitConfig
from tidewatch.functions.scalar import error_band
from tidewatch.operators import profile as P
from tidewatch.operators.clean import clean_binary, quality_gates, split_target
from tidewatch.operators.drift import DriftReport, detect_drift
from tidewatch.operators.features import FeatureEncoder
from tidewatch.operators.metrics import compare_models, regression_metrics
from tidewatch.operators.models import FOREST_RETRAIN, feature_importance, fit_pipeline, forest, ridge, side_by_side
from tidewatch.operators.registry import history_versions, load_current, register
from tidewatch.operators.split import random_split, stratified_split
from tidewatch.schema import GRADE_BAND_EDGES, TARGET
from tidewatch.session import stage_table
from tidewatch.sinks.tables import append_drift_report, write_report_json
from tidewatch.sources.files import read_batches, recent_files, union_by_name


def drift_job(ref: DataFrame, cur: DataFrame, report_path: str | None = None, log_path: str | None = None,
              config: DriftConfig = DriftConfig()) -> DriftReport:
    """Two tables -> report (target included) -> latest JSON + appended log."""
    rep = detect_drift(ref, cur, config)
    if report_path:
        write_report_json(rep.as_json(), report_path)
    if log_path:
        append_drift_report(rep, log_path)
    return rep


# Early exits of the retraining loop, in order.
EXIT_NO_REFERENCE = "no_reference"
EXIT_NO_NEW_DATA = "no_new_data"
EXIT_NO_COMMON_COLUMNS = "no_common_columns"
EXIT_NO_DRIFT = "no_drift"
EXIT_NO_LABELS = "no_labels"
PROMOTED = "promoted"
KEPT = "kept_champion"


@dataclass
class RetrainOutcome:
    status: str
    report: DriftReport | None = None
    champion_mae: float | None = None
    challenger_mae: float | None = None
    version: int | None = None
    extra: dict = field(default_factory=dict)


def retraining(
    spark: SparkSession, reference: DataFrame | None, labeled_dir: str, unlabeled_dir: str, schema,
    registry_path: str, champion=None, window_rows: int = 1000, key_cols=None,
    config: DriftConfig = DriftConfig(), min_improvement: float = 0.01, report_path: str | None = None,
    log_path: str | None = None, baseline_path: str | None = None, target: str = TARGET, encoder=None, estimator=None,
) -> RetrainOutcome:
    """Drift-gated retraining with champion/challenger promotion.

    Both windows are written once, so the report and the training rows are the
    same files' rows whatever arrives meanwhile.  The champion is the given
    model, else the registry's current one, else the baseline's; a promoted
    challenger is saved under the path its registry row records.  ``encoder`` and
    ``estimator`` (on columns ``features`` and ``label``) are fitted for the challenger;
    without them the student table's encoding and the forest are."""
    if reference is None:
        return RetrainOutcome(EXIT_NO_REFERENCE)
    unl = recent_files(spark, unlabeled_dir, schema.__class__([f for f in schema.fields if f.name != target]), window_rows).drop("_pos")
    unl = stage_table(unl, "window-unlabeled")
    lab = stage_table(recent_files(spark, labeled_dir, schema, window_rows).drop("_pos"), "window-labeled")
    window = union_by_name(unl, lab)
    if window.isEmpty():
        return RetrainOutcome(EXIT_NO_NEW_DATA)
    ref_x, _ = split_target(reference, target)
    cur_x, _ = split_target(window, target)
    common = [c for c in ref_x.columns if c in cur_x.columns]
    if not common:
        return RetrainOutcome(EXIT_NO_COMMON_COLUMNS)
    rep = drift_job(ref_x.select(*common), cur_x.select(*common), report_path=report_path, log_path=log_path, config=config)
    if not rep.summary.first()["drift_detected_overall"]:
        return RetrainOutcome(EXIT_NO_DRIFT, rep)
    if target not in lab.columns or lab.filter(F.col(target).isNotNull()).isEmpty():
        return RetrainOutcome(EXIT_NO_LABELS, rep)
    data = clean_binary(union_by_name(reference, lab.filter(F.col(target).isNotNull())))
    keys = key_cols or data.columns
    parts = random_split(data, keys, test_size=0.2, seed=42)
    train, hold = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    # the label and split bookkeeping must never become features
    enc = encoder or FeatureEncoder(exclude=[target, "label", "split"] + list(key_cols or []))
    chal = fit_pipeline(train.withColumn("label", F.col(target).cast("double")), enc, estimator or forest(**FOREST_RETRAIN))
    hold = hold.withColumn("label", F.col(target).cast("double"))
    if champion is None:
        champion = load_current(spark, registry_path, baseline_path)
    models = {"chal": chal} if champion is None else {"chal": chal, "champ": champion}
    scored = side_by_side(models, hold, ["label"])
    m = scored.agg(
        F.avg(F.abs(F.col("label") - F.col("chal"))).alias("chal_mae"),
        *( [F.avg(F.abs(F.col("label") - F.col("champ"))).alias("champ_mae")] if champion is not None else [] ),
        (F.lit(1.0) - F.avg((F.col("label") - F.col("chal")) ** 2) / F.var_pop("label")).alias("chal_r2"),
    ).first()
    champ_mae = m["champ_mae"] if champion is not None else None
    if champ_mae is not None and not (m["chal_mae"] < champ_mae - min_improvement):
        return RetrainOutcome(KEPT, rep, champ_mae, m["chal_mae"])
    v = register(spark, registry_path, m["chal_mae"], m["chal_r2"], model=chal)
    return RetrainOutcome(PROMOTED, rep, champ_mae, m["chal_mae"], v, {"model": chal})


def backfill(spark: SparkSession, history: DataFrame, labeled_dir: str, unlabeled_dir: str, schema,
             raw_log: str, versions: DataFrame | None = None, versions_log: str | None = None,
             metadata: DataFrame | None = None) -> DataFrame:
    """K8: one batch job loading history and both incoming directories into the
    raw-data log (stamped per dataset type) and, if given, version rows or the
    history of a metadata document into the versions log.  Returns the per-type row counts written."""
    from tidewatch.sinks.tables import append_raw

    lab = read_batches(spark, labeled_dir, schema).drop("_file", "_mtime", "_blk", "_mono")
    unl_schema = schema.__class__([f for f in schema.fields if f.name != TARGET])
    unl = read_batches(spark, unlabeled_dir, unl_schema).drop("_file", "_mtime", "_blk", "_mono")
    for df, kind in ((history, "training_historical"), (lab, "incoming_labeled"), (unl, "incoming_unlabeled")):
        append_raw(df, raw_log, kind)
    if versions is None and metadata is not None:
        versions = history_versions(metadata)
    if versions is not None and versions_log:
        versions.write.mode("append").parquet(versions_log)
    return spark.read.parquet(raw_log).groupBy("dataset_type").agg(F.count("*").alias("n_rows"))


def bootstrap(spark: SparkSession, raw: DataFrame, key_cols: list[str], registry_path: str,
              split: SplitConfig = SplitConfig()):
    """Clean -> stratified split -> encoder fit on train -> forest -> metrics -> version 1."""
    data = clean_binary(raw).withColumn("label", F.col(TARGET).cast("double"))
    parts = stratified_split(data, TARGET, key_cols, split)
    train = parts.filter("split = 'train'")
    val = parts.filter("split = 'val'")
    model = fit_pipeline(train, FeatureEncoder(exclude=[TARGET, "label", "split"] + list(key_cols)), forest(**FOREST_RETRAIN))
    met = regression_metrics(model.transform(val), "label", "prediction")
    row = met.first()
    v = register(spark, registry_path, row["mae"], row["r2"], model=model)
    return model, met, v


def profile_run(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """The full profile of a table as named DataFrames."""
    return {
        "shape": P.shape(df), "column_types": P.column_types(df), "missing": P.missing_report(df),
        "describe": P.describe(df), "target_shape": P.target_shape(df, target),
        "target_profile": P.target_profile(df, target), "value_counts": P.value_counts(df),
        "correlations": P.correlations(df, target), "duplicates": P.duplicate_count(df),
        "histogram": P.histogram(df, target), "bands": P.band_distribution(df, target, GRADE_BAND_EDGES),
        "distinct": P.distinct_counts(df),
    }


def baseline_training(train: DataFrame, val: DataFrame, label: str = "label", features: str = "features",
                      names: list[str] | None = None):
    """Forest + ridge on the same encoded rows; comparison, gates, importances."""
    from tidewatch.operators.models import balanced

    began = time.perf_counter()
    rf = forest(label=label, features=features).fit(balanced(train))
    between = time.perf_counter()
    rg = ridge(train, label=label, features=features)
    seconds = {"random_forest": between - began, "ridge": time.perf_counter() - between}
    preds = rf.transform(val).select(F.lit("random_forest").alias("model"), F.col(label).alias("label"), "prediction").unionByName(
        rg.transform(val).select(F.lit("ridge").alias("model"), F.col(label).alias("label"), "prediction"))
    cmp = compare_models(preds, train_seconds=seconds)
    gates = quality_gates(cmp.filter("model = 'random_forest'").select("mae", "r2", "within_1"))
    imp = feature_importance(rf, names or [f"f{i}" for i in range(rf.numFeatures)], 15, train.sparkSession)
    return {"rf": rf, "ridge": rg, "comparison": cmp, "gates": gates, "importance": imp}


def batch_scoring(model, test: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """Scored rows with error bands, test metrics and test quality gates."""
    scored = model.transform(test).withColumn("abs_error", F.abs(F.col(label) - F.col("prediction")))
    scored = scored.withColumn("status", error_band(F.col("abs_error")))
    met = regression_metrics(scored, label, "prediction")
    gates = quality_gates(met.select("mae", F.col("r2").alias("test_r2"), "within_1"))
    return {"scored": scored, "metrics": met, "gates": gates}
