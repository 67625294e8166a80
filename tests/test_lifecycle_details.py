"""Version claims, saved artefacts, history rows, NaN in measures, short bands, zero rows and feature names."""

from pyspark.sql import functions as F

from tidewatch.functions.scalar import error_band
from tidewatch.operators.clean import remove_zero_rows
from tidewatch.operators.metrics import compare_models, regression_metrics
from tidewatch.operators.profile import histogram, range_outliers
from tidewatch.operators.registry import _read, flatten_history, history_versions, metadata, register, saved_versions
from tidewatch.sinks.tables import feature_names_document


class _Model:
    """Saves a file; ``meanwhile`` runs before, as another writer would."""

    def __init__(self, spark, meanwhile=lambda: None):
        self.spark, self.meanwhile = spark, meanwhile

    def write(self):
        return self

    def overwrite(self):
        return self

    def save(self, path):
        self.meanwhile()
        self.spark.range(1).write.parquet(path)


def test_two_writers_get_two_versions(spark, tmp_path):
    path = str(tmp_path / "versions")
    other = []
    slow = _Model(spark, lambda: other.append(register(spark, path, 1.0, 0.9, model=_Model(spark))))
    assert register(spark, path, 1.2, 0.8, model=slow) == 1 and other == [2]
    rows = {r.version: r.filepath for r in _read(spark, path).collect()}
    assert rows == {1: f"{path}-models/model_v1", 2: f"{path}-models/model_v2"}
    assert saved_versions(spark, path) == [1, 2]
    assert register(spark, path, 0.9, 0.9) == 3


def test_a_lost_table_goes_on_above_the_saved_models(spark, tmp_path):
    path = str(tmp_path / "versions")
    _Model(spark).save(f"{path}-models/model_v7")
    _Model(spark).save(f"{path}-models/notes")
    assert register(spark, path, 1.0, 0.9) == 8


def test_history_rows_come_back_from_the_document(spark, tmp_path):
    path = str(tmp_path / "versions")
    for mae in (1.5, 1.25):
        register(spark, path, mae, 0.9)
    versions = _read(spark, path)
    back = history_versions(metadata(versions))
    assert back.dtypes == versions.dtypes
    key = ["version", "mae", "r2", "filepath"]
    assert sorted(back.select(key).collect()) == sorted(versions.select(key).collect())
    assert {(r.version, r.is_active) for r in flatten_history(metadata(back)).collect()} == {("v1", False), ("v2", True)}


def test_nan_takes_no_part(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert sorted(tuple(r) for r in histogram(df, "x", 2).collect()) == [(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 1)]
    assert tuple(range_outliers(df, "x", 0, 2).first()) == (1, 4)
    scored = spark.createDataFrame([(1.0, 1.5), (3.0, 3.5), (float("nan"), 1.0), (2.0, float("nan")), (None, 1.0)], "label double, prediction double")
    m = regression_metrics(scored).first()
    assert (m.n, m.mae, m.rmse, m.max_error, m.within_1, m.median_ae) == (5, 0.5, 0.5, 0.5, 100.0, 0.5)
    assert m.r2 == 0.75


def test_comparison_has_training_times_and_no_median(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 2.0), ("b", 1.0, 2.0), ("b", 2.0, 2.0)]
    out = compare_models(spark.createDataFrame(rows, "model string, label double, prediction double"), train_seconds={"a": 0.5})
    assert "median_ae" not in out.columns
    assert {r.model: (r.is_best, r.train_seconds) for r in out.collect()} == {"a": (True, 0.5), "b": (False, None)}


def test_bands_zero_rows_and_names(spark):
    e = spark.createDataFrame([(1.0,), (2.0,), (2.5,)], "e double")
    assert [r[0] for r in e.select(error_band(F.col("e"), short=True)).collect()] == ["Excellent", "Good", "Fair"]
    z = spark.createDataFrame([(0, 1), (1, None), (2, 0), (3, 4)], "a int, b int")
    assert [r.a for r in remove_zero_rows(z, ["a", "b"]).orderBy("a").collect()] == [1, 3]
    doc = feature_names_document(spark, ["age", "sex_M"]).first()
    assert doc.features == ["age", "sex_M"] and doc.metadata.num_features == 2
    assert feature_names_document(spark, []).first().features == []
