"""Forests over many rows: fitted from counts of equal binned rows."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidewatch.operators import models
from tidewatch.operators.features import FeatureEncoder
from tidewatch.operators.metrics import regression_metrics
from tidewatch.operators.models import bin_edges, binning, fit_pipeline, forest


def _rows(spark, n):
    x = (F.col("id") * 7919 % 1000).cast("double")
    flag = F.when(F.col("id") % 3 == 0, "a").otherwise("b")
    return spark.range(n).select("id", flag.alias("flag"), x.alias("x"), (F.floor(x / 100) + F.when(flag == "a", 5).otherwise(0)).cast("double").alias("label"))


def _encoder():
    return FeatureEncoder(ordinal={}, nominal=["flag"], numerical=["x"], exclude=["id", "label"])


def test_fit_keeps_cells_not_rows_times_trees(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "ROWS_AS_THEY_ARE", 1000)
    staged = []

    def stage(df, name, real=models.stage_table):
        staged.append(real(df, name))
        return staged[-1]

    monkeypatch.setattr(models, "stage_table", stage)
    made = []
    for n in (6000, 24000):
        model = fit_pipeline(_rows(spark, n), _encoder(), forest(numTrees=6, maxDepth=5))
        cells = staged[-1]
        made.append(cells.count())
        assert cells.agg(F.sum("n")).first()[0] == n
        drawn = [cells.agg(F.sum(f"w{t}")).first()[0] for t in range(6)]
        assert all(abs(d - n) < 6 * n ** 0.5 for d in drawn) and len(set(drawn)) > 1  # Poisson(1) for each row
    assert abs(made[0] - made[1]) < 10  # four times the rows, as many cells but for the approximate quantiles
    rf = model.stages[-1]
    assert rf.getNumTrees == 6 and rf.featureImportances.toArray().sum() == pytest.approx(1.0)
    r2 = regression_metrics(model.transform(_rows(spark, 24000))).first()["r2"]
    monkeypatch.setattr(models, "ROWS_AS_THEY_ARE", 10**9)
    direct = fit_pipeline(_rows(spark, 24000), _encoder(), forest(numTrees=6, maxDepth=5))
    assert r2 == pytest.approx(regression_metrics(direct.transform(_rows(spark, 24000))).first()["r2"], abs=0.02)
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(_rows(spark, 50)).orderBy("id").select("prediction").collect()
    assert again == model.transform(_rows(spark, 50)).orderBy("id").select("prediction").collect()


def test_leaves_hold_the_least_number_of_rows_not_of_cells(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_AS_THEY_ARE", 100)
    rows = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("flag"),
                                    F.lit(1.0).alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    model = fit_pipeline(rows, _encoder(), forest(numTrees=3, maxDepth=3))  # one cell on each side
    assert [t.numNodes for t in model.stages[-1].trees] == [3, 3, 3]
    assert [r[0] for r in model.transform(rows).select((F.col("prediction") - F.col("label")).alias("e")).distinct().collect()] == [0.0]


def test_bins_hold_all_values_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(100)] + [(3.0, None), (None, float("nan"))], "few double, many double")
    edges = bin_edges(df, ["few", "many"], 8)
    assert edges[0] == [2.0] and len(edges[1]) == 7 and edges[1] == sorted(edges[1])
    out = binning(["few", "many"], edges).transform(df)
    assert {(r["few"], r["_bin0"]) for r in out.collect()} == {(1.0, 0.0), (3.0, 1.0), (None, 1.0)}
    assert {r["_bin1"] for r in out.filter("many is null or isnan(many)").collect()} == {7.0}
    sizes = [r["count"] for r in out.filter("many is not null and not isnan(many)").groupBy("_bin1").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2
