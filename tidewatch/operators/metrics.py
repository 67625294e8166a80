"""Regression metrics in one aggregate per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.prefix import weighted_quantiles

WITHIN_K = (1, 2, 3)


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", group: list[str] | None = None,
    with_median: bool = True,
) -> DataFrame:
    """MAE, RMSE, R², explained variance, max error, median absolute error,
    within-k accuracy (percent) and MAPE (zero labels excluded).  ``n`` counts all rows; those whose
    label or prediction is NULL or NaN take no part in the measures."""
    group = list(group or [])
    y = F.col(label).cast("double")
    e = y - F.col(prediction).cast("double")
    e = F.when(~F.isnan(e), e)
    base = df.select(*group, F.when(e.isNotNull(), y).alias("_y"), e.alias("_e"))
    aggs = [
        F.count("*").alias("n"),
        F.avg(F.abs("_e")).alias("mae"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.avg(F.col("_e") * F.col("_e")), F.var_pop("_y"))).alias("r2"),
        (F.lit(1.0) - F.try_divide(F.var_pop("_e"), F.var_pop("_y"))).alias("explained_variance"),
        F.max(F.abs("_e")).alias("max_error"),
        *[(F.avg((F.abs("_e") <= k).cast("double")) * 100.0).alias(f"within_{k}") for k in WITHIN_K],
        (F.avg(F.when(F.col("_y") != 0, F.abs(F.col("_e") / F.col("_y")))) * 100.0).alias("mape"),
    ]
    out = base.groupBy(*group).agg(*aggs) if group else base.agg(*aggs)
    if not with_median:
        return out
    keys = group or ["_g"]
    src = base if group else base.withColumn("_g", F.lit(0))
    cnt = src.groupBy(*keys, F.abs("_e").alias("_ae")).agg(F.count("*").alias("_w"))
    med = weighted_quantiles(cnt, keys, "_ae", "_w", [0.5], out="median_ae").drop("prob")
    if group:
        return out.join(med, group, "left")
    return out.select("*", med.select("median_ae").scalar().alias("median_ae"))


def compare_models(predictions: DataFrame, model_col: str = "model", label: str = "label", prediction: str = "prediction",
                   train_seconds: dict[str, float] | None = None) -> DataFrame:
    """Metrics per model, given training times, and a flag for the best by R² (ties: lowest MAE, then name)."""
    m = regression_metrics(predictions, label, prediction, group=[model_col], with_median=False)
    if train_seconds:
        seconds = F.create_map(*[F.lit(x) for pair in sorted(train_seconds.items()) for x in pair])
        m = m.withColumn("train_seconds", F.try_element_at(seconds, F.col(model_col)).cast("double"))
    # one row per model: a single-partition window over the model list is bounded
    best = F.max_by(model_col, F.struct(F.col("r2"), -F.col("mae"), F.col(model_col))).over(Window.partitionBy(F.lit(1)))
    return m.select(*m.columns, (F.col(model_col) == best).alias("is_best"))


def promote(champion_mae, challenger_mae, min_improvement: float = 0.01):
    """Promote iff challenger MAE < champion MAE - min_improvement (strict)."""
    return challenger_mae < champion_mae - F.lit(min_improvement)


def overfit_gap(metrics_by_split: DataFrame, split_col: str = "split", a: str = "train", b: str = "val") -> DataFrame:
    """Metric per split side by side with the difference."""
    cols = ["mae", "rmse", "r2", "within_1"]
    piv = metrics_by_split.groupBy(F.lit(1).alias("_k")).agg(
        *[F.max(F.when(F.col(split_col) == a, F.col(c))).alias(f"{c}_{a}") for c in cols],
        *[F.max(F.when(F.col(split_col) == b, F.col(c))).alias(f"{c}_{b}") for c in cols],
    )
    return piv.select(*[F.col(f"{c}_{a}") for c in cols], *[F.col(f"{c}_{b}") for c in cols],
                      *[(F.col(f"{c}_{b}") - F.col(f"{c}_{a}")).alias(f"{c}_gap") for c in cols])
