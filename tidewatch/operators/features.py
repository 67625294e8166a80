"""Leakage-free feature encoding as a Spark ML Estimator / Model (M1–M5).

Fit (on the training split only) costs two aggregates: the sorted distinct
categories of the nominal columns (one long-form ``groupBy``) and mean /
population std of the numeric columns (one ``agg``).  Transform is a single
``select`` that emits named double columns in a fixed order — ordinal,
one-hot (first category dropped), scaled numeric, numeric pass-through —
plus an assembled vector for Spark ML.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.longform import Feature, is_numeric_type, single_counts
from tidewatch.schema import NOMINAL, NUMERICAL, ORDINAL, TARGET


# Default of ``maxCategories``: fit fails, naming the columns, above it.
MAX_CATEGORIES = 10_000


def ordinal_code(c: Column, categories: list) -> Column:
    """M1: position in the explicit category list (0-based); unknown/NULL -> -1."""
    arr = F.array(*[F.lit(v) for v in categories])
    return (F.coalesce(F.array_position(arr, c), F.lit(0)) - 1).cast("double")


def onehot_drop_first(c: Column, name: str, categories: list[str]) -> list[Column]:
    """M2: one column per category except the first (sorted); unknown -> all 0."""
    return [F.when(c == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{name}_{v}") for v in categories[1:]]


def standard_scale(c: Column, mean: float, std: float) -> Column:
    """M3: (x - mean) / population std; zero variance divides by 1."""
    s = std if std not in (None, 0.0) else 1.0
    m = mean if mean is not None else 0.0
    return ((c.cast("double") - F.lit(m)) / F.lit(s))


class _EncoderParams(Params):
    ordinal = Param(Params._dummy(), "ordinal", "JSON object: column -> ordered category list", TypeConverters.toString)
    nominal = Param(Params._dummy(), "nominal", "nominal columns", TypeConverters.toListString)
    numerical = Param(Params._dummy(), "numerical", "numeric columns to standard-scale", TypeConverters.toListString)
    exclude = Param(Params._dummy(), "exclude", "columns never used as features", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column", TypeConverters.toString)
    maxCategories = Param(Params._dummy(), "maxCategories", "most categories of one nominal column", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(
            ordinal=json.dumps(ORDINAL), nominal=list(NOMINAL), numerical=list(NUMERICAL),
            exclude=[TARGET], outputCol="features", maxCategories=MAX_CATEGORIES,
        )


class FeatureEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, ordinal=None, nominal=None, numerical=None, exclude=None, outputCol=None,
                 maxCategories=None):
        super().__init__()
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if isinstance(kwargs.get("ordinal"), dict):
            kwargs["ordinal"] = json.dumps(kwargs["ordinal"])
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> "FeatureEncoderModel":
        ordinal = json.loads(self.getOrDefault("ordinal"))
        nominal = [c for c in self.getOrDefault("nominal") if c in df.columns]
        numerical = [c for c in self.getOrDefault("numerical") if c in df.columns]
        categories: dict[str, list[str]] = {c: [] for c in nominal}
        if nominal:
            feats = [Feature(i, c, "categorical") for i, c in enumerate(nominal)]
            # fitted state: the distinct categories, one output column each; every
            # column is held to ``maxCategories`` by itself, counted before the collect
            counted = single_counts(df, feats).select("fid", "cat")
            cap = self.getOrDefault("maxCategories")
            wide = [nominal[r["fid"]] for r in counted.groupBy("fid").agg(F.count("*").alias("k")).filter(F.col("k") > cap).collect()]
            if wide:
                raise ValueError(f"columns {sorted(wide)} have more than maxCategories={cap} categories")
            for r in counted.collect():
                categories[nominal[r["fid"]]].append(r["cat"])
            categories = {k: sorted(v) for k, v in categories.items()}
        scale = {}
        if numerical:
            x = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in numerical}
            row = df.agg(*[F.avg(x[c]).alias(f"m{i}") for i, c in enumerate(numerical)],
                         *[F.stddev_pop(x[c]).alias(f"s{i}") for i, c in enumerate(numerical)]).first()
            scale = {c: [row[f"m{i}"], row[f"s{i}"]] for i, c in enumerate(numerical)}
        used = set(ordinal) | set(nominal) | set(numerical) | set(self.getOrDefault("exclude"))
        passthrough = [f.name for f in df.schema.fields if f.name not in used and is_numeric_type(f.dataType)]
        state = {
            "ordinal": {k: v for k, v in ordinal.items() if k in df.columns},
            "categories": categories,
            "scale": scale,
            "passthrough": passthrough,
        }
        m = FeatureEncoderModel(state=json.dumps(state), outputCol=self.getOrDefault("outputCol"))
        return m


class FeatureEncoderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    @property
    def feature_names(self) -> list[str]:
        s = self.fitted
        names = list(s["ordinal"])
        for c, cats in s["categories"].items():
            names += [f"{c}_{v}" for v in cats[1:]]
        return names + list(s["scale"]) + list(s["passthrough"])

    def encoded_columns(self) -> list[Column]:
        s = self.fitted
        cols = [ordinal_code(F.col(f"`{c}`"), cats).alias(c) for c, cats in s["ordinal"].items()]
        for c, cats in s["categories"].items():
            cols += onehot_drop_first(F.col(f"`{c}`").cast("string"), c, cats)
        cols += [standard_scale(F.col(f"`{c}`"), m, sd).alias(c) for c, (m, sd) in s["scale"].items()]
        cols += [F.col(f"`{c}`").cast("double").alias(c) for c in s["passthrough"]]
        return cols

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.feature_names
        keep = [F.col(f"`{c}`") for c in df.columns if c not in set(names)]
        out = df.select(*keep, *self.encoded_columns())
        va = VectorAssembler(inputCols=names, outputCol=self.getOrDefault("outputCol"), handleInvalid="keep")
        return va.transform(out)
