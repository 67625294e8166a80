"""Model training, scoring and importance on Spark ML."""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import stage_table

# Forest configurations of the reference (trees, depth, leaf size, seed).
FOREST_BASELINE = dict(numTrees=100, maxDepth=10, minInstancesPerNode=2, seed=42)
# "unlimited depth" in the reference; 30 is Spark's maximum tree depth.
FOREST_RETRAIN = dict(numTrees=100, maxDepth=30, minInstancesPerNode=1, seed=42)
RIDGE_ALPHA = 1.0

ROWS_AS_THEY_ARE = 1_000_000  # training rows up to which a forest is one fit over the rows
TREES_AT_ONCE, CELLS_AT_ONCE = 8, 8_000_000  # trees of a binned forest that are fitted side by side; cells they cache together
CELLS_OF_A_TASK = 250_000  # each task of a fit sends the sums of every node, so few tasks send less


def forest(label: str = "label", features: str = "features", **params) -> RandomForestRegressor:
    """M8/M9: every tree sees all features (no per-split subsampling).

    Node ids are cached on the executors and more nodes are split per pass,
    so deep trees need fewer scans of the training rows.
    """
    p = dict(FOREST_BASELINE)
    p.update(params)
    p.setdefault("cacheNodeIds", True)
    p.setdefault("maxMemoryInMB", 1024)
    return RandomForestRegressor(labelCol=label, featuresCol=features, featureSubsetStrategy="all", **p)


def ridge_reg_param(train: DataFrame, label: str, alpha: float = RIDGE_ALPHA) -> float:
    """Spark scales the L2 penalty by the label's spread: regParam = alpha * sigma_pop(y) / n."""
    r = train.agg(F.stddev_pop(F.col(label).cast("double")).alias("s"), F.count("*").alias("n")).first()
    if not r["n"] or not r["s"]:
        return 0.0
    return float(alpha) * float(r["s"]) / float(r["n"])


def ridge(train: DataFrame, label: str = "label", features: str = "features", alpha: float = RIDGE_ALPHA):
    """Ridge regression equal to min ||y - Xb - b0||^2 + alpha ||b||^2."""
    lr = LinearRegression(
        labelCol=label, featuresCol=features, elasticNetParam=0.0, regParam=ridge_reg_param(train, label, alpha),
        standardization=False, solver="normal", fitIntercept=True,
    )
    return lr.fit(train)


def lasso(train: DataFrame, features: list[str], label: str = "label", alpha: float = 1.0, tolerance: float = 1e-12,
          max_rounds: int = 100_000) -> tuple[dict[str, float], float]:
    """Coefficients and intercept of min |y - Xb - b0|^2 / (2 n) + alpha |b|_1.

    One aggregate gives means and covariances (features squared numbers); cyclic
    coordinate descent then works on them alone.  Rows with a null are left out;
    a feature without variance gets 0."""
    names = [*features, label]
    x = train.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)]).na.drop()
    k = len(names)
    row = x.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)],
                *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    if row["m0"] is None:
        return dict.fromkeys(features, 0.0), 0.0
    gram = [[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]
    beta = [0.0] * (k - 1)
    for _ in range(max_rounds):
        moved = 0.0
        for i in range(k - 1):
            if gram[i][i] <= 0:
                continue
            rho = gram[i][k - 1] - sum(gram[i][j] * beta[j] for j in range(k - 1) if j != i)
            new = max(abs(rho) - alpha, 0.0) / gram[i][i] * (1 if rho > 0 else -1) + 0.0
            moved = max(moved, abs(new - beta[i]) * gram[i][i] ** 0.5)
            beta[i] = new
        if moved <= tolerance * max(1.0, gram[k - 1][k - 1] ** 0.5):
            break
    return dict(zip(features, beta)), row[f"m{k - 1}"] - sum(b * row[f"m{i}"] for i, b in enumerate(beta))


def balanced(df: DataFrame) -> DataFrame:
    """Tree learners run one task per input partition on every pass: deal the rows
    to the session's shuffle partitions by a hash of their values, so that neither
    the input's layout nor the cluster's size changes the partitions a fit sees."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType))]
    return df.repartition(n, F.xxhash64(*[F.col(f"`{c}`") for c in plain])) if plain else df.repartition(n)


def bin_edges(rows: DataFrame, names: list[str], bins: int) -> list[list[float]]:
    """Per column the thresholds of at most ``bins`` bins (a value belongs to the first that is not below it):
    halfway between all its values if they are that few, quantiles otherwise.  Null and NaN have no part."""
    rows = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    numbers = [F.when(~F.isnan(c), F.col(c)) for c in rows.columns]
    about = rows.agg(*[F.approx_count_distinct(x).alias(c) for x, c in zip(numbers, rows.columns)]).first()
    few = [c for c in rows.columns if about[c] <= 2 * bins]  # their sets of values are that small
    values = rows.agg(F.lit(0).alias("_"), *[F.collect_set(numbers[rows.columns.index(c)]).alias(c) for c in few]).first().asDict()
    found = {c: sorted(v) for c, v in values.items() if c in few and len(v) <= bins}
    edges = {c: [(a + b) / 2 for a, b in zip(v, v[1:])] for c, v in found.items()}
    many = [c for c in rows.columns if c not in edges]
    if many:
        cuts = rows.approxQuantile(many, [i / bins for i in range(1, bins)], 0.001)
        edges |= {c: sorted(set(q)) for c, q in zip(many, cuts)}
    return [edges[c] for c in rows.columns]


def binning(names: list[str], edges: list[list[float]]) -> SQLTransformer:
    """Adds ``_bin0``, ``_bin1``...: the bin of each column; null and NaN are in the last, as Spark's trees have them."""
    def number(i: int, c: str, cuts: list[float]) -> str:
        whens = " ".join(f"WHEN `{c}` <= {t!r}D THEN {b}D" for b, t in enumerate(cuts))
        return (f"CASE {whens} ELSE {len(cuts)}D END" if cuts else "0D") + f" AS _bin{i}"

    return SQLTransformer(statement=f"SELECT *, {', '.join(number(i, c, t) for i, (c, t) in enumerate(zip(names, edges)))} FROM __THIS__")


def bootstrapped(cells: DataFrame, trees: int, seed: int) -> DataFrame:
    """Cells with ``w0``, ``w1``...: how often a tree's bootstrap sample has the ``n`` rows of the cell.

    A row is drawn Poisson(1) times, as in Spark's forests, so a cell Poisson(n) times.  Cells are dealt by
    hash and sorted: the draws depend on the rows and the session's shuffle partitions only."""
    keys = [c for c in cells.columns if c != "n"]
    dealt = cells.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            n = batch.column("n").to_numpy()
            weights = [pa.array(rng.poisson(n), pa.int64()) for _ in range(trees)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *weights], names=[*batch.schema.names, *(f"w{t}" for t in range(trees))])

    return dealt.mapInArrow(draw, T.StructType([*dealt.schema.fields, *(T.StructField(f"w{t}", T.LongType()) for t in range(trees))]))


def fit_binned(train: DataFrame, encoder, estimator: RandomForestRegressor) -> PipelineModel:
    """The forest of ``estimator`` from counts: rows that agree in label and in every feature's bin are one
    cell, and a tree is fitted to the cells, weighed by its bootstrap sample.

    Spark's trees see bins only, so a cell says all that its rows say.  What is staged is a weight per
    cell and tree; cells are no more than the rows, and no more than labels and bins allow.  The bins
    are those of all rows and a stage of the model, so scoring has the thresholds of training."""
    encoded = encoder.fit(train)
    names, label, trees = encoded.feature_names, estimator.getLabelCol(), estimator.getNumTrees()
    rows = encoded.transform(train)
    binner = binning(names, bin_edges(rows, names, estimator.getMaxBins()))
    bins = VectorAssembler(inputCols=[f"_bin{i}" for i in range(len(names))], outputCol=estimator.getFeaturesCol() + "_binned")
    counted = binner.transform(rows).groupBy(F.col(f"`{label}`").alias("label"), *bins.getInputCols()).agg(F.count("*").alias("n"))
    cells = stage_table(bootstrapped(counted, trees, estimator.getSeed()), "forest-cells")
    total = cells.agg(F.count("*").alias("cells"), *[F.sum(f"w{t}").alias(f"w{t}") for t in range(trees)]).first()
    assembled = bins.transform(cells)

    def grown(t: int):
        # a node's least number of rows is one of weights here, halfway to the next smaller
        least = min(0.499, max(0.0, estimator.getMinInstancesPerNode() - 0.5) / total[f"w{t}"])
        tree = DecisionTreeRegressor(
            labelCol="label", featuresCol=bins.getOutputCol(), weightCol="w", seed=estimator.getSeed() + t, maxDepth=estimator.getMaxDepth(),
            maxBins=estimator.getMaxBins(), minInfoGain=estimator.getMinInfoGain(), minWeightFractionPerNode=least,
            maxMemoryInMB=estimator.getMaxMemoryInMB())
        drawn = assembled.filter(f"w{t} > 0").select("label", bins.getOutputCol(), F.col(f"w{t}").cast("double").alias("w"))
        return tree.fit(drawn.coalesce(1 + total["cells"] // CELLS_OF_A_TASK))

    side_by_side_trees = max(1, min(TREES_AT_ONCE, CELLS_AT_ONCE // max(1, total["cells"])))
    with ThreadPool(side_by_side_trees) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(grown), range(trees), chunksize=1)
    return PipelineModel([encoded, binner, bins, _forest_of(found, estimator, bins.getOutputCol(), len(names))])


def _forest_of(trees: list, estimator: RandomForestRegressor, features: str, n_features: int) -> RandomForestRegressionModel:
    """One Spark forest of fitted trees."""
    sc = SparkContext.getOrCreate()
    kind = sc._jvm.org.apache.spark.ml.regression
    array = sc._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree._java_obj
    model = RandomForestRegressionModel(kind.RandomForestRegressionModel(estimator.uid, array, n_features))
    estimator._copyValues(model)  # as a fit does: the model divides by its numTrees
    model.setFeaturesCol(features)._transfer_params_to_java()
    return model


def _may_bin(estimator) -> bool:
    """Forests that bins and bootstrap weights describe in full."""
    return (isinstance(estimator, RandomForestRegressor) and estimator.getBootstrap() and estimator.getSubsamplingRate() == 1.0
            and estimator.getFeatureSubsetStrategy() == "all" and estimator.getMinWeightFractionPerNode() == 0.0
            and not estimator.isDefined("weightCol") and not estimator.getLeafCol())


def fit_pipeline(train: DataFrame, encoder, estimator) -> PipelineModel:
    """Encoder fitted on the training rows only (M5), then the model; forests over many rows from counts of equal binned rows."""
    if _may_bin(estimator) and train.count() > ROWS_AS_THEY_ARE:
        return fit_binned(train, encoder, estimator)
    return Pipeline(stages=[encoder, estimator]).fit(balanced(train))


def feature_importance(model, names: list[str], top: int | None = 15, spark=None) -> DataFrame:
    """Forest importances with names, highest first."""
    spark = spark or __import__("pyspark").sql.SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()  # model state, one value per feature
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def score(model, df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Batch predict over a table (or a stream)."""
    out = model.transform(df)
    return out if prediction == "prediction" else out.withColumnRenamed("prediction", prediction)


def cross_validate(train: DataFrame, encoder, estimator, grid: dict, key_cols: list[str], folds: int = 5,
                   label: str = "label", seed: int = 42):
    """K-fold cross-validation over a parameter grid with deterministic
    folds (``md5(seed | key)`` bucket), so fold membership does not depend on
    partitioning.  Returns the fitted ``CrossValidatorModel``."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols]))
    fold = (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % folds).cast("int")
    data = train.withColumn("_fold", fold)
    pipe = Pipeline(stages=[encoder, estimator])
    b = ParamGridBuilder()
    for param_name, values in grid.items():
        b = b.addGrid(estimator.getParam(param_name), values)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=b.build(), foldCol="_fold", numFolds=folds,
                        evaluator=RegressionEvaluator(labelCol=label, metricName="mae"), seed=seed)
    return cv.fit(data)


def side_by_side(models: dict, rows: DataFrame, keep: list[str]) -> DataFrame:
    """Score the same rows with several fitted pipelines, one prediction
    column per model name.  Each model sees the original columns (carried
    through the previous transform in a struct), never another model's
    encoded features."""
    cur = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_orig"))
    preds: list[str] = []
    for name, model in models.items():
        scored = model.transform(cur.select("_orig.*", *preds, "_orig"))
        cur = scored.select("_orig", *preds, F.col("prediction").alias(name))
        preds.append(name)
    return cur.select(*[F.col(f"_orig.`{c}`").alias(c) for c in keep], *preds)
