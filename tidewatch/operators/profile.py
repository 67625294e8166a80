"""Table profiling (A1–A13, P10–P12, P24): one wide aggregate, then unpivot.

Every per-column statistic is computed for all columns in one pass and the
single result row is turned long with ``stack``; quantiles are exact, and the
two ways to compute them (value map, bucketed running sums) share one formula.
NaN counts as missing everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.stats import adjusted_kurtosis, adjusted_skewness
from tidewatch.operators.longform import Feature, is_numeric_type, single_counts
from tidewatch.operators.prefix import EXACT_MAP_LIMIT, weighted_quantiles


def _q(name: str):
    return F.col(f"`{name}`")


def _present(df: DataFrame, name: str):
    """The column with NaN as NULL."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(_q(name)), _q(name))
    return _q(name)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric_type(f.dataType)]


def _long(row_df: DataFrame, names: list[str], stats: list[str]) -> DataFrame:
    """Unpivot a one-row ``<stat>__<i>`` frame to ``feature, <stats...>``."""
    args = []
    for i, n in enumerate(names):
        args += [F.lit(n)] + [F.col(f"{s}__{i}") for s in stats]
    return row_df.select(F.stack(F.lit(len(names)), *args).alias("feature", *stats))


def shape(df: DataFrame) -> DataFrame:
    """A1: row and column counts."""
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))


def column_types(df: DataFrame) -> DataFrame:
    """Numeric and categorical column counts beside the row count (one row)."""
    n_num = len(numeric_columns(df))
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(n_num).cast("long").alias("n_numeric"),
        F.lit(len(df.columns) - n_num).cast("long").alias("n_categorical"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def distinct_counts(df: DataFrame, columns=None, approx: bool = False) -> DataFrame:
    """A2: distinct non-null values per column."""
    cols = columns or df.columns
    fn = (lambda c: F.approx_count_distinct(_present(df, c))) if approx else (lambda c: F.count_distinct(_present(df, c)))
    row = df.agg(*[fn(c).alias(f"n_distinct__{i}") for i, c in enumerate(cols)])
    return _long(row, cols, ["n_distinct"])


def _missing_expr(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    cond = _q(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        cond = cond | F.isnan(_q(c))
    return cond


def missing_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing count and percent per column, most missing first."""
    cols = df.columns
    row = df.agg(
        F.count("*").alias("_n"), *[F.count_if(_missing_expr(df, c)).alias(f"missing__{i}") for i, c in enumerate(cols)]
    )
    args = []
    for i, c in enumerate(cols):
        args += [F.lit(c), F.col(f"missing__{i}")]
    out = row.select("_n", F.stack(F.lit(len(cols)), *args).alias("feature", "missing_count")).select(
        "feature", "missing_count", (F.try_divide(F.col("missing_count") * 100.0, F.col("_n"))).alias("missing_pct")
    )
    if only_missing:
        out = out.filter(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_count"), "feature")


def zero_counts(df: DataFrame, columns) -> DataFrame:
    """Rows equal to zero per column, count and percent."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(_q(c) == 0).alias(f"zeros__{i}") for i, c in enumerate(columns)])
    args = []
    for i, c in enumerate(columns):
        args += [F.lit(c), F.col(f"zeros__{i}")]
    return row.select("_n", F.stack(F.lit(len(columns)), *args).alias("feature", "zero_count")).select(
        "feature", "zero_count", F.try_divide(F.col("zero_count") * 100.0, F.col("_n")).alias("zero_pct")
    )


def quantiles_by_column(df: DataFrame, columns, probs, map_limit: int = EXACT_MAP_LIMIT,
                        known_small: bool = False, distinct_hint: dict | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of many columns: ``feature, prob, q``.

    A column's non-null count bounds its distinct count.  Columns under
    ``map_limit`` go to Spark's exact ``percentile`` (its per-column map is
    then bounded): one global aggregate for a single column, one aggregate
    per feature over the long form for several.  Larger columns go through
    the long form to :func:`weighted_quantiles`, which measures the exact
    distinct counts and uses the bucketed running sums where needed, so no
    column ever sits whole in one task.  ``distinct_hint`` (column -> bound)
    reuses counts the caller already has; ``known_small`` asserts the bound.
    """
    spark = df.sparkSession
    cols = list(columns)
    vals = {c: F.when(~F.isnan(_q(c).cast("double")), _q(c).cast("double")) for c in cols}
    if known_small:
        small = cols
    else:
        if distinct_hint is None:
            row = df.agg(*[F.count(vals[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
            distinct_hint = {c: row[f"n{i}"] for i, c in enumerate(cols)}
        small = [c for c in cols if (distinct_hint.get(c) or 0) <= map_limit]
    wide = [c for c in cols if c not in small]
    parts = []
    pr = spark.createDataFrame([(i, float(p)) for i, p in enumerate(probs)], "_pi int, prob double")
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if len(small) == 1:  # one column: one global aggregate over the raw rows
        c = small[0]
        e = df.agg(F.percentile(vals[c], arr).alias("_qs")).select(F.lit(c).alias("feature"), F.posexplode("_qs").alias("_pi", "q"))
        parts.append(e.join(F.broadcast(pr), "_pi").select("feature", "prob", "q"))
    elif small:  # many columns: one percentile map per feature, merged in parallel tasks
        feats = [Feature(i, c, "numerical") for i, c in enumerate(small)]
        q = single_counts(df, feats).groupBy("fid").agg(F.percentile(F.col("num"), arr, F.col("n")).alias("_qs"))
        names = spark.createDataFrame([(f.fid, f.name) for f in feats], "fid int, feature string")
        e = q.join(F.broadcast(names), "fid").select("feature", F.posexplode("_qs").alias("_pi", "q"))
        parts.append(e.join(F.broadcast(pr), "_pi").select("feature", "prob", "q"))
    if wide:
        feats = [Feature(i, c, "numerical") for i, c in enumerate(wide)]
        cnt = single_counts(df, feats).select("fid", F.col("num").alias("value"), "n")
        q = weighted_quantiles(cnt, ["fid"], "value", "n", probs, map_limit=map_limit)
        names = spark.createDataFrame([(f.fid, f.name) for f in feats], "fid int, feature string")
        parts.append(q.join(F.broadcast(names), "fid").select("feature", "prob", "q"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe(df: DataFrame, columns=None) -> DataFrame:
    """A5: count, mean, std (sample), min, 25/50/75 % (linear), max per numeric column."""
    cols = columns or numeric_columns(df)
    stats = ["count", "mean", "std", "min", "max"]
    aggs = []
    for i, c in enumerate(cols):
        x = _present(df, c).cast("double")
        aggs += [
            F.count(x).alias(f"count__{i}"), F.avg(x).alias(f"mean__{i}"), F.stddev_samp(x).alias(f"std__{i}"),
            F.min(x).alias(f"min__{i}"), F.max(x).alias(f"max__{i}"),
        ]
    row = df.agg(*aggs).first()  # one row: moments and a distinct-count bound per column
    spark = df.sparkSession
    base = spark.createDataFrame(
        [(c, row[f"count__{i}"], row[f"mean__{i}"], row[f"std__{i}"], row[f"min__{i}"], row[f"max__{i}"]) for i, c in enumerate(cols)],
        "feature string, count long, mean double, std double, min double, max double",
    )
    qs = quantiles_by_column(df, cols, [0.25, 0.5, 0.75], distinct_hint={c: row[f"count__{i}"] for i, c in enumerate(cols)})
    piv = qs.groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("q"))).alias("p25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("q"))).alias("p50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("q"))).alias("p75"),
    )
    return base.join(piv, "feature", "left").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def target_shape(df: DataFrame, column: str) -> DataFrame:
    """Mean, median, std, min, max, bias-adjusted skewness and excess kurtosis."""
    x = _present(df, column).cast("double")
    base = df.agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
        F.max(x).alias("max"), F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"),
    )
    med = quantiles_by_column(df, [column], [0.5]).select("q").scalar()
    return base.select(
        F.lit(column).alias("feature"), "n", "mean", med.alias("median"), "std", "min", "max",
        adjusted_skewness(F.col("_g1"), F.col("n")).alias("skewness"),
        adjusted_kurtosis(F.col("_g2"), F.col("n")).alias("kurtosis"),
    )


def target_profile(df: DataFrame, column: str) -> DataFrame:
    """Dtype, distinct count, min, max, range of the target."""
    x = _present(df, column)
    return df.agg(F.count_distinct(x).alias("n_distinct"), F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max")).select(
        F.lit(column).alias("feature"), F.lit(df.schema[column].dataType.simpleString()).alias("dtype"),
        "n_distinct", "min", "max", (F.col("max") - F.col("min")).alias("range"),
    )


def right_closed_band(x, edges):
    """Label of the right-closed interval (lowest edge included); outside -> NULL."""
    expr = F.when((x >= edges[0]) & (x <= edges[1]), F.lit(0))
    for i in range(1, len(edges) - 1):
        expr = expr.when((x > edges[i]) & (x <= edges[i + 1]), F.lit(i))
    return expr


def band_distribution(df: DataFrame, column, edges) -> DataFrame:
    """Rows per right-closed band, in band order; bands with no rows shown as 0."""
    x = column if not isinstance(column, str) else _q(column)
    labels = [f"{edges[i]}-{edges[i + 1]}" for i in range(len(edges) - 1)]
    spark = df.sparkSession
    bands = spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "band int, label string")
    cnt = df.select(right_closed_band(x, edges).alias("band")).groupBy("band").agg(F.count("*").alias("n"))
    return bands.join(cnt, "band", "left").select("band", "label", F.coalesce("n", F.lit(0)).alias("n")).orderBy("band")


def value_counts(df: DataFrame, columns=None, max_columns: int | None = 5) -> DataFrame:
    """Every value of the first ``max_columns`` categorical columns with its count.

    One aggregate over the long form: a value's rows meet after map-side
    combining, and no column is sorted or held in one task."""
    cols = columns or categorical_columns(df)[:max_columns]
    feats = [Feature(i, c, "categorical") for i, c in enumerate(cols)]
    cnt = single_counts(df, feats).select("fid", F.col("cat").alias("value"), "n")
    names = df.sparkSession.createDataFrame([(f.fid, f.name) for f in feats], "fid int, feature string")
    return cnt.join(F.broadcast(names), "fid").select("feature", "value", F.col("n").alias("count"))


def correlations(df: DataFrame, target: str, top: int | None = 10, columns=None) -> DataFrame:
    """Pearson correlation of every numeric column with ``target``, pairwise complete."""
    cols = [c for c in (columns or numeric_columns(df)) if c != target]
    y = _present(df, target).cast("double")
    row = df.agg(*[F.corr(_present(df, c).cast("double"), y).alias(f"corr__{i}") for i, c in enumerate(cols)])
    out = _long(row, cols, ["corr"]).filter(F.col("corr").isNotNull())
    out = out.orderBy(F.desc("corr"), "feature")
    return out.limit(top) if top else out


def duplicate_count(df: DataFrame) -> DataFrame:
    """A10: rows that repeat an earlier identical row."""
    g = df.groupBy(*[_q(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin; NULL and NaN are left out."""
    value = _present(df, column).cast("double")
    lo = df.agg(F.min(value)).scalar()
    hi = df.agg(F.max(value)).scalar()
    x = df.select(value.alias("_x")).filter(F.col("_x").isNotNull())
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - lo) / ((hi - lo) / bins)).cast("int"), F.lit(bins - 1))
    )
    cnt = x.groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    return cnt.select(
        "bin",
        (lo + F.col("bin") * (hi - lo) / bins).alias("bin_start"),
        (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("bin_end"),
        "n",
    )


def range_outliers(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """P10: rows outside the closed range [lo, hi]; NULL and NaN are no outliers."""
    x = _present(df, column)
    return df.agg(F.count_if((x > hi) | (x < lo)).alias("n_outliers"), F.count("*").alias("n_rows"))


def column_dictionary(df: DataFrame, descriptions: dict[str, tuple[str, str]]) -> DataFrame:
    """Feature, description, category, dtype and distinct count."""
    spark = df.sparkSession
    rows = [(c, *descriptions.get(c, ("", "")), df.schema[c].dataType.simpleString()) for c in df.columns]
    meta = spark.createDataFrame(rows, "feature string, description string, category string, dtype string")
    return meta.join(distinct_counts(df), "feature", "left")
