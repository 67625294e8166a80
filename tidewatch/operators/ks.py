"""Two-sample Kolmogorov–Smirnov per numeric feature, exact D (A15) + mean shift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.stats import ks_exact_pvalue, ks_pvalue
from tidewatch.operators.prefix import running_sums


def numeric_counts(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("num").isNotNull()).select("fid", F.col("num").alias("value"), "r", "c")


def side_totals(num: DataFrame) -> DataFrame:
    """Per feature: sizes and means of both sides (one small aggregate)."""
    return num.groupBy("fid").agg(
        F.sum("r").alias("n_ref"),
        F.sum("c").alias("n_cur"),
        weighted_mean(F.col("value"), "r", F.sum("r")).alias("mean_ref"),
        weighted_mean(F.col("value"), "c", F.sum("c")).alias("mean_cur"),
    )


def weighted_mean(value, weight: str, total):
    """Mean over the rows of one side; a value the side lacks (even an infinite one) adds nothing."""
    return F.try_divide(F.sum(F.when(F.col(weight) > 0, value * F.col(weight)).otherwise(F.lit(0.0))), total)


def ks_from_counts(counts: DataFrame, buckets: int | None = None, exact_up_to: int = 0) -> DataFrame:
    """``fid, n_ref, n_cur, statistic, p_value, mean_ref, mean_cur, mean_shift``.

    D = max |F_ref - F_cur| evaluated at every distinct value; both ECDFs are
    running sums of the per-value counts (ties collapse into one step).  With
    ``exact_up_to``, samples of at most so many rows a side get the exact p.
    """
    num = numeric_counts(counts)
    tot = side_totals(num)
    cum = running_sums(num, ["fid"], "value", ["r", "c"], buckets=buckets)
    sizes = tot.select("fid", "n_ref", "n_cur")
    d = (
        cum.join(F.broadcast(sizes), "fid")
        .groupBy("fid")
        .agg(
            F.max(F.abs(F.try_divide(F.col("cum_r"), F.col("n_ref")) - F.try_divide(F.col("cum_c"), F.col("n_cur")))).alias(
                "statistic"
            )
        )
    )
    out = tot.join(d, "fid", "left")
    return out.select(
        "fid",
        "n_ref",
        "n_cur",
        F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.col("statistic")).alias("statistic"),
        ks_p(F.col("statistic"), F.col("n_ref"), F.col("n_cur"), exact_up_to).alias("p_value"),
        "mean_ref",
        "mean_cur",
        mean_shift(F.col("mean_ref"), F.col("mean_cur")).alias("mean_shift"),
    )


def ks_p(d, n, m, exact_up_to: int = 0):
    return ks_exact_pvalue(d, n, m, exact_up_to) if exact_up_to else ks_pvalue(d, n, m)


def mean_shift(mean_ref, mean_cur):
    """abs((cur - ref) / ref); 0.0 when the reference mean is 0."""
    return F.when(mean_ref.isNull() | mean_cur.isNull(), F.lit(None).cast("double")).when(
        mean_ref == 0, F.lit(0.0)
    ).otherwise(F.abs((mean_cur - mean_ref) / mean_ref))
