"""Chi-square test of a 2 x k contingency table per categorical feature.

Category alignment (the outer union of both sides' categories, absent ->
0) falls out of the single ``groupBy(fid, cat)`` with two conditional
counts; no join is needed.  Margins come from a per-feature aggregate that
is broadcast (one row per feature).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.stats import chi2_sf


def categorical_counts(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("cat").isNotNull()).select("fid", F.col("cat").alias("category"), "r", "c")


def chi2_from_counts(counts: DataFrame) -> DataFrame:
    """``fid, n_ref, n_cur, k, dof, statistic, p_value``.

    Expected counts E = row * col / total over all 2k cells, zero cells
    included; with one degree of freedom each |O - E| is reduced by
    min(0.5, |O - E|) (Yates).  One category -> statistic 0, p 1.  A side
    without rows is an invalid table -> statistic 0, p 1.
    """
    cells = categorical_counts(counts)
    margins = cells.groupBy("fid").agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"), F.count("*").alias("k")
    )
    j = cells.join(F.broadcast(margins), "fid")
    n = (F.col("n_ref") + F.col("n_cur")).cast("double")
    col_tot = (F.col("r") + F.col("c")).cast("double")
    e_r = F.try_divide(F.col("n_ref") * col_tot, n)
    e_c = F.try_divide(F.col("n_cur") * col_tot, n)
    yates = F.col("k") == 2

    def term(o, e):
        diff = F.abs(o.cast("double") - e)
        diff = F.when(yates, F.greatest(diff - F.lit(0.5), F.lit(0.0))).otherwise(diff)
        return F.try_divide(diff * diff, e)

    stat = j.groupBy("fid").agg(F.sum(term(F.col("r"), e_r) + term(F.col("c"), e_c)).alias("_stat"))
    out = margins.join(stat, "fid", "left")
    valid = (F.col("n_ref") > 0) & (F.col("n_cur") > 0) & (F.col("k") > 1)
    dof = (F.col("k") - 1).cast("long")
    statistic = F.when(valid, F.col("_stat")).otherwise(F.lit(0.0))
    return out.select(
        "fid",
        "n_ref",
        "n_cur",
        "k",
        dof.alias("dof"),
        statistic.alias("statistic"),
        F.when(valid, chi2_sf(F.col("_stat"), dof)).otherwise(F.lit(1.0)).alias("p_value"),
    )


def category_frequencies(counts: DataFrame) -> DataFrame:
    """Normalised frequency of each category on each side.

    The per-side totals are a per-feature aggregate joined back (broadcast),
    not a window over the feature, so no task holds a whole feature.
    """
    cells = categorical_counts(counts)
    tot = cells.groupBy("fid").agg(F.sum("r").alias("_nr"), F.sum("c").alias("_nc"))
    j = cells.join(F.broadcast(tot), "fid")
    return j.select(
        "fid",
        "category",
        F.col("r").alias("n_ref"),
        F.col("c").alias("n_cur"),
        F.try_divide(F.col("r").cast("double"), F.col("_nr")).alias("freq_ref"),
        F.try_divide(F.col("c").cast("double"), F.col("_nc")).alias("freq_cur"),
    )

