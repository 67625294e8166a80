"""Drift detection job (W1): per-feature decision, reasons and summary.

Both tables are scanned once (``detect_drift_split``: one table, the side
a per-row expression), unpivoted into the long form and counted with
map-side-combined aggregates.  The counts — one row per distinct value per
feature — are written once to the shared checkpoint folder; KS, mean shift
and chi-square then read that table: in one fused window pass when every
feature fits a task, otherwise with bucketed running sums.  Every later
step works on per-value or per-feature rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import DriftConfig
from tidewatch.operators.chi2 import chi2_from_counts
from tidewatch.operators.ks import ks_from_counts
from tidewatch.operators.longform import (
    CATEGORICAL,
    NUMERICAL,
    Feature,
    common_features,
    feature_frame,
    long_counts,
    long_counts_split,
)
from tidewatch.operators.prefix import auto_buckets
from tidewatch.operators.stored_profile import StoredProfile, stats_against
from tidewatch.session import stage_table

# The reasons the reference attaches to a drifted feature.
REASON_KS = "KS-Test P-value significant"
REASON_CHI2 = "Chi-Square P-value significant"
REASON_MEAN_FMT = "Mean shift > {pct:.0f}%"
# Ours (the reference crashes here): a numeric feature empty on one side.
REASON_EMPTY = "insufficient data"


@dataclass
class DriftReport:
    details: DataFrame  # one row per feature
    summary: DataFrame  # one row
    features: list[Feature]

    def as_json(self) -> DataFrame:
        """``{summary:{...}, details:{feature:{type, drift_detected, statistical_metrics, reasons}}}``."""
        entry = F.struct(
            F.col("type"),
            F.col("drift_detected"),
            F.struct(F.col("statistic"), F.col("p_value")).alias("statistical_metrics"),
            F.col("reasons"),
        )
        det = self.details.agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("feature"), entry))))
        ).scalar()  # one map with one entry per feature
        summ = self.summary.select(F.struct(*self.summary.columns).alias("summary"))
        return summ.select(F.to_json(F.struct(F.col("summary"), det.alias("details"))).alias("report"))


def _adjust(p: Column, method: str | None, m: Column, group: tuple[str, ...] = ()) -> Column:
    if method is None:
        return p
    if method == "bonferroni":
        return F.least(p * m, F.lit(1.0))
    if method == "bh":
        # Benjamini–Hochberg step-up over the (small) per-feature table.
        w = Window.partitionBy(*group).orderBy(F.col("p_value").asc_nulls_last())
        wr = Window.partitionBy(*group).orderBy(F.col("p_value").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        raw = p * m / F.row_number().over(w)
        return F.least(F.min(raw).over(wr), F.lit(1.0))
    raise ValueError(f"unknown correction {method!r}")


def choose_buckets(counts: DataFrame, config: DriftConfig) -> int:
    """Bucket count so that a running-sum task holds <= rows_per_bucket values.

    One tiny aggregate over the staged counts (one row per feature); the
    widest feature of either kind decides.
    """
    if config.ks_buckets is not None:
        return int(config.ks_buckets)
    return auto_buckets(counts, ["fid"], config.rows_per_bucket)


def fused_stats(counts: DataFrame, exact_up_to: int = 0) -> DataFrame:
    """KS, means and chi-square of every feature in one window pass.

    Used when every feature fits one task (checked by :func:`choose_buckets`):
    one repartition by feature, one sort serving both the running sums and
    the whole-feature margins, one aggregate.  Returns one row per feature:
    ``fid, n_ref, n_cur, statistic, p_value, mean_ref, mean_cur, mean_shift, dof``.
    """
    from tidewatch.functions.stats import chi2_sf
    from tidewatch.operators.ks import ks_p, mean_shift, weighted_mean

    nparts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = Window.partitionBy("fid").orderBy("num").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("fid").orderBy("num").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = counts.repartition(nparts, "fid").select(
        "fid", "num", "cat", "r", "c",
        F.sum("r").over(run).alias("_cr"), F.sum("c").over(run).alias("_cc"),
        F.sum("r").over(whole).alias("_nr"), F.sum("c").over(whole).alias("_nc"), F.count("*").over(whole).alias("_k"),
    )
    n = (F.col("_nr") + F.col("_nc")).cast("double")
    col_tot = (F.col("r") + F.col("c")).cast("double")
    e_r = F.try_divide(F.col("_nr") * col_tot, n)
    e_c = F.try_divide(F.col("_nc") * col_tot, n)

    def term(o, e):
        d = F.abs(o.cast("double") - e)
        d = F.when(F.col("_k") == 2, F.greatest(d - F.lit(0.5), F.lit(0.0))).otherwise(d)
        return F.try_divide(d * d, e)

    gap = F.abs(F.try_divide(F.col("_cr"), F.col("_nr")) - F.try_divide(F.col("_cc"), F.col("_nc")))
    a = x.groupBy("fid").agg(
        F.first("_nr").alias("n_ref"), F.first("_nc").alias("n_cur"), F.first("_k").alias("k"),
        F.max(F.when(F.col("num").isNotNull(), gap)).alias("_d"),
        weighted_mean(F.col("num"), "r", F.first("_nr")).alias("mean_ref"),
        weighted_mean(F.col("num"), "c", F.first("_nc")).alias("mean_cur"),
        F.sum(F.when(F.col("cat").isNotNull(), term(F.col("r"), e_r) + term(F.col("c"), e_c))).alias("_stat"),
        F.bool_or(F.col("num").isNotNull()).alias("_is_num"),
    )
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    valid = both & (F.col("k") > 1)
    dof = (F.col("k") - 1).cast("long")
    is_num = F.col("_is_num")
    # one row per feature for both kinds: no second branch over the window
    return a.select(
        "fid", "n_ref", "n_cur",
        F.when(is_num, F.when(both, F.col("_d"))).otherwise(F.when(valid, F.col("_stat")).otherwise(F.lit(0.0))).alias("statistic"),
        F.when(is_num, ks_p(F.when(both, F.col("_d")), F.col("n_ref"), F.col("n_cur"), exact_up_to)).otherwise(
            F.when(valid, chi2_sf(F.col("_stat"), dof)).otherwise(F.lit(1.0))).alias("p_value"),
        F.when(is_num, F.col("mean_ref")).alias("mean_ref"), F.when(is_num, F.col("mean_cur")).alias("mean_cur"),
        F.when(is_num, mean_shift(F.col("mean_ref"), F.col("mean_cur"))).alias("mean_shift"),
        F.when(~is_num, dof).alias("dof"),
    )


def drift_details(counts: DataFrame, features: list[Feature], config: DriftConfig = DriftConfig()) -> DataFrame:
    spark = counts.sparkSession
    buckets = choose_buckets(counts, config)
    if buckets <= 1:
        stats = fused_stats(counts, config.ks_exact_up_to)
    else:
        ks = ks_from_counts(counts, buckets=buckets, exact_up_to=config.ks_exact_up_to)
        ch = chi2_from_counts(counts)
        stats = ks.select("fid", "n_ref", "n_cur", "statistic", "p_value", "mean_ref", "mean_cur", "mean_shift",
                          F.lit(None).cast("long").alias("dof")).unionByName(
            ch.select("fid", "n_ref", "n_cur", "statistic", "p_value", F.lit(None).cast("double").alias("mean_ref"),
                      F.lit(None).cast("double").alias("mean_cur"), F.lit(None).cast("double").alias("mean_shift"), "dof"))
    meta = feature_frame(spark, features)
    return decide(meta.join(F.broadcast(stats), "fid", "left"), config, len(features))  # stats: one row per feature


def decide(d: DataFrame, config: DriftConfig, n_features: int, group: tuple[str, ...] = ()) -> DataFrame:
    """Decision and reasons (A17) of rows (fid, feature, type, statistics), one per feature and ``group``."""
    is_cat = F.col("type") == CATEGORICAL
    d = d.select(
        *group, "fid", "feature", "type",
        F.when(is_cat, F.coalesce("n_ref", F.lit(0))).otherwise(F.col("n_ref")).alias("n_ref"),
        F.when(is_cat, F.coalesce("n_cur", F.lit(0))).otherwise(F.col("n_cur")).alias("n_cur"),
        F.when(is_cat, F.coalesce("statistic", F.lit(0.0))).otherwise(F.col("statistic")).alias("statistic"),
        F.when(is_cat, F.coalesce("p_value", F.lit(1.0))).otherwise(F.col("p_value")).alias("p_value"),
        "mean_ref", "mean_cur", "mean_shift", "dof",
    )
    # features x groups rows: single-partition windows below are over the feature list only
    d = d.coalesce(1)
    d = d.withColumn("p_value", _adjust(F.col("p_value"), config.correction, F.lit(n_features).cast("double"), group))
    alpha, theta = config.p_value_threshold, config.mean_diff_threshold
    p_drift = F.coalesce(F.col("p_value") < alpha, F.lit(False))
    mean_drift = F.coalesce(F.col("mean_shift") > theta, F.lit(False))
    is_num = F.col("type") == NUMERICAL
    empty = is_num & F.col("statistic").isNull()
    reasons = F.filter(
        F.array(
            F.when(is_num & p_drift, F.lit(REASON_KS)),
            F.when(is_num & mean_drift, F.lit(REASON_MEAN_FMT.format(pct=theta * 100))),
            F.when(~is_num & p_drift, F.lit(REASON_CHI2)),
            F.when(empty, F.lit(REASON_EMPTY)),
        ),
        lambda x: x.isNotNull(),
    )
    drift = F.when(is_num, p_drift | mean_drift).otherwise(p_drift)
    return d.select(
        *group, F.col("fid").alias("ordinal"),
        "feature", "type",
        drift.alias("drift_detected"),
        "statistic", "p_value", reasons.alias("reasons"),
        "n_ref", "n_cur", "dof", "mean_ref", "mean_cur", "mean_shift",
    )


def drift_summary(details: DataFrame) -> DataFrame:
    return details.agg(
        F.count("*").alias("total_features_analyzed"),
        F.count_if("drift_detected").alias("drifted_features_count"),
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected_overall"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )


def detect_drift(
    ref: DataFrame,
    cur: DataFrame,
    config: DriftConfig = DriftConfig(),
    exclude=(),
    columns=None,
) -> DriftReport:
    """Test every shared column of ``ref`` and ``cur`` for drift."""
    features = common_features(ref, cur, exclude=exclude, columns=columns)
    counts = long_counts(ref, cur, features)
    if config.stage:
        counts = stage_table(counts, "drift-counts")
    details = drift_details(counts, features, config)
    return DriftReport(details=details, summary=drift_summary(details), features=features)


def detect_drift_split(
    df: DataFrame,
    current: Column,
    config: DriftConfig = DriftConfig(),
    exclude=(),
    columns=None,
) -> DriftReport:
    """Drift between the rows of one table where ``current`` is false
    (reference) and true (current); one scan of ``df``.  Columns used only to
    define the split can be passed in ``exclude``."""
    features = common_features(df, df, exclude=exclude, columns=columns)
    counts = long_counts_split(df, current, features)
    if config.stage:
        counts = stage_table(counts, "drift-counts")
    details = drift_details(counts, features, config)
    return DriftReport(details=details, summary=drift_summary(details), features=features)


def reference_profile(ref: DataFrame, features: list[Feature]) -> DataFrame:
    """Per-feature value counts of a reference table (``fid, num, cat, n``).

    Written once (e.g. with :func:`tidewatch.session.stage_table` or to a
    table), it lets later runs scan only the new data.
    """
    from tidewatch.operators.longform import single_counts

    return single_counts(ref, features)


def detect_drift_against(profile: DataFrame, cur: DataFrame, features: list[Feature],
                         config: DriftConfig = DriftConfig()) -> DriftReport:
    """Drift of ``cur`` against a stored reference profile: only ``cur`` is scanned."""
    from tidewatch.operators.longform import single_counts

    ref = profile.select("fid", "num", "cat", F.col("n").alias("r"), F.lit(0).cast("long").alias("c"))
    new = single_counts(cur, features).select("fid", "num", "cat", F.lit(0).cast("long").alias("r"), F.col("n").alias("c"))
    counts = ref.unionByName(new).groupBy("fid", "num", "cat").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    if config.stage:
        counts = stage_table(counts, "drift-counts")
    details = drift_details(counts, features, config)
    return DriftReport(details=details, summary=drift_summary(details), features=features)


def drift_against_stored(profile: StoredProfile, new: DataFrame, config: DriftConfig = DriftConfig()) -> DataFrame:
    """Decision per group ``g`` and feature for counts of new data (see ``stored_profile.NEW_COUNTS``).

    The profile stays in its buckets: only the new counts are shuffled.  A
    feature that a group has no values of still gets its row."""
    meta = F.array(*[F.struct(F.lit(f.fid).alias("fid"), F.lit(f.name).alias("feature"), F.lit(f.kind).alias("type")) for f in profile.features])
    every = new.select("g").distinct().select("g", F.inline(meta))  # groups x features rows
    totals = F.broadcast(profile.totals.select("fid", F.col("n_ref").alias("_n"), F.col("mean_ref").alias("_m")))  # one row per feature
    d = every.join(stats_against(profile, new, config.ks_exact_up_to), ["g", "fid"], "left").join(totals, "fid", "left")
    d = d.withColumns({"n_ref": F.coalesce("n_ref", "_n"), "n_cur": F.coalesce("n_cur", F.when(F.col("_n").isNotNull(), F.lit(0))),
                       "mean_ref": F.coalesce("mean_ref", "_m")})
    return decide(d, config, len(profile.features), ("g",))
