"""Registered queries over the driver tables: each takes (spark, sf_dir) and
returns a DataFrame built from the library operators.

Doubles are rounded to 6 places only at the output edge so the oracle
compare is stable; all work runs over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.config import DriftConfig, SplitConfig
from tidewatch.functions.scalar import error_band, half_even_int, quoted_number, yes_to_int
from tidewatch.operators import profile as P
from tidewatch.operators.chi2 import category_frequencies, chi2_from_counts
from tidewatch.operators.clean import clean_binary, fill_defaults, quality_gates, validate_rows
from tidewatch.operators.distance import drift_share, drift_trend, psi_and_js, std_median_shift, wasserstein
from tidewatch.operators.features import FeatureEncoder
from tidewatch.operators.ks import ks_from_counts
from tidewatch.operators.longform import common_features
from tidewatch.operators.metrics import compare_models, overfit_gap, promote, regression_metrics
from tidewatch.operators.registry import flatten_history, metadata, next_version
from tidewatch.operators.split import random_split, stratified_split, with_quantile_bin
from tidewatch.session import stage_table
from tidewatch.sinks.tables import table_counts
from tidewatch.sources.files import latest_rows, union_by_name

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Cuts that define reference / current halves of the driver tables.
EVENTS_CUT = "2024-01-16"
LINEITEM_CUT = "1998-07-01"
ORDERS_CUT = "1998-07-01"
LI_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_LASSO = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
LI_TREE = ["l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]
LI_BOOST = ["l_discount", "l_tax", "l_linenumber"]
LI_ALL_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] + LI_NUMERIC


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def r6(c):
    return F.round(c, 6)


def halves(df: DataFrame, ts: str, cut: str):
    return df.filter(F.col(ts) < F.lit(cut).cast("timestamp_ntz")), df.filter(F.col(ts) >= F.lit(cut).cast("timestamp_ntz"))


def _is_current(ts: str, cut: str):
    """Side of each row for the single-scan drift plans (NULL ts -> neither side)."""
    return F.col(ts) >= F.lit(cut).cast("timestamp_ntz")


SPLITS = {"events": ("ts", EVENTS_CUT), "lineitem": ("l_shipdate", LINEITEM_CUT), "orders": ("o_orderdate", ORDERS_CUT)}


def _counts(spark, sf, table: str, cols=None, df: DataFrame | None = None, current=None):
    """Long-form counts of ``table`` split at its cut, in one scan."""
    from tidewatch.operators.longform import long_counts_split

    df = df if df is not None else T(spark, sf, table)
    if current is None:
        ts, cut = SPLITS[table]
        current = _is_current(ts, cut)
    feats = common_features(df, df, columns=cols)
    # written once: every statistic of a query reads the counts, not the table
    return stage_table(long_counts_split(df, current, feats), "counts"), feats


def _named(df: DataFrame, feats) -> DataFrame:
    names = df.sparkSession.createDataFrame([(f.fid, f.name) for f in feats], "fid int, feature string")
    return df.join(F.broadcast(names), "fid")


def _ks(counts, feats) -> DataFrame:
    ks = _named(ks_from_counts(counts), feats)
    return ks.select("feature", "n_ref", "n_cur", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"))


def _chi2(counts, feats) -> DataFrame:
    ch = _named(chi2_from_counts(counts), feats)
    return ch.select("feature", "n_ref", "n_cur", "dof", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"))


def _drift(spark, sf, table: str, config: DriftConfig = DriftConfig()):
    from tidewatch.operators.drift import detect_drift_split

    ts, cut = SPLITS[table]  # the column that defines the halves is not tested: it differs by construction
    return detect_drift_split(T(spark, sf, table), _is_current(ts, cut), config, exclude=[ts])


def _report_rows(details: DataFrame) -> DataFrame:
    return details.select(
        "feature", "type", "drift_detected", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"),
        F.array_join("reasons", "; ").alias("reasons"),
    )


# ---- drift ------------------------------------------------------------------

def drift_ks_events(spark, sf):
    return _ks(*_counts(spark, sf, "events", ["value"]))


def drift_ks_lineitem(spark, sf):
    return _ks(*_counts(spark, sf, "lineitem", LI_NUMERIC))


def drift_ks_exact(spark, sf):
    """A15 for small samples: the value's shift per event type and hour of the day, with the exact distribution."""
    key = F.concat_ws("|", "event_type", F.hour("ts").cast("string"))
    cur = _is_current("ts", EVENTS_CUT)
    ev = T(spark, sf, "events").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = ev.groupBy(key.alias("fid"), F.col("value").alias("num")).agg(F.count_if(~cur).alias("r"), F.count_if(cur).alias("c"))
    ks = ks_from_counts(stage_table(counts, "exact-counts"), exact_up_to=1000)
    return ks.select(F.col("fid").alias("slice"), "n_ref", "n_cur", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"))


def drift_chi2_events(spark, sf):
    return _chi2(*_counts(spark, sf, "events", ["event_type"]))


def drift_chi2_orders(spark, sf):
    return _chi2(*_counts(spark, sf, "orders", ["o_orderpriority", "o_orderstatus"]))


def drift_chi2_yates(spark, sf):
    return _chi2(*_counts(spark, sf, "lineitem", ["l_linestatus", "l_returnflag"]))


def drift_mean_shift(spark, sf):
    counts, feats = _counts(spark, sf, "lineitem", LI_ALL_NUMERIC)
    ks = _named(ks_from_counts(counts), feats)
    return ks.select("feature", r6("mean_ref").alias("mean_ref"), r6("mean_cur").alias("mean_cur"),
                     r6("mean_shift").alias("mean_shift"), (F.col("mean_shift") > 0.10).alias("shift_drift"))


def drift_report_events(spark, sf):
    return _report_rows(_drift(spark, sf, "events").details)


def drift_report_lineitem(spark, sf):
    return _report_rows(_drift(spark, sf, "lineitem").details)


def drift_vs_profile_events(spark, sf):
    """Current events against a stored reference profile: the reference half is
    profiled once and written; the run scans only the current rows."""
    from tidewatch.operators.drift import detect_drift_against, reference_profile

    ev = T(spark, sf, "events")
    ref, cur = halves(ev, "ts", EVENTS_CUT)
    feats = common_features(ev, ev, exclude=["ts"])
    prof = stage_table(reference_profile(ref, feats), "events-profile")
    return _report_rows(detect_drift_against(prof, cur, feats).details)


def drift_summary_orders(spark, sf):
    return _drift(spark, sf, "orders").summary.drop("timestamp")


def status_view(spark, sf):
    """Status view of the latest report with the reference's defaults."""
    s = _drift(spark, sf, "orders").summary
    return s.select(
        F.coalesce("drift_detected_overall", F.lit(False)).alias("drift_detected"),
        F.coalesce("drifted_features_count", F.lit(0)).cast("long").alias("drifted_features_count"),
        F.when(F.col("drift_detected_overall"), F.lit("DRIFTING")).otherwise(F.lit("STABLE")).alias("status"),
    )


def report_flatten(spark, sf):
    """P20: report details -> (feature, drift_score, p_value, is_drifted) by score desc."""
    doc = _drift(spark, sf, "events").as_json()
    from tidewatch.schema import DRIFT_REPORT_SCHEMA

    parsed = doc.select(F.from_json("report", DRIFT_REPORT_SCHEMA).alias("r"))
    e = parsed.select(F.explode("r.details").alias("feature", "d"))
    return e.select(
        "feature", r6(F.coalesce("d.statistical_metrics.statistic", F.lit(0.0))).alias("drift_score"),
        r6(F.coalesce("d.statistical_metrics.p_value", F.lit(1.0))).alias("p_value"),
        F.coalesce("d.drift_detected", F.lit(False)).alias("is_drifted"),
    ).orderBy(F.desc("drift_score"), "feature")


def category_freq(spark, sf):
    counts, feats = _counts(spark, sf, "orders", ["o_orderpriority", "o_orderstatus"])
    f = _named(category_frequencies(counts), feats)
    return f.select("feature", "category", "n_ref", "n_cur", r6("freq_ref").alias("freq_ref"), r6("freq_cur").alias("freq_cur"))


def drift_share_lineitem(spark, sf):
    d = _drift(spark, sf, "lineitem").details
    return drift_share(d).select("n_features", "n_drifted", r6("drift_share").alias("drift_share"), "dataset_drift")


def drift_bonferroni(spark, sf):
    """D9 option: Bonferroni-adjusted decisions over all lineitem columns."""
    d = _drift(spark, sf, "lineitem", DriftConfig(correction="bonferroni")).details
    return d.select("feature", r6("p_value").alias("p_value"), "drift_detected")


def psi_events(spark, sf):
    counts, feats = _counts(spark, sf, "events", ["value", "event_type"])
    p = _named(psi_and_js(counts), feats)
    return p.select("feature", r6("psi").alias("psi"), "psi_band", r6("js_divergence").alias("js_divergence"))


def wasserstein_lineitem(spark, sf):
    counts, feats = _counts(spark, sf, "lineitem", LI_NUMERIC)
    w = _named(wasserstein(counts), feats)
    return w.select("feature", r6("wasserstein").alias("wasserstein"))


def std_median_shift_lineitem(spark, sf):
    counts, feats = _counts(spark, sf, "lineitem", LI_NUMERIC)
    s = _named(std_median_shift(counts), feats)
    return s.select("feature", *[r6(c).alias(c) for c in ["std_ref", "std_cur", "std_shift", "median_ref", "median_cur", "median_shift"]])


def drift_trend_events(spark, sf):
    """Daily mean shift of events.value against the first week, with trend."""
    ev = T(spark, sf, "events")
    ref_mean = ev.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")).agg(F.avg("value")).scalar()
    daily = ev.filter(F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")).groupBy(
        F.to_date("ts").alias("day")).agg(F.avg("value").alias("cur_mean"))
    j = daily.select(F.lit("value").alias("feature"), "day", F.abs((F.col("cur_mean") - ref_mean) / ref_mean).alias("mean_shift"))
    t = drift_trend(j, "day", "mean_shift")
    return t.select("feature", "day", r6("mean_shift").alias("mean_shift"), r6("mean_shift_delta").alias("mean_shift_delta"),
                    r6("mean_shift_rolling").alias("mean_shift_rolling"))


def label_drift_bands(spark, sf):
    """Label drift — chi-square on the target's right-closed grade bands
    (l_quantity / 2.5 on the 0-20 scale) between the lineitem halves."""
    from tidewatch.schema import GRADE_BAND_EDGES

    li = T(spark, sf, "lineitem").withColumn(
        "target_band", P.right_closed_band(F.col("l_quantity") / 2.5, GRADE_BAND_EDGES).cast("string"))
    return _chi2(*_counts(spark, sf, "lineitem", ["target_band"], df=li))


def concept_drift_monthly(spark, sf):
    """Concept drift as the formula model's MAE per ship month, with the
    change against the previous month and a 3-month rolling mean."""
    s = T(spark, sf, "lineitem").select(
        F.date_trunc("month", "l_shipdate").cast("date").alias("month"),
        F.abs(F.col("l_quantity") - F.col("l_extendedprice") / 2000.0).alias("abs_error"))
    per = s.groupBy("month").agg(F.avg("abs_error").alias("mae"), F.count("*").alias("n")).withColumn("feature", F.lit("model"))
    t = drift_trend(per, "month", "mae", key="feature")
    return t.join(per.select("month", "n"), "month").select(
        "month", "n", r6("mae").alias("mae"), r6("mae_delta").alias("mae_delta"), r6("mae_rolling").alias("mae_rolling"))


def text_length_drift(spark, sf):
    """KS on document length, English vs other languages."""
    d = T(spark, sf, "documents").withColumn("text_length", F.length("text"))
    return _ks(*_counts(spark, sf, "documents", ["text_length"], df=d, current=F.col("lang") != "en"))


# ---- sources / sets ---------------------------------------------------------

def recent_window(spark, sf):
    return latest_rows(T(spark, sf, "events").drop("props"), 1000, ["ts", "event_id"])


def batch_union(spark, sf):
    a, b = halves(T(spark, sf, "events"), "ts", EVENTS_CUT)
    return union_by_name(a.select("event_id", "ts", "value"), b.select("event_id", "user_id", "event_type"))


def table_counts_all(spark, sf):
    return table_counts(spark, {t: T(spark, sf, t) for t in TABLES})


# ---- profile ----------------------------------------------------------------

def profile_describe(spark, sf):
    d = P.describe(T(spark, sf, "lineitem"), LI_ALL_NUMERIC)
    return d.select("feature", "count", *[r6(c).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def _nullable_lineitem(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_quantity", F.expr("nullif(l_discount, 0.0)").alias("l_discount"),
                     F.expr("nullif(l_tax, 0.0)").alias("l_tax"), F.expr("nullif(l_returnflag, 'N')").alias("l_returnflag"),
                     "l_linestatus")


def profile_missing(spark, sf):
    m = P.missing_report(_nullable_lineitem(spark, sf))
    return m.select("feature", "missing_count", r6("missing_pct").alias("missing_pct"))


def profile_shape(spark, sf):
    s = P.target_shape(T(spark, sf, "lineitem"), "l_extendedprice")
    return s.select("feature", "n", *[r6(c).alias(c) for c in ["mean", "median", "std", "min", "max", "skewness", "kurtosis"]])


def profile_target(spark, sf):
    return P.target_profile(T(spark, sf, "customer"), "c_acctbal").select(
        "feature", "dtype", "n_distinct", r6("min").alias("min"), r6("max").alias("max"), r6("range").alias("range"))


def column_types(spark, sf):
    return P.column_types(T(spark, sf, "lineitem"))


def shape_lineitem(spark, sf):
    return P.shape(T(spark, sf, "lineitem"))


def value_counts_part(spark, sf):
    return P.value_counts(T(spark, sf, "part"), ["p_brand", "p_type", "p_name"])


def duplicates_lineitem(spark, sf):
    return P.duplicate_count(T(spark, sf, "lineitem"))


def zero_counts_lineitem(spark, sf):
    z = P.zero_counts(T(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_quantity"])
    return z.select("feature", "zero_count", r6("zero_pct").alias("zero_pct"))


def histogram_orders(spark, sf):
    h = P.histogram(T(spark, sf, "orders"), "o_totalprice", 20)
    return h.select("bin", r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "n")


def band_distribution(spark, sf):
    li = T(spark, sf, "lineitem")
    from tidewatch.schema import GRADE_BAND_EDGES

    return P.band_distribution(li, F.col("l_quantity") / 2.5, GRADE_BAND_EDGES)


def corr_top10(spark, sf):
    c = P.correlations(T(spark, sf, "lineitem"), "l_extendedprice", top=10)
    return c.select("feature", r6("corr").alias("corr"))


def distinct_counts_customer(spark, sf):
    return P.distinct_counts(T(spark, sf, "customer"))


# Column descriptions of the customer table (feature dictionary, P24).
CUSTOMER_DICTIONARY = {
    "c_custkey": ("customer key", "identifier"),
    "c_name": ("customer name", "identifier"),
    "c_nationkey": ("nation of the customer", "categorical"),
    "c_acctbal": ("account balance", "numerical"),
    "c_mktsegment": ("market segment", "categorical"),
}


def column_dictionary_customer(spark, sf):
    return P.column_dictionary(T(spark, sf, "customer"), CUSTOMER_DICTIONARY)


def drift_score_lineitem(spark, sf):
    """A 0..1 drift score per feature: KS D for numeric, Cramér's V for categorical."""
    d = _drift(spark, sf, "lineitem").details
    n = (F.col("n_ref") + F.col("n_cur")).cast("double")
    score = F.when(F.col("type") == "numerical", F.col("statistic")).otherwise(
        F.when((F.col("dof") >= 1) & (n > 0), F.sqrt(F.col("statistic") / n)).otherwise(F.lit(0.0)))
    return d.select("feature", "type", r6(score).alias("drift_score"))


def range_outliers(spark, sf):
    return P.range_outliers(T(spark, sf, "part"), "p_size", 15, 22)


# ---- cleaning / validation --------------------------------------------------

def clean_binary_labels(spark, sf):
    lab = T(spark, sf, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "Yes").otherwise("No").alias("quality_yes"),
        F.when(F.col("toxic") == 1, " yes").otherwise("YES").alias("toxic_yes"),
    )
    once = clean_binary(lab, ["quality_yes", "toxic_yes"])
    return clean_binary(once, ["quality_yes", "toxic_yes"])  # idempotent


def validate_part(spark, sf):
    p = T(spark, sf, "part")
    v = validate_rows(p, required=["p_partkey", "p_brand", "p_size", "p_retailprice"],
                      ranges={"p_size": (1, 40), "p_retailprice": (900, 990)})
    return v.select("p_partkey", F.array_join("violations", ",").alias("violations"), "is_valid")


def fill_defaults_orders(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderpriority, '1-URGENT')").alias("o_orderpriority"))
    return fill_defaults(o, {"o_orderpriority": "3-MEDIUM", "channel": "web"})


def quoted_numeric(spark, sf):
    ev = T(spark, sf, "events")
    quoted = F.concat(F.lit('"'), F.regexp_extract("props", r":\s*([^}]*)}", 1), F.lit('"'))
    return ev.select("event_id", quoted_number(quoted).alias("k_value"))


# ---- features / splits ------------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]  # 5-LOW left out: unknown -> -1


def ordinal_encode(spark, sf):
    from tidewatch.operators.features import ordinal_code

    return T(spark, sf, "orders").select("o_orderkey", ordinal_code(F.col("o_orderpriority"), PRIORITIES).alias("priority_code"))


def _long_encoded(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    args = []
    for n in names:
        args += [F.lit(n), F.col(f"`{n}`").cast("double")]
    return df.select(key, F.stack(F.lit(len(names)), *args).alias("feature", "value"))


def onehot_dropfirst(spark, sf):
    c = T(spark, sf, "customer")
    m = FeatureEncoder(ordinal={}, nominal=["c_mktsegment"], numerical=[], exclude=["c_custkey", "c_nationkey", "c_acctbal"]).fit(c)
    out = m.transform(c)
    return _long_encoded(out, "c_custkey", m.feature_names)


def standard_scale(spark, sf):
    c = T(spark, sf, "customer")
    m = FeatureEncoder(ordinal={}, nominal=[], numerical=["c_acctbal"], exclude=["c_custkey", "c_nationkey"]).fit(c)
    return m.transform(c).select("c_custkey", r6("c_acctbal").alias("c_acctbal_scaled"))


def encode_all(spark, sf):
    """M4/M5: encoder fitted on orders before 1998 only, applied to every order."""
    o = T(spark, sf, "orders")
    train = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    enc = FeatureEncoder(ordinal={"o_orderpriority": PRIORITIES}, nominal=["o_orderstatus"], numerical=["o_totalprice"],
                         exclude=["o_orderkey", "o_custkey"])
    m = enc.fit(train)
    out = _long_encoded(m.transform(o), "o_orderkey", m.feature_names)
    return out.select("o_orderkey", "feature", r6("value").alias("value"))


def quantile_bins(spark, sf):
    return with_quantile_bin(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 5).select("o_orderkey", "bin")


def stratified_split_orders(spark, sf):
    s = stratified_split(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], SplitConfig())
    return s.select("o_orderkey", "split")


def stratified_folds_orders(spark, sf):
    """Five folds with exact shares of every price bin."""
    from tidewatch.operators.split import stratified_folds

    return stratified_folds(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"]).select("o_orderkey", "fold")


def random_split_orders(spark, sf):
    return random_split(T(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, 42)


# ---- metrics / decisions ----------------------------------------------------

def _scored_lineitem(spark, sf, divisor: float = 2000.0) -> DataFrame:
    li = T(spark, sf, "lineitem")
    return li.select("l_returnflag", F.col("l_quantity").alias("label"), (F.col("l_extendedprice") / divisor).alias("prediction"))


METRIC_COLS = ["mae", "rmse", "r2", "explained_variance", "max_error", "median_ae", "within_1", "within_2", "within_3", "mape"]


def regression_metrics_q(spark, sf):
    m = regression_metrics(_scored_lineitem(spark, sf))
    return m.select("n", *[r6(c).alias(c) for c in METRIC_COLS])


def within_k_by_flag(spark, sf):
    m = regression_metrics(_scored_lineitem(spark, sf), group=["l_returnflag"], with_median=False)
    return m.select("l_returnflag", "n", *[r6(f"within_{k}").alias(f"within_{k}") for k in (1, 2, 3)])


def error_bands(spark, sf):
    s = _scored_lineitem(spark, sf)
    return s.select(error_band(F.abs(F.col("label") - F.col("prediction"))).alias("status")).groupBy("status").agg(
        F.count("*").alias("n"))


def quality_gate(spark, sf):
    m = regression_metrics(_scored_lineitem(spark, sf), with_median=False)
    g = quality_gates(m.select("mae", "r2", "within_1"))
    return g.select(r6("mae").alias("mae"), r6("r2").alias("r2"), r6("within_1").alias("within_1"), "mae_gate", "r2_gate", "within_1_gate")


def _two_models(spark, sf) -> DataFrame:
    a = _scored_lineitem(spark, sf, 2000.0).withColumn("model", F.lit("per_2000"))
    b = _scored_lineitem(spark, sf, 1500.0).withColumn("model", F.lit("per_1500"))
    return a.unionByName(b)


def compare_models_q(spark, sf):
    c = compare_models(_two_models(spark, sf))
    return c.select("model", "n", *[r6(x).alias(x) for x in ["mae", "rmse", "r2", "within_1", "within_2"]], "is_best")


def promote_decision(spark, sf):
    m = regression_metrics(_two_models(spark, sf), group=["model"], with_median=False)
    p = m.agg(F.max(F.when(F.col("model") == "per_2000", F.col("mae"))).alias("champion_mae"),
              F.max(F.when(F.col("model") == "per_1500", F.col("mae"))).alias("challenger_mae"))
    return p.select(r6("champion_mae").alias("champion_mae"), r6("challenger_mae").alias("challenger_mae"),
                    promote(F.col("champion_mae"), F.col("challenger_mae")).alias("promote"))


def half_even_scores(spark, sf):
    s = _scored_lineitem(spark, sf)
    return s.select(half_even_int(F.col("prediction")).alias("score")).groupBy("score").agg(F.count("*").alias("n"))


def overfit_gap_q(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    parts = random_split(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], 0.2, 42)
    s = parts.select(F.when(F.col("split") == "train", "train").otherwise("val").alias("split"),
                     F.col("l_quantity").alias("label"), (F.col("l_extendedprice") / 2000.0).alias("prediction"))
    g = overfit_gap(regression_metrics(s, group=["split"], with_median=False))
    return g.select(*[r6(c).alias(c) for c in g.columns])


def at_risk_summary(spark, sf):
    """Predicted below 10 -> at risk; predicted pass rate; feedback bands."""
    s = _scored_lineitem(spark, sf)
    band = F.when(F.col("prediction") >= 15, "excellent").when(F.col("prediction") >= 12, "good").when(
        F.col("prediction") >= 10, "pass").otherwise("at_risk")
    return s.select(band.alias("band")).groupBy("band").agg(F.count("*").alias("n"))


def bottom_20(spark, sf):
    li = T(spark, sf, "lineitem")
    s = li.select(*li.columns, r6(F.col("l_extendedprice") / 2000.0).alias("prediction"))
    keys = ["prediction"] + li.columns
    return s.orderBy(*keys).limit(20).select("l_orderkey", "l_linenumber", "l_partkey", "prediction")


def pass_accuracy(spark, sf):
    """X11: pass/fail agreement at 10 and MAPE (zeros excluded)."""
    s = _scored_lineitem(spark, sf)
    return s.agg(
        r6(F.avg(((F.col("label") >= 10) == (F.col("prediction") >= 10)).cast("double")) * 100).alias("pass_accuracy"),
        r6(F.avg(F.when(F.col("label") != 0, F.abs((F.col("label") - F.col("prediction")) / F.col("label")))) * 100).alias("mape"),
    )


def ridge_fit(spark, sf):
    """M10 on one feature; equals the closed form Sxy / (Sxx + alpha)."""
    from pyspark.ml.feature import VectorAssembler

    from tidewatch.operators.models import ridge

    li = T(spark, sf, "lineitem")
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li.select("l_quantity", F.col("l_extendedprice").alias("label")))
    m = ridge(d, "label", "features", 1.0)
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "coefficient double, intercept double").select(
        F.round("coefficient", 4).alias("coefficient"), F.round("intercept", 3).alias("intercept"))


def lasso_fit(spark, sf):
    """Lasso of the price on one feature at a time; equals the soft-thresholded closed form."""
    from tidewatch.operators.models import lasso

    li = T(spark, sf, "lineitem")
    rows = [(f, coef[f], b0) for f in LI_LASSO for coef, b0 in [lasso(li, [f], "l_extendedprice", 0.5)]]
    return spark.createDataFrame(rows, "feature string, coefficient double, intercept double").select(
        "feature", F.round("coefficient", 4).alias("coefficient"), F.round("intercept", 3).alias("intercept"))


def tree_split_lineitem(spark, sf):
    """M8: the best threshold of each feature for the quantity, by exact prefix sums."""
    from tidewatch.operators.trees import best_splits

    b = best_splits(T(spark, sf, "lineitem"), LI_TREE, F.col("l_quantity"))
    return b.select("feature", "n_left", "n_right", *[r6(c).alias(c) for c in ("threshold", "mean_left", "mean_right", "gain")])


def boosting_fit(spark, sf):
    """Three rounds of boosted stumps for the quantity on columns with few values."""
    from tidewatch.operators.trees import boost

    model = boost(T(spark, sf, "lineitem"), LI_BOOST, "l_quantity", 3, 0.5)
    rows = [(i + 1, s.feature, s.threshold, s.left, s.right) for i, s in enumerate(model.stumps)]
    return spark.createDataFrame(rows, "round int, feature string, threshold double, left_value double, right_value double").select(
        "round", "feature", *[r6(c).alias(c) for c in ("threshold", "left_value", "right_value")])


def interaction_features(spark, sf):
    """Polynomial / interaction columns, summarised per return flag."""
    li = T(spark, sf, "lineitem")
    x = li.withColumns({"q2": F.col("l_quantity") ** 2, "disc_tax": F.col("l_discount") * F.col("l_tax"),
                        "q_disc": F.col("l_quantity") * F.col("l_discount"), "disc_plus_tax": F.col("l_discount") + F.col("l_tax")})
    return x.groupBy("l_returnflag").agg(*[r6(F.avg(c)).alias(f"avg_{c}") for c in ["q2", "disc_tax", "q_disc", "disc_plus_tax"]])


def zero_impute(spark, sf):
    """Zero discounts flagged, then imputed with the exact median of the non-zero ones."""
    li = T(spark, sf, "lineitem")
    nz = li.filter(F.col("l_discount") != 0)
    med = P.quantiles_by_column(nz, ["l_discount"], [0.5]).select("q").scalar()
    filled = F.when(F.col("l_discount") == 0, med).otherwise(F.col("l_discount"))
    return li.agg(F.count_if(F.col("l_discount") == 0).alias("n_zero"), r6(F.first(med)).alias("median_nonzero"),
                  r6(F.avg(filled)).alias("mean_after_impute"))


def mode_impute(spark, sf):
    """X15 (strings): NULL return flags filled with the most frequent flag (ties by value)."""
    li = _nullable_lineitem(spark, sf)
    mode = li.filter(F.col("l_returnflag").isNotNull()).groupBy("l_returnflag").count().agg(
        F.min_by("l_returnflag", F.struct(F.lit(0) - F.col("count"), F.col("l_returnflag")))).scalar()
    return li.select(F.coalesce(F.col("l_returnflag"), mode).alias("l_returnflag")).groupBy("l_returnflag").agg(F.count("*").alias("n"))


# ---- registry ---------------------------------------------------------------

def _versions(spark, sf) -> DataFrame:
    """A version log derived from the data: one retrain per ship year, with that
    year's MAE / R² of the formula model (whole lineitem table)."""
    li = T(spark, sf, "lineitem")
    y = F.col("l_quantity")
    p = F.col("l_extendedprice") / 2000.0
    per_year = li.groupBy(F.year("l_shipdate").alias("yr")).agg(
        F.avg(F.abs(y - p)).alias("mae"), (F.lit(1.0) - F.avg((y - p) ** 2) / F.var_pop(y)).alias("r2"),
        F.max("l_shipdate").alias("created_at"))
    w = Window.orderBy("yr")
    return per_year.select(F.row_number().over(w).cast("int").alias("version"), F.col("created_at").cast("timestamp").alias("created_at"),
                           "mae", "r2", F.concat(F.lit("model_v"), F.row_number().over(w).cast("string")).alias("filepath"))


def registry_next(spark, sf):
    return next_version(_versions(spark, sf))


def history_flatten(spark, sf):
    h = flatten_history(metadata(_versions(spark, sf)))
    return h.select("version", r6("mae").alias("mae"), r6("r2").alias("r2"), "is_active")


# ---- joins ------------------------------------------------------------------

MERGE_KEYS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def merge_on_many_keys(spark, sf):
    """Two overlapping customer tables on four keys, clashing columns suffixed."""
    from tidewatch.operators.joins import merge_on_keys

    c = T(spark, sf, "customer").select(*MERGE_KEYS, "c_acctbal")
    return merge_on_keys(c.filter("c_acctbal < 5000"), c.filter("c_acctbal >= 2000"), MERGE_KEYS)


def nation_region(spark, sf):
    n, r = T(spark, sf, "nation"), T(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def side_by_side_scores(spark, sf):
    """Two models scored on the same rows, side by side."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from tidewatch.operators.models import side_by_side

    def priced(divisor: float):
        return PipelineModel([SQLTransformer(statement=f"SELECT *, l_extendedprice / {divisor}D AS prediction FROM __THIS__")])

    scored = side_by_side({"a": priced(2000.0), "b": priced(1500.0)}, T(spark, sf, "lineitem"), ["l_returnflag", "l_quantity"])
    return scored.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), *[r6(F.avg(F.abs(F.col("l_quantity") - F.col(m)))).alias(f"mae_{m}") for m in "ab"])


CSV_COLUMNS = "event_id long, user_id long, event_type string, value double"


def _event_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.count_distinct("user_id").alias("users"),
                  F.count_distinct("event_type").alias("types"), r6(F.sum("value")).alias("total"))


def csv_two_separators(spark, sf):
    """The events as CSV files under both separators, read back."""
    from tidewatch.session import shared_dir
    from tidewatch.sources.files import read_csv

    rows = T(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    out = []
    for sep in (",", ";"):
        path = shared_dir(spark, "csv")
        rows.write.option("header", True).option("sep", sep).csv(path)
        back = read_csv(spark, path, _schema_of(CSV_COLUMNS), sep=sep)
        out.append(_event_rows(back).select(F.lit(sep).alias("sep"), "*"))
    return union_by_name(*out)


def corrupt_file_skip(spark, sf):
    """Batches whose files hold a malformed record are left out whole."""
    from tidewatch.session import shared_dir
    from tidewatch.sources.files import read_batches

    path = shared_dir(spark, "batches")
    rows = T(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    rows.write.option("header", True).csv(path)
    (rows.withColumn("event_id", F.concat(F.lit("no number "), F.col("event_id").cast("string")))
     .write.mode("append").option("header", True).csv(path))
    return _event_rows(read_batches(spark, path, _schema_of(CSV_COLUMNS)))


RECENT_ROWS = 3000


def recent_files_window(spark, sf):
    """S3, O1: events in one CSV file per four days, the later days the newer files; the newest rows of the newest files."""
    from tidewatch.session import shared_dir
    from tidewatch.sources.files import recent_files

    path = shared_dir(spark, "recent-files")
    rows = T(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.floor((F.dayofmonth("ts") - 1) / 4).cast("int").alias("slice"))
    rows.repartition("slice").sortWithinPartitions("slice", "event_id").write.partitionBy("slice").option("header", True).csv(path)
    files = spark._jvm.org.apache.hadoop.fs
    root = files.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(files.Path(f"{path}/slice=*/*.csv")):  # modification times by slice
        number = int(status.getPath().getParent().getName().split("=")[1])
        fs.setTimes(status.getPath(), 1_700_000_000_000 + number * 60_000, -1)
    return recent_files(spark, path, _schema_of(CSV_COLUMNS), RECENT_ROWS).select(
        F.col("_pos").alias("position"), "event_id", "user_id", "event_type", r6("value").alias("value"))


# ---- streaming ----------------------------------------------------------------

def _events_stream(spark, sf):
    from tidewatch.streaming.monitor import file_stream

    schema = T(spark, sf, "events").schema
    return file_stream(spark, sf, schema, "parquet", glob="events.parquet")


def stream_ingest(spark, sf):
    """ST1: events arrive as files; stamped and appended to a Parquet log."""
    from tidewatch.session import shared_dir
    from tidewatch.streaming.monitor import ingest

    out, ck = shared_dir(spark, "ingest"), shared_dir(spark, "ingest-ck")
    ingest(_events_stream(spark, sf), out, ck, "incoming_unlabeled").awaitTermination()
    return spark.read.parquet(out).drop("ingested_at")


def stream_windowed_profile(spark, sf):
    """ST3: daily windows per event type with mergeable count / sum state."""
    from tidewatch.session import shared_dir
    from tidewatch.streaming.monitor import run_complete, windowed_profile

    out, ck = shared_dir(spark, "windows"), shared_dir(spark, "windows-ck")
    agg = windowed_profile(_events_stream(spark, sf), "ts", "event_type", "value", "1 day", watermark="1 day")
    run_complete(agg, out, ck).awaitTermination()
    w = spark.read.parquet(out)
    return w.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "category", "n",
                    r6("sum_value").alias("sum_value"), r6("sum_sq").alias("sum_sq"))


def _events_profile(spark, sf):
    """Stored profile of the events before the cut, and the current events."""
    from tidewatch.operators.stored_profile import build_profile

    ev = T(spark, sf, "events")
    ref, cur = halves(ev, "ts", EVENTS_CUT)
    return build_profile(ref, common_features(ev, ev, exclude=["ts"])), cur


def _decisions(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "feature", "type", "drift_detected", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"), "reasons")


GATE_CUT = "2024-01-24"


def stream_drift_gate(spark, sf):
    """ST2: current events arrive in two loads, each one micro-batch tested
    against the stored profile of the events before the cut."""
    from tidewatch.session import shared_dir
    from tidewatch.streaming.monitor import drift_gate, file_stream

    profile, cur = _events_profile(spark, sf)
    arrivals, out, ck = (shared_dir(spark, n) for n in ("gate-arrivals", "gate", "gate-ck"))
    for load in halves(cur, "ts", GATE_CUT):
        load.write.mode("append").parquet(arrivals)
        (file_stream(spark, arrivals, cur.schema).writeStream.option("checkpointLocation", ck)
         .foreachBatch(drift_gate(profile, out)).trigger(availableNow=True).start().awaitTermination())
    return _decisions(spark.read.parquet(out), F.col("batch_id").cast("long").alias("batch_id"))


def stream_windowed_drift(spark, sf):
    """ST3: windows of four days of the current events, each tested against the stored
    profile when the watermark (one day) closes it."""
    from tidewatch.session import shared_dir
    from tidewatch.streaming.monitor import file_stream, windowed_drift

    profile, cur = _events_profile(spark, sf)
    arrivals, out, ck = (shared_dir(spark, n) for n in ("window-arrivals", "window-drift", "window-drift-ck"))
    cur.write.parquet(arrivals)
    windowed_drift(file_stream(spark, arrivals, cur.schema), "ts", profile, out, ck, "4 days").awaitTermination()
    d = spark.read.schema("feature string, type string, drift_detected boolean, statistic double, p_value double, reasons string, "
                          "window_end timestamp, window_start timestamp").parquet(out)
    return _decisions(d, *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")])


def _lineitem_model_data(spark, sf):
    li = T(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
    parts = random_split(li, keys, 0.2, 42).withColumn("label", F.col("l_quantity").cast("double"))
    parts = stage_table(parts, "model-rows")  # the fit scans its input many times: cut the lineage once
    enc = FeatureEncoder(ordinal={}, nominal=["l_returnflag", "l_linestatus"], numerical=["l_extendedprice"],
                         exclude=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "label"])
    return parts, enc


def rf_train_score(spark, sf):
    """Baseline forest fitted on the train split (encoder fitted there
    too), scored on both splits; metrics per split."""
    from tidewatch.operators.models import fit_pipeline, forest

    parts, enc = _lineitem_model_data(spark, sf)
    model = fit_pipeline(parts.filter("split = 'train'"), enc, forest())
    scored = model.transform(parts)
    m = regression_metrics(scored, "label", "prediction", group=["split"], with_median=False)
    return m.select("split", "n", *[r6(c).alias(c) for c in ["mae", "rmse", "r2", "within_1", "within_2"]])


def feature_importance_rf(spark, sf):
    """Forest importances with encoded feature names, top 15."""
    from tidewatch.operators.models import feature_importance, fit_pipeline, forest

    parts, enc = _lineitem_model_data(spark, sf)
    model = fit_pipeline(parts.filter("split = 'train'"), enc, forest(maxDepth=6, numTrees=20))
    return feature_importance(model.stages[-1], model.stages[0].feature_names, 15, spark)


LOOP_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LOOP_FEATURE, LOOP_TARGET = "l_extendedprice", "l_quantity"


def retrain_loop(spark, sf):
    """Rounds of the retraining loop over one registry; the challenger is a line
    through one scaled feature, so each error has a closed form.

    1 no files; 2 files with the reference's rows; 3 dearer rows without labels; 4 the same
    with labels; 5 later rows, dearer still and with another label level; 6 those again."""
    from pyspark.ml.regression import LinearRegression

    from tidewatch.operators.features import FeatureEncoder
    from tidewatch.plans.jobs import retraining
    from tidewatch.session import shared_dir

    li, day = T(spark, sf, "lineitem"), F.col("l_shipdate")

    def part(rows, price: float, more: float) -> DataFrame:
        return li.filter(rows).select(*LOOP_KEYS, (F.col(LOOP_FEATURE) * price).alias(LOOP_FEATURE), (F.col(LOOP_TARGET) + more).alias(LOOP_TARGET))

    def files(rows: DataFrame) -> str:
        path = shared_dir(spark, "loop-files")
        rows.write.option("header", True).csv(path)
        return path

    ref = part(day < "1997-01-01", 1.0, 0.0)
    first = part((day >= "1997-01-01") & (day < "1998-01-01"), 1.5, 0.0)
    later = part(day >= "1998-01-01", 2.0, 8.0)
    none, versions = shared_dir(spark, "loop-none"), shared_dir(spark, "loop-versions")
    labeled = files(later)
    rounds = [(none, none), (none, files(ref.drop(LOOP_TARGET))), (none, files(first.drop(LOOP_TARGET))), (files(first), none),
              (labeled, none), (labeled, none)]
    rows = []
    for i, (lab, unl) in enumerate(rounds):
        out = retraining(
            spark, ref, lab, unl, ref.schema, versions, window_rows=1 << 62, key_cols=LOOP_KEYS, target=LOOP_TARGET,
            encoder=FeatureEncoder(ordinal={}, nominal=[], numerical=[LOOP_FEATURE], exclude=[*LOOP_KEYS, LOOP_TARGET, "label", "split"]),
            estimator=LinearRegression(labelCol="label", regParam=0.0, solver="normal"))
        rows.append((i + 1, out.status, out.champion_mae, out.challenger_mae, out.version))
    found = spark.createDataFrame(rows, "round int, status string, champion_mae double, challenger_mae double, version int")
    return found.select("round", "status", *[F.round(c, 4).alias(c) for c in ("champion_mae", "challenger_mae")], "version")


def stream_scoring(spark, sf):
    """ST4: arriving lineitem files scored by a ridge pipeline into the prediction log."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression

    from tidewatch.operators.models import ridge_reg_param
    from tidewatch.session import shared_dir
    from tidewatch.streaming.monitor import file_stream, score_stream

    parts, enc = _lineitem_model_data(spark, sf)
    train = parts.filter("split = 'train'")
    lr = LinearRegression(labelCol="label", elasticNetParam=0.0, regParam=ridge_reg_param(train, "label"),
                          standardization=False, solver="normal")
    model = Pipeline(stages=[enc, lr]).fit(train)
    stream = file_stream(spark, sf, T(spark, sf, "lineitem").schema, "parquet", glob="lineitem.parquet")
    out, ck = shared_dir(spark, "preds"), shared_dir(spark, "preds-ck")
    score_stream(model, stream, ["l_orderkey", "l_linenumber", "l_extendedprice"], "v1", out, ck, "api").awaitTermination()
    p = spark.read.parquet(out)
    return p.select("type", "features.l_orderkey", "features.l_linenumber", r6("prediction_g3").alias("prediction_g3"),
                    "g3_score", "model_version", "source")


QUERIES = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and getattr(fn, "__module__", None) == __name__ and not name.startswith("_")
    and name not in {"T", "r6", "halves", "QUERIES"}
}
