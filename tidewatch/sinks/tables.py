"""Sinks (K1–K11): append-only Parquet logs and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scalar import half_even_int

# Dataset types of the raw-data log and prediction sources.
DATASET_TYPES = ("training_historical", "incoming_labeled", "incoming_unlabeled", "unlabeled")
PREDICTION_SOURCES = ("dashboard", "api")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None) -> None:
    """K1: write a table (CSV keeps a header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report_json(report_json: DataFrame, path: str) -> None:
    """K2: overwrite the latest drift report as one JSON document."""
    report_json.coalesce(1).write.mode("overwrite").text(path)


def drift_report_rows(report) -> DataFrame:
    """K3 row: timestamp, summary, details (map), type, run_date."""
    det = report.details.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            F.col("feature"),
            F.struct("type", "drift_detected", F.struct("statistic", "p_value").alias("statistical_metrics"), "reasons"),
        ))))
    ).scalar()  # one map with one entry per feature
    summ = report.summary.select(F.struct(*report.summary.columns).alias("summary"), F.col("timestamp"))
    return summ.select(
        "timestamp", "summary", det.alias("details"), F.lit("drift_report").alias("type"),
        F.substring("timestamp", 1, 10).alias("run_date"),
    )


def append_drift_report(report, path: str) -> None:
    drift_report_rows(report).write.mode("append").partitionBy("run_date").parquet(path)


def prediction_rows(scored: DataFrame, feature_cols: list[str], model_version: str, source: str,
                    prediction: str = "prediction") -> DataFrame:
    """K4: timestamp, type='inference', features struct, prediction_g3, rounded score, model_version, source."""
    if source not in PREDICTION_SOURCES:
        raise ValueError(f"source must be one of {PREDICTION_SOURCES}")
    return scored.select(
        F.current_timestamp().alias("timestamp"), F.lit("inference").alias("type"),
        F.struct(*[F.col(f"`{c}`") for c in feature_cols]).alias("features"),
        F.col(prediction).cast("double").alias("prediction_g3"),
        half_even_int(F.col(prediction)).alias("g3_score"),
        F.lit(model_version).alias("model_version"), F.lit(source).alias("source"),
    )


def raw_rows(df: DataFrame, dataset_type: str) -> DataFrame:
    """K5: rows stamped with ``ingested_at`` and ``dataset_type``."""
    if dataset_type not in DATASET_TYPES:
        raise ValueError(f"dataset_type must be one of {DATASET_TYPES}")
    return df.withColumns({"ingested_at": F.current_timestamp(), "dataset_type": F.lit(dataset_type)})


def append_raw(df: DataFrame, path: str, dataset_type: str) -> None:
    raw_rows(df, dataset_type).write.mode("append").partitionBy("dataset_type").parquet(path)


def metrics_document(metrics: DataFrame, version: int | None, model_type: str, num_features: int) -> DataFrame:
    """K9: metrics with a metadata envelope."""
    return metrics.select(
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("saved_at"),
            F.lit(version).cast("int").alias("version"), F.lit(model_type).alias("model_type"),
            F.lit(num_features).alias("num_features"),
        ).alias("metadata"),
        F.struct(*metrics.columns).alias("metrics"),
    )


def feature_names_document(spark: SparkSession, names: list[str]) -> DataFrame:
    """K9: the encoded feature names, in order, with a metadata envelope."""
    return spark.range(1).select(
        F.struct(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("saved_at"),
                 F.lit(len(names)).alias("num_features")).alias("metadata"),
        F.array(*[F.lit(n) for n in names]).cast("array<string>").alias("features"),
    )


def table_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as one union of single-row aggregates."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], T.StructType([
        T.StructField("table", T.StringType()), T.StructField("n_rows", T.LongType())]))


def append_batch(df: DataFrame, directory: str) -> None:
    """K7: save scored inputs back as a new unlabeled batch (CSV with header),
    closing the loop to the batch readers (S3/S8)."""
    df.write.mode("append").option("header", True).csv(directory)


def write_feature_matrix(encoded: DataFrame, path: str, names: list[str], label: str = "label",
                         split_col: str = "split") -> None:
    """S6 (writer side): encoded named features + label, partitioned by split."""
    encoded.select(*[F.col(f"`{n}`") for n in names], F.col(label), F.col(split_col)) \
        .write.mode("overwrite").partitionBy(split_col).parquet(path)
