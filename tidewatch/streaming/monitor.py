"""Structured Streaming operators (ST1–ST4).

Arriving batch files are a file-source stream; state is kept as mergeable
counts (never raw values); the drift gate tests each micro-batch, and the
windowed form each closed event-time window, against a stored reference
profile; decisions are keyed by batch id or window, so a replayed batch
overwrites instead of duplicating.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import DriftConfig
from tidewatch.operators.longform import NUMERICAL, Feature, as_double, single_counts
from tidewatch.operators.stored_profile import StoredProfile
from tidewatch.session import stage_table


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Arriving files as a stream (declared schema)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def ingest(stream: DataFrame, sink_path: str, checkpoint: str, dataset_type: str,
           partition_by=("dataset_type",)):
    """ST1: stamp ``ingested_at`` / ``dataset_type`` and append to a Parquet log."""
    out = stream.withColumns({"ingested_at": F.current_timestamp(), "dataset_type": F.lit(dataset_type)})
    return (
        out.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by).outputMode("append").trigger(availableNow=True).start()
    )


def windowed_profile(stream: DataFrame, ts_col: str, category: str, value: str, window: str = "1 day",
                     slide: str | None = None, watermark: str = "1 day") -> DataFrame:
    """ST3: per event-time window and category: count, sum and sum of squares
    of ``value`` (mergeable state).  In append and update mode rows later than the
    watermark are dropped and closed windows leave the state; complete mode
    keeps every window and drops nothing."""
    ts = F.col(ts_col).cast("timestamp")
    s = stream.withColumn("_ts", ts).withWatermark("_ts", watermark)
    w = F.window("_ts", window, slide) if slide else F.window("_ts", window)
    return s.groupBy(w.alias("window"), F.col(category).alias("category")).agg(
        F.count("*").alias("n"), F.sum(value).alias("sum_value"), F.sum(F.col(value) * F.col(value)).alias("sum_sq")
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             "category", "n", "sum_value", "sum_sq")


def run_complete(agg: DataFrame, sink_path: str, checkpoint: str):
    """Run a streaming aggregate to the end of the available input in complete
    mode, replacing the Parquet snapshot at ``sink_path`` each micro-batch.

    State is the aggregate's keys (windows x categories), not rows; complete
    mode never evicts them, so this is for bounded input.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink_path)

    return (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def _write_decisions(details: DataFrame, sink_path: str, key: str) -> None:
    """One partition per ``key``, replaced when a batch is replayed."""
    (details.withColumn("reasons", F.array_join("reasons", "; ")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(sink_path))


def drift_gate(profile: StoredProfile, sink_path: str, config: DriftConfig = DriftConfig()):
    """ST2: ``foreachBatch`` function testing each micro-batch against a stored
    profile (:func:`tidewatch.operators.stored_profile.build_profile`): only the
    batch's value counts are shuffled, to the profile's buckets."""
    from tidewatch.operators.drift import drift_against_stored

    def run(batch: DataFrame, batch_id: int) -> None:
        counts = single_counts(batch, profile.features).select(F.lit(batch_id).cast("long").alias("g"), "fid", "num", "cat", F.col("n").alias("c"))
        counts = stage_table(counts, "gate-counts")
        if not counts.isEmpty():
            _write_decisions(drift_against_stored(profile, counts, config).withColumnRenamed("g", "batch_id"), sink_path, "batch_id")

    return run


def windowed_counts(stream: DataFrame, ts_col: str, features: list[Feature], window: str, slide: str | None = None,
                    watermark: str = "1 day") -> DataFrame:
    """Value counts per event-time window and feature: (window, fid, num, cat, c).

    The state is one row per (window, feature, distinct value), never a row
    per event; it can be merged, and leaves when the watermark passes the
    window's end.  Rows without a time, nulls and NaN are not counted; rows
    later than the watermark are dropped."""
    args: list[Column] = []
    for f in features:
        numeric = f.kind == NUMERICAL
        value = as_double(stream, f.name) if numeric else F.col(f"`{f.name}`").cast("string")
        args += [F.lit(f.fid), F.when(~F.isnan(value), value) if numeric else F.lit(None).cast("double"),
                 F.lit(None).cast("string") if numeric else value]
    timed = stream.withColumn("_ts", F.col(f"`{ts_col}`").cast("timestamp")).withWatermark("_ts", watermark)
    span = F.window("_ts", window, slide) if slide else F.window("_ts", window)
    rows = timed.select("_ts", F.stack(F.lit(len(features)), *args).alias("fid", "num", "cat")).filter("num is not null or cat is not null")
    return rows.groupBy(span.alias("window"), "fid", "num", "cat").agg(F.count("*").alias("c"))


def windowed_drift(stream: DataFrame, ts_col: str, profile: StoredProfile, sink_path: str, checkpoint: str, window: str,
                   slide: str | None = None, watermark: str = "1 day", config: DriftConfig = DriftConfig()):
    """ST3: each event-time window is tested against the stored profile once, when
    the watermark closes it; a window's decision is written under its start."""
    from tidewatch.operators.drift import drift_against_stored

    def run(closed: DataFrame, batch_id: int) -> None:
        # a closed window is a group, named by its start in microseconds
        counts = closed.select(F.unix_micros("window.start").alias("g"), "fid", "num", "cat", "c",
                               (F.unix_micros("window.end") - F.unix_micros("window.start")).alias("length"))
        counts = stage_table(counts, "window-counts")
        length = counts.agg(F.max("length")).first()[0]
        if length is not None:  # no window closed otherwise
            details = drift_against_stored(profile, counts.drop("length"), config)
            start, end = F.timestamp_micros("g"), F.timestamp_micros(F.col("g") + length)
            _write_decisions(details.withColumns({"window_start": start, "window_end": end}).drop("g"), sink_path, "window_start")

    counts = windowed_counts(stream, ts_col, profile.features, window, slide, watermark)
    return (counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(run).trigger(availableNow=True).start())


def score_stream(model, stream: DataFrame, feature_cols: list[str], model_version: str, sink_path: str,
                 checkpoint: str, source: str = "api"):
    """ST4: score a stream with a fitted pipeline and append the prediction log."""
    from tidewatch.sinks.tables import prediction_rows

    scored = prediction_rows(model.transform(stream), feature_cols, model_version, source)
    return (scored.writeStream.format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
