"""Model version registry as an append-only table.

``model_versions`` rows are only ever appended; the production pointer is
derived (the highest version), never stored per row.
"""

from __future__ import annotations

import datetime as _dt
import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalar import version_label
from tidewatch.schema import MODEL_VERSIONS_SCHEMA


def _read(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MODEL_VERSIONS_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # only a missing table starts at version 1
            raise
        return spark.createDataFrame([], MODEL_VERSIONS_SCHEMA)


def next_version(versions: DataFrame) -> DataFrame:
    """One row: ``next_version`` = max(version) + 1, 1 when empty."""
    return versions.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("next_version"))


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def saved_versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers in the names of the models saved beside the table, ascending."""
    fs, place = _folder(spark, f"{path.rstrip('/')}-models")
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(m[1]) for m in (re.fullmatch(r"model_v(\d+)", n) for n in names) if m)


def _claim(spark: SparkSession, path: str, first: int) -> int:
    """The least unclaimed number from ``first`` on; creating its file claims it."""
    fs, place = _folder(spark, f"{path.rstrip('/')}-claims")
    fs.mkdirs(place)
    n = first
    while True:
        try:
            if fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(place, f"v{n}")):
                return n
        except Py4JJavaError as error:  # another writer came between the look and the creation
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
        n += 1


def register(spark: SparkSession, path: str, mae: float, r2: float, filepath: str | None = None, model=None) -> int:
    """Append the next version and return its number.

    The number is one above the table's versions and the models saved beside
    it, and claimed by a file that only one writer can create: concurrent
    writers get different numbers, and that of a writer that died is left out.
    A given ``model`` is saved before its row is appended, beside the table
    unless ``filepath`` names a place, so a recorded path always holds a model."""
    recorded = next_version(_read(spark, path)).first()["next_version"]
    nv = _claim(spark, path, max([recorded, *(v + 1 for v in saved_versions(spark, path))]))
    filepath = filepath or (f"{path.rstrip('/')}-models/model_v{nv}" if model is not None else f"model_v{nv}")
    if model is not None:
        model.write().overwrite().save(filepath)
    row = spark.createDataFrame(
        [(nv, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), float(mae), float(r2), filepath)],
        MODEL_VERSIONS_SCHEMA,
    )
    row.coalesce(1).write.mode("append").parquet(path)
    return nv


def current(versions: DataFrame) -> DataFrame:
    """The production row (highest version)."""
    return versions.agg(F.max_by(F.struct(*versions.columns), "version").alias("v")).select("v.*")


def load_current(spark: SparkSession, path: str, baseline_path: str | None = None):
    """The fitted pipeline of the current version, else the baseline's, else None."""
    from pyspark.ml import PipelineModel

    row = current(_read(spark, path)).first()
    found = row["filepath"] if row and row["version"] is not None else baseline_path
    return PipelineModel.load(found) if found else None


def metadata(versions: DataFrame) -> DataFrame:
    """Metadata document: latest, production pointer, last update and full history."""
    h = F.struct(
        F.col("version"), F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.struct(F.col("mae"), F.col("r2")).alias("metrics"), F.col("filepath").alias("file"),
    )
    return versions.agg(
        F.max("version").alias("latest_version"),
        F.max("version").alias("current_production_version"),
        F.date_format(F.max("created_at"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"),
        F.array_sort(F.collect_list(h)).alias("history"),
    )


def flatten_history(meta: DataFrame) -> DataFrame:
    """One row per version, ``v{n}`` label, missing MAE -> 0, active flag."""
    e = meta.select("current_production_version", F.explode("history").alias("h"))
    return e.select(
        version_label(F.col("h.version")).alias("version"),
        F.col("h.timestamp").alias("timestamp"),
        F.coalesce(F.col("h.metrics.mae"), F.lit(0.0)).alias("mae"),
        F.coalesce(F.col("h.metrics.r2"), F.lit(0.0)).alias("r2"),
        (F.col("h.version") == F.col("current_production_version")).alias("is_active"),
    )


def history_versions(meta: DataFrame) -> DataFrame:
    """K8: the version rows of a metadata document, one per history entry."""
    h = meta.select(F.explode("history").alias("h"))
    return h.select(
        F.col("h.version").cast("int").alias("version"), F.to_timestamp("h.timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.col("h.metrics.mae").cast("double").alias("mae"), F.col("h.metrics.r2").cast("double").alias("r2"),
        F.col("h.file").cast("string").alias("filepath"),
    )


def latest_entry(meta: DataFrame) -> DataFrame:
    """Last history entry and the retrain count."""
    return meta.select(
        F.element_at("history", -1).alias("latest"), F.size("history").alias("retrain_count"),
    )
