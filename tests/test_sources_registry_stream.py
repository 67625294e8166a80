import os
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.registry import current, flatten_history, metadata, next_version, register, _read
from tidewatch.schema import student_schema
from tidewatch.sources.files import read_batches, read_feature_names, recent_rows, union_by_name

from .conftest import SF001
from .fixtures import student_pandas


def _write_batches(d, sizes, seed=1):
    os.makedirs(d, exist_ok=True)
    paths = []
    for i, n in enumerate(sizes):
        pdf = student_pandas(n, seed + i)
        pdf["G1"] = i  # marks the file
        p = os.path.join(d, f"batch_2024010{i}000000.csv")
        pdf.to_csv(p, index=False)
        t = time.time() - 1000 + i * 10
        os.utime(p, (t, t))
        paths.append(p)
    return paths


def test_recent_window_newest_first(spark, tmp_path):
    d = str(tmp_path / "labeled")
    _write_batches(d, [400, 400, 400])
    rows = recent_rows(read_batches(spark, d, student_schema()), 1000)
    per_file = {r["G1"]: r["count"] for r in rows.groupBy("G1").count().collect()}
    assert per_file == {2: 400, 1: 400, 0: 200}
    # file order inside the oldest file: its first 200 rows
    first = [r["age"] for r in rows.filter("G1 = 0").orderBy("_pos").collect()]
    assert first == list(student_pandas(400, 1)["age"][:200])


def test_corrupt_file_skipped_whole(spark, tmp_path):
    d = str(tmp_path / "unlabeled")
    _write_batches(d, [50, 50])
    with open(os.path.join(d, "batch_20240105000000.csv"), "w") as f:
        f.write(",".join(student_schema().fieldNames()) + "\n")
        f.write("GP,F,notanumber,U\n")
    b = read_batches(spark, d, student_schema())
    assert b.count() == 100


def test_missing_directory_is_empty(spark, tmp_path):
    assert read_batches(spark, str(tmp_path / "nope"), student_schema()).count() == 0


def test_union_missing_column_is_null(spark):
    a = spark.createDataFrame([(1, 2)], "x int, G3 int")
    b = spark.createDataFrame([(3,)], "x int")
    u = union_by_name(a, b)
    assert u.filter(F.col("G3").isNull()).count() == 1 and u.count() == 2


def test_feature_names_parse(spark, tmp_path):
    p = tmp_path / "names.txt"
    p.write_text("1. Medu\n12. sex_M\nheader line\n")
    got = [(r[0], r[1]) for r in read_feature_names(spark, str(p)).orderBy("position").collect()]
    assert got == [(1, "Medu"), (12, "sex_M")]


def test_registry_versions_increment(spark, tmp_path):
    path = str(tmp_path / "model_versions")
    assert next_version(_read(spark, path)).first()[0] == 1
    assert register(spark, path, 1.2, 0.9) == 1
    assert register(spark, path, 1.1, 0.91) == 2
    v = _read(spark, path)
    meta = metadata(v).first()
    assert meta["latest_version"] == 2 and len(meta["history"]) == 2
    assert current(v).first()["version"] == 2
    flat = flatten_history(metadata(v)).orderBy("version").collect()
    assert [r["version"] for r in flat] == ["v1", "v2"] and [r["is_active"] for r in flat] == [False, True]


def test_stream_windows_equal_batch(spark, tmp_path):
    from tidewatch.streaming.monitor import file_stream, run_complete, windowed_profile

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    s = file_stream(spark, SF001, ev.schema, "parquet", glob="events.parquet")
    out, ck = str(tmp_path / "w"), str(tmp_path / "ck")
    run_complete(windowed_profile(s, "ts", "event_type", "value"), out, ck).awaitTermination()
    got = {(r["window_start"].date().isoformat(), r["category"]): r["n"] for r in spark.read.parquet(out).collect()}
    want = {(r["d"].isoformat(), r["event_type"]): r["n"] for r in ev.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_stream_append_mode_drops_open_windows(spark, tmp_path):
    from tidewatch.streaming.monitor import file_stream, windowed_profile

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    s = file_stream(spark, SF001, ev.schema, "parquet", glob="events.parquet")
    q = (windowed_profile(s, "ts", "event_type", "value").writeStream.outputMode("append").format("parquet")
         .option("path", str(tmp_path / "a")).option("checkpointLocation", str(tmp_path / "ack")).trigger(availableNow=True).start())
    q.awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "a")).count()
    assert 0 < closed < ev.groupBy(F.to_date("ts"), "event_type").count().count()


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 10 and df.columns == ["feature", "type", "drift_detected", "statistic", "p_value", "reasons"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_metadata_document_roundtrip_and_latest(spark, tmp_path):
    from tidewatch.operators.registry import latest_entry
    from tidewatch.schema import METADATA_SCHEMA
    from tidewatch.sources.files import read_json_document

    path = str(tmp_path / "versions")
    register(spark, path, 1.3, 0.8)
    register(spark, path, 1.1, 0.9)
    meta = metadata(_read(spark, path))
    doc = str(tmp_path / "metadata.json")
    meta.select(F.to_json(F.struct(*meta.columns))).coalesce(1).write.text(doc)
    back = read_json_document(spark, doc, METADATA_SCHEMA)
    r = back.first()
    assert r["latest_version"] == 2 and r["current_production_version"] == 2 and len(r["history"]) == 2
    le = latest_entry(back).first()
    assert le["latest"]["version"] == 2 and le["retrain_count"] == 2


def test_metrics_document_and_random_row(spark):
    from tidewatch.operators.metrics import regression_metrics
    from tidewatch.sinks.tables import metrics_document
    from tidewatch.sources.files import random_row

    df = spark.createDataFrame([(i, float(i), float(i) + 0.5) for i in range(20)], "k int, label double, prediction double")
    doc = metrics_document(regression_metrics(df), 3, "random_forest", 41).first()
    assert doc["metadata"]["version"] == 3 and doc["metadata"]["num_features"] == 41 and doc["metrics"]["mae"] == 0.5
    a = random_row(df, ["k"]).first()["k"]
    assert a == random_row(df.repartition(5), ["k"]).first()["k"]


def test_feature_matrix_by_split(spark, students, tmp_path):
    from tidewatch.operators.clean import clean_binary
    from tidewatch.operators.features import FeatureEncoder
    from tidewatch.operators.split import stratified_split
    from tidewatch.sinks.tables import write_feature_matrix
    from tidewatch.sources.files import read_feature_matrix

    data = clean_binary(students).withColumn("label", F.col("G3").cast("double"))
    s = stratified_split(data, "G3", ["student_id"])
    m = FeatureEncoder(exclude=["G3", "label", "split", "student_id"]).fit(s.filter("split = 'train'"))
    path = str(tmp_path / "features")
    write_feature_matrix(m.transform(s), path, m.feature_names)
    x, y = read_feature_matrix(spark, path, "val")
    assert x.count() == 50 and len(x.columns) == 41 and y.columns == ["label"]


def test_csv_scans_both_separators(spark, tmp_path):
    from tidewatch.sources.files import read_csv

    pdf = student_pandas(30, 5)
    semi, comma = str(tmp_path / "semi.csv"), str(tmp_path / "comma.csv")
    pdf.to_csv(semi, sep=";", index=False)
    pdf.to_csv(comma, index=False)
    a = read_csv(spark, semi, student_schema(), sep=";")
    b = read_csv(spark, comma, student_schema())
    assert a.count() == b.count() == 30
    assert a.exceptAll(b).count() == 0 and a.schema == b.schema
    assert a.agg(F.sum("G3")).first()[0] == int(pdf["G3"].sum())
