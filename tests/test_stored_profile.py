"""Stored profiles: same decisions as the two-table drift run, profile left in its buckets."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.drift import detect_drift, drift_against_stored
from tidewatch.operators.longform import common_features, single_counts
from tidewatch.operators.stored_profile import build_profile, stats_against

SCHEMA = "x double, y double, z int, cat string, two string, none double, ts timestamp"
COLUMNS = ["x", "y", "z", "cat", "two", "none"]


def table(spark, lo, hi, shift=0.0, two="ab", step=1):
    i = F.col("id")
    return spark.range(lo, hi, step).select(
        F.when(i % 17 == 0, None).when(i % 19 == 0, float("nan")).otherwise((F.xxhash64(i) % 4000) / 100.0 + shift).alias("x"),
        F.exp((F.xxhash64(i, F.lit(1)) % 700) / 100.0).alias("y"), (i % 3 + int(shift)).cast("int").alias("z"),
        F.concat(F.lit("c"), (F.xxhash64(i, F.lit(2)) % 6 + int(shift)).cast("string")).alias("cat"),
        F.when(i % 5 == 0, two[0]).otherwise(two[-1]).alias("two"), F.when(i < 0, 1.0).alias("none"),
        F.timestamp_seconds(i * 600).alias("ts"))


def new_counts(df, feats, g=0):
    return single_counts(df, feats).select(F.lit(g).cast("long").alias("g"), "fid", "num", "cat", F.col("n").alias("c"))


def rows(df, *cols):
    out = {}
    for r in df.collect():
        out[tuple(r[c] for c in cols)] = (r["type"], r["drift_detected"], tuple(r["reasons"]), r["n_ref"], r["n_cur"], r["dof"],
                                          *[None if r[c] is None else round(r[c], 9) for c in ("statistic", "p_value", "mean_ref", "mean_cur", "mean_shift")])
    return out


@pytest.mark.parametrize("rows_per_range", [10_000_000, 97])
def test_same_decisions_as_two_tables(spark, rows_per_range):
    ref = table(spark, 1, 6000)
    news = [table(spark, 10_000, 10_400), table(spark, 20_000, 20_900, shift=3.0), table(spark, 30_000, 30_050, two="a"), table(spark, 5, 6),
            table(spark, 40_000, 41_000, shift=-500.0, two="cd")]
    feats = common_features(ref, ref, columns=COLUMNS)
    profile = build_profile(ref, feats, rows_per_range=rows_per_range)
    counts = new_counts(news[0], feats, 0)
    for g, df in enumerate(news[1:], 1):
        counts = counts.unionByName(new_counts(df, feats, g))
    got = rows(drift_against_stored(profile, counts), "g", "feature")
    for g, df in enumerate(news):
        want = rows(detect_drift(ref, df, columns=COLUMNS).details, "feature")
        assert {f: got[g, f] for (f,) in want} == {f: w for (f,), w in want.items()}
    profile.drop(spark)


def test_profile_is_not_shuffled(spark):
    ref = table(spark, 1, 3000)
    feats = common_features(ref, ref, columns=COLUMNS)
    profile = build_profile(ref, feats, rows_per_range=500)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stats_against(profile, new_counts(table(spark, 1, 50), feats))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    scans = [n for n, line in enumerate(lines) if f".{profile.values}[" in line or f".{profile.categories}[" in line]
    assert len(scans) >= 2
    for n in scans:
        assert "Bucketed: true" in lines[n]
        depth = len(re.match(r"[\s:|+\-]*", lines[n]).group())
        for line in reversed(lines[:n]):  # the scan's ancestors up to its union or join
            own = len(re.match(r"[\s:|+\-]*", line).group())
            if own < depth:
                depth = own
                assert "Exchange" not in line
                if "Union" in line or "Join" in line:
                    break
    profile.drop(spark)


def test_empty_reference_and_empty_batch(spark):
    ref = table(spark, 1, 200)
    feats = common_features(ref, ref, columns=["x", "cat"])
    empty = build_profile(ref.limit(0), feats)
    got = {r["feature"]: (r["drift_detected"], r["reasons"]) for r in drift_against_stored(empty, new_counts(ref, feats)).collect()}
    want = {r["feature"]: (r["drift_detected"], r["reasons"]) for r in detect_drift(ref.limit(0), ref, columns=["x", "cat"]).details.collect()}
    assert got == want
    assert drift_against_stored(build_profile(ref, feats), new_counts(ref.limit(0), feats)).collect() == []


def test_windows_close_once_late_rows_and_state(spark, tmp_path):
    """A window is tested when the watermark closes it, as its rows alone would be; late rows are dropped, closed state leaves."""
    from tidewatch.streaming.monitor import file_stream, windowed_drift

    day = 86_400 // 600  # rows a day
    ref = table(spark, 1, 3000)
    feats = common_features(ref, ref, columns=COLUMNS)
    profile = build_profile(ref, feats, rows_per_range=400)
    arrivals, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def arrive(df):
        df.write.mode("append").parquet(arrivals)
        q = windowed_drift(file_stream(spark, arrivals, ref.schema), "ts", profile, out, ck, "1 day", watermark="12 hours")
        q.awaitTermination()
        state = [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]]
        dropped = sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
        return state[-1], dropped

    state_1, dropped = arrive(table(spark, 0, 3 * day))  # days 0 to 2: the watermark stands at noon of day 2
    assert dropped == 0
    written = spark.read.parquet(out)
    starts = {r[0] for r in written.select("window_start").distinct().collect()}
    assert len(starts) == 2
    # the next load holds rows of day 0 (late), of day 2 (in time) and days 3 to 5
    late = table(spark, 3, 60, shift=9.0)
    state_2, dropped = arrive(late.unionByName(table(spark, 2 * day + 100_000, 2 * day + 100_001).withColumn("ts", F.timestamp_seconds(F.lit(2 * 86_400 + 80_000))))
                              .unionByName(table(spark, 3 * day, 6 * day)))
    assert dropped > 0
    open_days = table(spark, 5 * day, 6 * day)
    assert state_2 == single_counts(open_days, feats).count()  # only the open day is left
    got = rows(spark.read.parquet(out).withColumn("day", F.col("window_start").cast("long") / 86_400).withColumn("reasons", F.split("reasons", "; ")), "day", "feature")
    assert {d for d, _ in got} == {0, 1, 2, 3, 4}
    for d in range(5):
        own = table(spark, d * day, (d + 1) * day)
        if d == 2:
            own = own.unionByName(table(spark, 2 * day + 100_000, 2 * day + 100_001))
        want = rows(detect_drift(ref, own, columns=COLUMNS).details, "feature")
        for (f,), w in want.items():
            assert got[d, f][:2] == w[:2] and got[d, f][3:] == w[3:]


def test_gate_replays_a_batch_in_place(spark, tmp_path):
    from tidewatch.streaming.monitor import drift_gate

    ref = table(spark, 1, 500)
    profile = build_profile(ref, common_features(ref, ref, columns=COLUMNS))
    gate = drift_gate(profile, str(tmp_path / "gate"))
    for batch_id in (0, 1, 1):
        gate(table(spark, 1000, 1300, shift=float(batch_id)), batch_id)
    gate(ref.limit(0), 2)
    found = spark.read.parquet(str(tmp_path / "gate"))
    assert found.count() == 2 * len(COLUMNS) and {r[0] for r in found.select("batch_id").distinct().collect()} == {0, 1}
