"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "jobs": {name: n}, "sf"}.
Each query runs its full plan through the no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tidewatch.config import SplitConfig  # noqa: E402
from tidewatch.operators import profile as P  # noqa: E402
from tidewatch.operators.split import stratified_split  # noqa: E402
from tidewatch.plans import catalog as C  # noqa: E402
from tidewatch.session import get_spark  # noqa: E402


def _shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from Spark's event log."""
    import glob
    import io

    import zstandard

    group_of_stage: dict[int, str] = {}
    out: dict[str, int] = {}
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(f) or os.path.basename(f).startswith((".", "appstatus")):
            continue
        raw = open(f, "rb").read()
        try:
            text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
        except zstandard.ZstdError:
            text = raw.decode(errors="ignore")
        for line in text.splitlines():
            if not line.strip():
                continue
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    group_of_stage[sid] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                g = group_of_stage.get(e["Stage ID"])
                m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                if g:
                    out[g] = out.get(g, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def _sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    import tempfile

    log_dir = tempfile.mkdtemp(prefix="tidewatch-bench-events-")  # scratch: event log for shuffle bytes
    spark = get_spark(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="tidewatch-bench",
                      extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    tracker = spark.sparkContext.statusTracker()
    T = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")

    def drift_report():  # all 11 lineitem columns, reference / current cut at 1998-07-01
        return C.drift_report_lineitem(spark, sf_dir)

    def profile():
        li = T("lineitem")
        return P.describe(li)  # all numeric columns, exact quartiles

    def missing_and_distinct():
        li = T("lineitem")
        return P.missing_report(li, only_missing=False).join(P.distinct_counts(li), "feature")

    def split():
        return stratified_split(T("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], SplitConfig())

    def forest_fit():
        from tidewatch.operators.models import fit_pipeline, forest

        parts, enc = C._lineitem_model_data(spark, sf_dir)
        model = fit_pipeline(parts.filter("split = 'train'"), enc, forest())
        return model.transform(parts.filter("split = 'test'")).select("prediction")

    plan = [
        ("drift_report_lineitem", drift_report),
        ("drift_report_events", lambda: C.drift_report_events(spark, sf_dir)),
        ("drift_chi2_orders", lambda: C.drift_chi2_orders(spark, sf_dir)),
        ("profile_describe_lineitem", profile),
        ("profile_missing_distinct", missing_and_distinct),
        ("stratified_split_orders", split),
        ("psi_events", lambda: C.psi_events(spark, sf_dir)),
        ("regression_metrics", lambda: C.regression_metrics_q(spark, sf_dir)),
    ]
    if os.environ.get("BENCH_SKIP_FOREST") != "1":
        plan.append(("forest_fit_lineitem", forest_fit))

    # warm the JVM and codegen once (not timed): a drift report on the tiny nation table
    from tidewatch.operators.drift import detect_drift_split

    detect_drift_split(T("nation"), F.col("n_regionkey") >= 2).details.write.format("noop").mode("overwrite").save()

    times, jobs = {}, {}
    for name, fn in plan:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(tracker.getJobIdsForGroup(name))
    total = round(sum(times.values()), 3)
    spark.stop()  # flush the event log
    try:
        shuffle = {k: v for k, v in _shuffle_bytes(log_dir).items() if k in times}
    except Exception:  # noqa: BLE001 - the measurement is optional
        shuffle = {}
    print(json.dumps({"metric": "total_wall_sec", "value": total, "unit": "sec", "queries": times, "jobs": jobs,
                      "shuffle_bytes": shuffle, "sf": _sf_of(sf_dir), "cpus": cpus,
                      "warmup": "untimed drift report on nation"}))


if __name__ == "__main__":
    main()
