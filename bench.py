"""Benchmark the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS].

Warm up once, then report the median of 3 runs for: cleaning, KPIs, forest
training, forest scoring (+ threshold and labels), and the full batch job
(clean + anomaly detection + KPIs, with table writes).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.operators import clean as CL  # noqa: E402
from quarry.operators import features as FE  # noqa: E402
from quarry.operators import iforest as IF  # noqa: E402
from quarry.operators import kpi as K  # noqa: E402
from quarry.plans import jobs as J  # noqa: E402
from quarry.session import build_session, materialize, scratch_path  # noqa: E402
from quarry.sources import tables as TB  # noqa: E402
from quarry.sources.fixture import raw_data  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage/task times for tools/stage_times.py
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="quarry-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    cleaned_path = scratch_path(spark, "bench-cleaned")
    TB.replace_table(CL.clean_events(raw_data(spark, sf_dir)), cleaned_path)
    n_raw = raw_data(spark, sf_dir).count()

    state = {}

    def clean():
        _noop(CL.clean_events(raw_data(spark, sf_dir)))

    def kpis():
        K.business_insights(TB.scan(spark, cleaned_path)).collect()

    def forest_train():
        feats, n = FE.build_features_counted(raw_data(spark, sf_dir))
        model = IF.train_isolation_forest(feats, n_rows=n)
        state.update(feats=feats, model=model, arrays=model.node_arrays())

    def forest_score():
        feats, model = state["feats"], state["model"]
        scored = materialize(model.score(feats), "bench-scored")
        thr = IF.threshold_for(scored)
        _noop(IF.label_by_threshold(scored, thr))

    def full_job():
        state["report"] = J.run_batch_job(spark, raw_data(spark, sf_dir), scratch_path(spark, "bench-job")).first()

    steps = [("clean", clean), ("kpis", kpis), ("forest_train", forest_train),
             ("forest_score", forest_score), ("full_job", full_job)]
    sc = spark.sparkContext
    for _, fn in steps:  # warm-up
        fn()
    times = {name: [] for name, _ in steps}
    for _ in range(3):
        for name, fn in steps:
            sc.setJobGroup(name, name)
            t0 = time.perf_counter()
            fn()
            times[name].append(time.perf_counter() - t0)
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "full_job_sec", "value": med["full_job"], "unit": "sec",
                      "queries": med, "sf": sf, "raw_rows": n_raw,
                      "anomaly_rate_pct": round(state["report"]["anomaly_rate"], 2),
                      "cleaned_rows": state["report"]["cleaned_rows"],
                      "retention_pct": round(100.0 * state["report"]["cleaned_rows"] / n_raw, 1),
                      "rows_per_sec": round(n_raw / med["full_job"], 1) if med["full_job"] else None}))
    spark.stop()


if __name__ == "__main__":
    main()
