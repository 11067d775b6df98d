"""Command line: ``python -m quarry <command> ...``.

    ingest   --source DIR --out DIR [--max-files N]   drain JSON-lines files into raw_data (+ quarantine),
                                                      then rebuild cleaned_data
    ingest   --kafka SERVERS --source TOPICS --out DIR [--max-offsets N] [--starting-offsets WHERE] [--option K=V ...]
                                                      the same from Kafka topics (its connector on the classpath)
    clean    --raw PATH --out DIR                     raw_data -> cleaned_data
    detect   --raw PATH --out DIR                     anomaly detection -> anomaly_data (+ anomaly_alerts)
    analyze  --cleaned PATH --out DIR                 business_insights
    batch    --raw PATH --out DIR                     clean, detect and analyze in order

Paths are parquet folders (or catalog table names).  On a cluster, run it
with spark-submit so the session carries the cluster's configuration.
"""

from __future__ import annotations

import argparse
import json
import sys

from quarry.plans import jobs as J
from quarry.session import build_session
from quarry.sources import tables as TB


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="quarry")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--checkpoint-dir", default=None,
                    help="shared folder for checkpoints and scratch tables (spark.checkpoint.dir)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "clean", "detect", "analyze", "batch"):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        if name == "ingest":
            p.add_argument("--source", required=True)
            p.add_argument("--max-files", type=int, default=None)
            p.add_argument("--kafka", default=None, help="bootstrap servers; --source then names the topics")
            p.add_argument("--max-offsets", type=int, default=None, help="offsets a micro-batch takes from Kafka")
            p.add_argument("--starting-offsets", default="earliest")
            p.add_argument("--option", action="append", default=[], metavar="K=V", help="more options of the Kafka source")
        elif name == "analyze":
            p.add_argument("--cleaned", required=True)
        else:
            p.add_argument("--raw", required=True)
        p.add_argument("--contamination", type=float, default=J.JobConfig.contamination)
        p.add_argument("--threshold", type=float, default=J.JobConfig.alert_threshold)
    a = ap.parse_args(argv)
    extra = {"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else None
    spark = build_session(master=a.master, extra=extra)
    cfg = J.JobConfig(contamination=a.contamination, alert_threshold=a.threshold)
    if a.cmd == "ingest":
        from quarry.streaming.ingest import ingest_then_clean
        kafka = {}
        if a.kafka:
            kafka = {"bootstrap_servers": a.kafka, "max_offsets_per_trigger": a.max_offsets, "starting_offsets": a.starting_offsets,
                     **dict(o.split("=", 1) for o in a.option)}
        n = ingest_then_clean(spark, a.source, a.out, a.max_files, **kafka).count()
        print(json.dumps({"cleaned_rows": n}))
    elif a.cmd == "clean":
        print(json.dumps({"cleaned_rows": J.clean_to_table(spark, TB.scan(spark, a.raw), a.out).count()}))
    elif a.cmd == "detect":
        print(json.dumps(J.run_anomaly_detection(spark, TB.scan(spark, a.raw), a.out, cfg), default=str))
    elif a.cmd == "analyze":
        for r in J.run_analysis(spark, TB.scan(spark, a.cleaned), a.out, cfg).collect():
            print(f"{r.metric}: {r.value}")
    else:
        print(json.dumps(J.run_batch_job(spark, TB.scan(spark, a.raw), a.out, cfg).first().asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
