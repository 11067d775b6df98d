"""Batch jobs: anomaly detection on raw rows, KPIs on cleaned rows, and the
two in order.  Only these functions act (write tables); everything they call
is a lazy DataFrame transformation.

Output folders live under ``out_dir``, which on a cluster must be shared
storage (by default a folder under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import clean as CL
from quarry.operators import features as FE
from quarry.operators import iforest as IF
from quarry.functions.quantile import SMALL_N
from quarry.operators import kpi as K
from quarry.session import drop_scratch, materialize
from quarry.sources import tables as TB
from quarry.sources.tablelog import TableLog


@dataclass
class JobConfig:
    contamination: float = S.CONTAMINATION
    n_trees: int = S.N_TREES
    max_samples: int = S.MAX_SAMPLES
    seed: int = S.SEED
    alert_threshold: float = S.ALERT_THRESHOLD
    revenue_sigma: float = S.REVENUE_SIGMA
    total_orders_mode: str = "purchase"


def table_path(out_dir: str, name: str) -> str:
    return os.path.join(out_dir, name)


def _threshold_and_cut(scored: DataFrame, n: int, cfg: JobConfig) -> tuple[float, float | None]:
    """Score threshold and high-revenue cut; one aggregate when N allows
    Spark's exact ``percentile``, else the bounded selection plus one more."""
    cut = A.high_revenue_cut(cfg.revenue_sigma).alias("cut")
    if n <= SMALL_N:
        row = scored.agg(F.percentile("isolation_score", F.lit(cfg.contamination)).alias("thr"), cut).first()
        return row["thr"], row["cut"]
    thr = IF.threshold_for(scored, cfg.contamination, n_rows=n)
    return thr, scored.agg(cut).first()["cut"]


def run_anomaly_detection(spark: SparkSession, raw: DataFrame, out_dir: str,
                          cfg: JobConfig | None = None, run: int | None = None) -> dict:
    """raw -> features -> forest -> labels -> reasons -> anomaly_data, and an
    alert row when the anomaly rate passes the threshold (once for each ``run``
    number, where one is given).

    Passes over the data: the dictionary pass (also gives N), the sample
    pass, the scoring pass (written once as parquet), one aggregate for the
    threshold and the revenue cut, and the output write, which also counts
    the labels through an ``Observation`` instead of a separate pass."""
    cfg = cfg or JobConfig()
    feats, n = FE.build_features_counted(raw)
    model = IF.train_isolation_forest(feats, n_trees=cfg.n_trees, max_samples=cfg.max_samples,
                                      seed=cfg.seed, n_rows=n)
    scored = materialize(model.score(feats), "scored")   # lineage cut; later passes read columns
    thr, cut = _threshold_and_cut(scored, n, cfg)
    labelled = IF.label_by_threshold(scored, thr)
    reasoned = A.assign_reason(labelled, cfg.revenue_sigma, cut=cut)
    obs = Observation("anomaly_summary")
    TB.replace_table(A.select_anomaly_output(reasoned).observe(obs, *A.summary_aggs()),
                     table_path(out_dir, "anomaly_data"))
    counts = obs.get
    total, anomalies = counts["total_rows"], counts["anomaly_rows"]
    rate = anomalies * 100.0 / total if total else None
    alert_raised = rate is not None and rate > cfg.alert_threshold
    if alert_raised:
        summary = spark.createDataFrame([(total, counts["normal_rows"], anomalies, rate)],
                                        "total_rows long, normal_rows long, anomaly_rows long, anomaly_rate double")
        alert = A.anomaly_rate_alert(summary, cfg.alert_threshold)
        if run is None:
            TB.append_table(alert, table_path(out_dir, "anomaly_alerts"))
        else:
            TableLog(spark, table_path(out_dir, "anomaly_alerts")).append(alert, "run", run)
    drop_scratch(spark, scored._quarry_scratch)  # as large as the input; anomaly_data now holds it
    return {"total_rows": total, "anomalies": anomalies, "normal": counts["normal_rows"],
            "anomaly_rate": rate, "threshold": thr, "alert_raised": alert_raised}


def run_analysis(spark: SparkSession, cleaned: DataFrame, out_dir: str,
                 cfg: JobConfig | None = None) -> DataFrame:
    """cleaned -> six business insights -> business_insights (read back)."""
    cfg = cfg or JobConfig()
    target = table_path(out_dir, "business_insights")
    TB.replace_table(K.business_insights(cleaned, cfg.total_orders_mode), target)
    return TB.scan(spark, target)


def clean_to_table(spark: SparkSession, raw: DataFrame, out_dir: str,
                   observation: Observation | None = None) -> DataFrame:
    """Rebuild ``cleaned_data`` and return a scan of the written table; an
    ``observation`` receives its row count during the write (``cleaned_rows``)."""
    target = table_path(out_dir, "cleaned_data")
    cleaned = CL.clean_events(raw)
    if observation is not None:
        cleaned = cleaned.observe(observation, F.count(F.lit(1)).alias("cleaned_rows"))
    TB.replace_table(cleaned, target)
    return TB.scan(spark, target)


def input_fingerprint(df: DataFrame, cfg: JobConfig) -> str:
    """A digest of what a job works on: its configuration, the frame's plan
    without its running numbers, and the files that it reads.  Spark names every
    file that it writes anew, so files of one name hold the same rows."""
    plan = df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
    told = json.dumps([asdict(cfg), plan, sorted(df.inputFiles())])
    return hashlib.sha256(told.encode()).hexdigest()


class StepLedger:
    """Which steps of a job are done, and what they returned, for the run that
    is not finished yet; kept in the log of ``<out_dir>/_job``.

    A run that follows a broken one on the same input takes up its steps, as
    long as the tables that they wrote are still at the version they left."""

    def __init__(self, spark: SparkSession, out_dir: str, fingerprint: str):
        self.spark, self.out_dir, self.log = spark, out_dir, TableLog(spark, table_path(out_dir, "_job"))

        def begin(s: dict) -> dict:
            if s.get("fingerprint") != fingerprint:
                s |= {"fingerprint": fingerprint, "steps": {}, "run": s.get("run", 0) + 1}
            return s

        self.run = self.log.update(begin)["run"]

    def _version(self, table: str) -> int | None:
        state = TableLog(self.spark, table_path(self.out_dir, table)).state()
        return state["version"] if state else None

    def step(self, name: str, table: str, work: Callable[[], dict]) -> dict:
        """What the step returned, doing its work unless it is done."""
        done = self.log.state()["steps"].get(name)
        if done is not None and done["version"] == self._version(table):
            return done["result"]
        result = work()
        version = self._version(table)
        self.log.update(lambda s: s | {"steps": s["steps"] | {name: {"version": version, "result": result}}})
        return result

    def finish(self) -> None:
        """The next run begins with its first step."""
        self.log.update(lambda s: s | {"fingerprint": None, "steps": {}})


def run_batch_job(spark: SparkSession, raw: DataFrame, out_dir: str,
                  cfg: JobConfig | None = None) -> DataFrame:
    """Cleaning, anomaly detection and business analysis in order; returns a
    one-row run report.  Failures propagate to the caller; the next run on the
    same input goes on with the step that failed."""
    cfg = cfg or JobConfig()
    t0 = time.time()
    ledger = StepLedger(spark, out_dir, input_fingerprint(raw, cfg))

    def clean() -> dict:
        seen = Observation("cleaned")
        clean_to_table(spark, raw, out_dir, seen)
        return {"cleaned_rows": seen.get["cleaned_rows"]}

    def analyze() -> dict:
        run_analysis(spark, TB.scan(spark, table_path(out_dir, "cleaned_data")), out_dir, cfg)
        return {"insights": len(S.INSIGHT_METRICS)}  # the insights table always has one row per metric

    n_cleaned = ledger.step("clean", "cleaned_data", clean)["cleaned_rows"]
    det = ledger.step("detect", "anomaly_data", lambda: run_anomaly_detection(spark, raw, out_dir, cfg, ledger.run))
    n_insights = ledger.step("analyze", "business_insights", analyze)["insights"]
    ledger.finish()
    elapsed = round(time.time() - t0, 3)
    return spark.createDataFrame(
        [(elapsed, det["total_rows"], det["anomalies"], det["normal"], float(det["anomaly_rate"] or 0.0),
          det["alert_raised"], n_insights, n_cleaned)],
        "elapsed_sec double, total_rows long, anomalies long, normal_rows long, anomaly_rate double, "
        "alert_raised boolean, insights long, cleaned_rows long")
