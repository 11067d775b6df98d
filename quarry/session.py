"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Conf applied to sessions we build ourselves (tests, bench, CLI).  A session
# handed to us by a cluster is never reconfigured beyond runtime SQL confs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


# Suggested settings for a large cluster (~1000 executors, ~100 TB input),
# applied by ``build_session(master=None)`` only where the cluster's own
# configuration leaves them unset:
# - 256 MB input splits and a ~256 MB AQE target per shuffle partition keep
#   every task's working set well inside executor memory, so the DISTINCT
#   and the group-bys spill rarely (the shuffle partition count itself is
#   sized by the cluster for its data);
# - skew-join splitting covers the one possible shuffle join (a huge
#   label dictionary);
# - 10,000-row Arrow batches bound the scoring UDF's per-batch memory
#   (about 10,000 x 100 trees x 8 bytes for the path matrix).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Session with the conf above.  ``master=None`` leaves master, memory and
    shuffle partitions to the cluster (spark-submit); a local master also
    sizes the driver and the shuffle partitions for one machine."""
    b = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    cluster_defaults = {}
    if master is not None:
        b = b.master(master)
        conf.setdefault("spark.driver.memory", "16g")
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        cluster_defaults = dict(CLUSTER_CONF)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):  # real clusters only
        explicit = spark.sparkContext.getConf()
        for k, v in cluster_defaults.items():  # runtime SQL confs; the cluster's own values win
            if not explicit.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; a cluster session without it is an error.  Only a local-mode
    session without it (tests) gets a folder under /tmp.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")  # single machine only (tests)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "quarry-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` once as a parquet table under the shared checkpoint folder
    and return a scan of it: cuts the lineage (a lost executor costs a re-read,
    not a recompute) and later passes read only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._quarry_scratch = path  # lets the owner drop it when done
    return out


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Remove a scratch table written by ``materialize``; False if it could not
    be removed, which costs space and nothing else."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True))
    except Py4JJavaError as e:
        if "IOException" in str(e.java_exception.getClass()):
            return False
        raise
