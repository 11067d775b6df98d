"""Repeated runs in one session read the tables anew and leave nothing cached."""
import pytest
from pyspark.sql import functions as F

from quarry.operators import iforest as IF
from quarry.plans import jobs
from quarry.session import scratch_path
from quarry.sources.fixture import raw_data
from quarry.streaming.ingest import surrogate_id

from conftest import SF_SMALL


def persisted(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


@pytest.mark.parametrize("files", [1, 8])
def test_second_run_covers_files_added_outside_spark(spark, files):
    import shutil

    path, out = scratch_path(spark, "raw").replace("file:", ""), scratch_path(spark, "out")
    raw = raw_data(spark, SF_SMALL)
    n = raw.count()
    raw.repartition(files).write.parquet(path)
    before = persisted(spark)
    assert jobs.run_anomaly_detection(spark, spark.read.parquet(path), out)["total_rows"] == n
    extra = scratch_path(spark, "extra").replace("file:", "")
    raw.limit(100).withColumn("id", F.col("id") + 10_000_000).coalesce(1).write.parquet(extra)
    import glob
    shutil.copy(glob.glob(f"{extra}/part-*.parquet")[0], f"{path}/part-99999-added.snappy.parquet")
    assert jobs.run_anomaly_detection(spark, spark.read.parquet(path), out)["total_rows"] == n + 100
    assert persisted(spark) <= before


def test_every_tree_has_its_own_sample(spark):
    feats = spark.range(512).select("id", (F.col("id") * 1.0).alias("x"))
    rows, psi = IF.sample_for_trees(feats, ("x",), n_trees=100, max_samples=256)
    got = rows.groupBy("tree").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count("*").alias("n")).collect()
    assert len(got) == 100 and {r.n for r in got} == {psi} and len({tuple(r.ids) for r in got}) == 100


def test_surrogate_ids_with_many_partitions(spark):
    df = spark.range(0, 6000, 1, 5000).select(F.col("id").alias("value"))
    first = [r.id for r in surrogate_id(df).collect()]
    again = [r.id for r in surrogate_id(df).collect()]
    other = [r.id for r in surrogate_id(df, lambda n: (1 << 62) + n).collect()]
    assert sorted(first) == sorted(again) == list(range(6000))
    assert sorted(other) == [(1 << 62) + 6000 + i for i in range(6000)]
