"""Hash-threshold samples equal a plain sort + limit, on every path."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import sampling as SA
from quarry.functions.sampling import smallest_by_hash, smallest_by_stratum
from quarry.operators import iforest as IF


@pytest.mark.parametrize("merged_rows", [100_000, 10])
@pytest.mark.parametrize("oversample", [4.0, 0.3, float("inf")])
def test_equals_sort_limit(spark, oversample, merged_rows):
    df = spark.range(0, 20000).withColumnRenamed("id", "id").withColumn("v", F.col("id") * 2)
    want = [r.id for r in df.withColumn("_h", F.xxhash64("id", F.lit(7))).orderBy("_h", "id").limit(500).collect()]
    got = [r.id for r in smallest_by_hash(df, 500, 7, "id", n_rows=20000, oversample=oversample, merged_rows=merged_rows)
           .withColumn("_h", F.xxhash64("id", F.lit(7))).orderBy("_h", "id").collect()]
    assert got == want


@pytest.mark.parametrize("n", [1, 30, 500])
def test_small_input(spark, n):
    df = spark.range(0, 30)
    for merged_rows in (100_000, 0):
        assert smallest_by_hash(df, n, 1, "id", merged_rows=merged_rows).count() == min(n, 30)
    assert smallest_by_hash(df.limit(0), n, 1, "id", merged_rows=0).count() == 0


@pytest.mark.parametrize("merged_rows", [100_000, 10])
def test_strata_in_one_scan(spark, merged_rows):
    df = spark.range(0, 9000).withColumn("s", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").when(F.col("id") < 300, "c"))
    sizes = {r["s"]: r["count"] for r in df.where("s in ('a', 'b', 'c')").groupBy("s").count().collect()}
    rank = F.row_number().over(Window.partitionBy("s").orderBy(F.xxhash64("id", F.lit(3)), "id"))
    want = {(r.s, r.id) for r in df.where("s is not null").withColumn("r", rank).where("r <= 400").collect()}
    got = [(r.s, r.id) for r in smallest_by_stratum(df, F.col("s"), sizes, 400, 3, merged_rows=merged_rows).collect()]
    assert len(got) == len(want) and set(got) == want


def test_repeated_ids_fill_the_sample_exactly(spark):
    df = spark.range(0, 3000).withColumn("id", F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id")))
    for n in (200, 1500):
        assert smallest_by_hash(df, n, 5, "id", merged_rows=10).count() == n


def test_no_task_merges_a_large_sample(spark):
    plan = smallest_by_hash(spark.range(0, 5000), 1000, 2, "id", merged_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=1000" not in plan


def test_the_forest_is_the_same_on_both_paths(spark):
    feats = spark.range(4000).select("id", (F.col("id") % 97 * 1.5).alias("x"), F.rand(4).alias("y")).cache()
    models = [IF.train_isolation_forest(feats, ("x", "y"), n_trees=20, max_samples=64, n_rows=4000, merged_rows=m).collect_nodes()
              .sort_values(["tree", "node"]).reset_index(drop=True) for m in (SA.MERGED_ROWS, 100)]
    feats.unpersist()
    assert models[0].equals(models[1])
